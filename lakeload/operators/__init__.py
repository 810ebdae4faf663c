"""DataFrame -> DataFrame steps. Nothing in here starts a Spark job unless its name says so
(``validate_*`` and ``*_exists`` answer with a value)."""
