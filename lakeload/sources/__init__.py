"""Reading and writing. All storage access of the package is in here."""
