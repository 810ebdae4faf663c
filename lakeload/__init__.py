"""lakeload: lakehouse loading and change tracking as plain Spark DataFrame jobs.

Layout
------
functions   Column builders (hash input, run stamps, safe names, error classes, cast text).
operators   DataFrame -> DataFrame steps: current state, change detection, merge, log and
            registry queries, watermarks, tuning.
sources     Reading and writing: landed files, bronze tables, versioned tables, logs, configs.
plans       Jobs composed of the above: load a source, build a registry, merge watermarks.
streaming   Incremental file ingest with Structured Streaming.
"""

__version__ = "0.1.0"
