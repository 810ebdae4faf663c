"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.session import scratch_path

# ASCII blanks, the only separators of words and the only characters stripped from lines.
BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe when executors go.

    Rows that differ in ``by`` are kept in folders of their own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def with_results(df: DataFrame, row: str, columns: list[str], results: dict[str, Column]) -> DataFrame:
    """Columns of the struct ``row`` followed by ``results``; a result replaces a column of its name."""
    found = df.select(F.col(row).alias("row"), F.struct(*[v.alias(n) for n, v in results.items()]).alias("found"))
    return found.select(*[F.col("row")[c].alias(c) for c in columns if c not in results],
                        *[F.col("found")[n].alias(n) for n in results])


def pack(columns: list[str]) -> Column:
    """The given columns as one struct, so that their names cannot clash with an operator's own."""
    return F.struct(*([F.col(f"`{c}`").alias(c) for c in columns] or [F.lit(0).alias("none")]))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
