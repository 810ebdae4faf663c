"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions.

Each document draws an exponential key divided by its quality weight; the order of the keys within a
source is a weighted sample without replacement. A source whose target exceeds its size first takes every
document as often as whole epochs fit, and the sampled order decides on the remaining fraction.

The prefix sums never sort a whole source in one task: keys fall into ranges, range totals are summed in
order (a bounded number of rows per source), and rows are sorted within their range only. Ranges are cut evenly
on the logarithm of the key. A weight only shifts that, so whatever the weights are, a range draws no more than
about one in ``ranges`` of a source's documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.common import pack, stored, with_results

WORDS = r"[^\x20\x09-\x0D]+"
TYPICAL_WORD = 6.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the seed and the id only, so that reruns agree."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2 ** 48))


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: one for a usual mean word length, less the further off it is."""
    mean = F.char_length(text) / F.greatest(size, F.lit(1))
    return F.coalesce(F.lit(1.0) / (F.lit(1.0) + F.abs(mean - F.lit(TYPICAL_WORD)) / F.lit(TYPICAL_WORD)), F.lit(1.0))


def key_range(key: Column, ranges: int) -> Column:
    """The range of an exponential key over any weight; in the order of the keys.

    The logarithm to base 2 of an exponential variable has a density of at most ln 2 / e, just over a quarter.
    """
    return F.floor(F.log2(key) * F.lit(ranges / 4.0)).cast("int")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
                   budget: int | None = None) -> DataFrame:
    """Words each source should give: ``src, source_size, target``.

    ``sizes`` has one row per source (``src``, ``source_size``) and is ordered as a whole, which is one
    task over as many rows as there are sources. Sources in order of ``src`` weigh ``weights`` in turn.
    A target stops at ``max_epochs`` times the source's size; what is left over is shared again by weight
    until no target is above. That end state is ``min(cap, level * weight)`` with one level for all: with
    sources in order of cap / weight, the level of the first one that stays below its cap.
    """
    everything = Window.orderBy("src")
    ranked = sizes.select(
        "src", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                     ((F.row_number().over(everything) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).cast("double").alias("cap"))
    total = F.lit(float(budget)) if budget is not None else F.sum("source_size").over(Window.partitionBy()).cast("double")
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = ranked.select("*", ((total - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
                                 / F.sum("weight").over(later)).alias("level"),
                           F.row_number().over(by_ratio).alias("place"))
    below = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("place"))
    first = F.min_by("level", below).over(Window.partitionBy())
    return levels.withColumn("first", first).select(
        "src", "source_size",
        F.when(F.col("first").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("first") * F.col("weight"))).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
                budget: int | None = None, seed: str = "mix", ranges: int = 4096, keep: list[str] | None = None,
                doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The columns ``keep`` (default all) of every document with its share of the mixture.

    Adds ``size`` (words), ``source_size``, ``target`` (the source's), ``epochs`` (whole passes over the
    source), ``taken`` (words used, repeats counted). The last document of a source's fraction gives only
    the words still missing, so a source meets its target to the word. ``budget`` defaults to all words.

    Null text has size 0. Null sources form one source, the last in order; an empty name comes first.
    Null ids and repeated rows draw equal keys and are ordered by size; equal rows share what is left in
    any order, so that the result as a whole is the same on each run. No rows give no rows.
    """
    keep = docs.columns if keep is None else keep
    name = F.col(f"`{source}`")
    body = F.col(f"`{text}`")
    sized = docs.select(
        pack(keep).alias("row"), F.col(f"`{doc_id}`").alias("id"), word_count(body).alias("size"),
        F.coalesce(F.concat(F.lit("0"), name), F.lit("1")).alias("src"), F.char_length(body).alias("chars"),
        body.alias("body"))
    key = -F.log(uniform(F.col("id"), seed)) / quality_weight(F.col("body"), F.col("size"))
    keyed = sized.select("row", "id", "size", "src", key.alias("key"))
    rows = stored(keyed.withColumn("range", key_range(F.col("key"), ranges)), "mix")

    totals = rows.groupBy("src", "range").agg(F.sum("size").alias("range_size"))
    in_order = Window.partitionBy("src").orderBy("range")
    totals = totals.select("src", "range", (F.sum("range_size").over(in_order) - F.col("range_size")).alias("before"))
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs, budget).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    targets = targets.withColumn(
        "quota", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))

    within = Window.partitionBy("src", "range").orderBy("key", "id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (rows.withColumn("upto", F.sum("size").over(within))
              .join(totals.join(targets, "src"), ["src", "range"]))
    start = F.col("before") + F.col("upto") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - start))
    return with_results(placed, "row", keep, {
        "size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
        "epochs": F.col("epochs"), "taken": (F.col("size") * F.col("epochs") + part).cast("long")})
