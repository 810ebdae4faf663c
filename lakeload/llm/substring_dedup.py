"""Substring dedup: seed and extend over winnowed anchors.

A window is ``length`` consecutive words. Winnowing picks one anchor in every window, the smallest hash of
``seed`` consecutive words, by the window's content alone, so equal windows meet at equal anchors.

1. Seed: every anchor is written with the hash of its context, the stretch of words covered by the windows
   that picked it. Anchors found only once anywhere are done with.
2. Extend: occurrences of an anchor with the same context are equal as far as their windows reach on both
   sides. Where an anchor stands in several contexts, one occurrence of each is extended window by window
   inside the contexts, comparing 128-bit hashes. No occurrences are paired, so n copies cost n rows.
3. The windows found more than once cover, per document, its maximal repeats; their words go.

Only hashes and places are shuffled in 1 and 3. Joins on an anchor that a third of all documents share are
plain sort-merge joins against one row per anchor, which adaptive execution splits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import stored
from lakeload.llm.shingles import WordHashes, _odd_numbers, mix

# A place packs an anchor's word position with the distances to its first and last window.
_STEP = 1 << 12
_ANCHOR = "seed long, ctx long, id long, crc long, place long, n_words long, sha string"


class Winnower:
    """Anchors and window hashes of one document."""

    def __init__(self, length: int, seed: int):
        if not 0 < seed < length <= seed + 63:
            raise ValueError("seed must be shorter than length, by less than 64 words")
        self.length, self.seed, self.words = length, seed, WordHashes()
        self.seed_factors = _odd_numbers(31, seed)
        self.window_factors = [_odd_numbers(s, length) for s in (37, 39)]
        self.base = int(_odd_numbers(41, 1)[0])
        self._powers(1024)

    def _powers(self, count: int) -> None:
        inverse = pow(self.base, -1, 1 << 64)
        self.up = np.concatenate(([np.uint64(1)], np.full(count, self.base, np.uint64))).cumprod(dtype=np.uint64)
        self.down = np.concatenate(([np.uint64(1)], np.full(count, inverse, np.uint64))).cumprod(dtype=np.uint64)

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(seed hash, context hash, place) of each anchor; none in fewer words than a window has."""
        count = len(words) - self.seed + 1
        if len(words) < self.length:
            return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),)
        value = words[:count] * self.seed_factors[0]
        for i in range(1, self.seed):
            value += words[i:i + count] * self.seed_factors[i]
        value = mix(value, 301)
        at = self._smallest(value)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((first[1:], [len(at)])) - 1
        at = at[first]
        if len(words) >= len(self.up):
            self._powers(2 * len(words))
        sums = np.concatenate(([np.uint64(0)], (words * self.up[:len(words)]).cumsum(dtype=np.uint64)))
        end = last + self.length
        context = mix((sums[end] - sums[first]) * self.down[first], 302) ^ mix((end - first).astype(np.uint64), 303)
        return value[at], context, at * _STEP + (at - first) * 64 + (last - first)

    def _smallest(self, value: np.ndarray) -> np.ndarray:
        """Position of the smallest seed hash in each window, the right one of equals."""
        width, low, at, span = self.length - self.seed + 1, value, np.arange(len(value)), 1
        while span < width:
            step = min(span, width - span)
            right = low[step:] <= low[:-step]
            low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
            span += step
        return at

    def windows(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        view = np.lib.stride_tricks.sliding_window_view(words, self.length)[starts]
        return tuple(mix((view * f).sum(axis=1, dtype=np.uint64), 304) for f in self.window_factors)


def first_window(place):
    return place // _STEP - place % _STEP // 64


def last_window(place):
    return first_window(place) + place % 64


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _find_anchors(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(length, seed)
        for batch in batches:
            rows, places = [], []
            for text in batch.column(1):
                body = text.as_py() or b""
                words = body.split()
                found = winnower.anchors(winnower.words(words))
                places.append(found)
                rows.append((zlib.crc32(body), len(words), _digest(words)))
            sizes = [len(p[0]) for p in places]
            owner = np.repeat(np.arange(len(rows)), sizes)
            crc = np.array([r[0] for r in rows], np.int64)
            n = len(owner)
            if n:
                seeds, contexts, at = (np.concatenate(x) for x in zip(*places, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds.view(np.int64)), pa.array(contexts.view(np.int64)),
                     batch.column(0).take(pa.array(owner)), pa.array(crc[owner]), pa.array(at),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], names=_names)
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), batch.column(0), pa.array(crc), pa.nulls(m, pa.int64()),
                 pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names=_names)

    _names = ["seed", "ctx", "id", "crc", "place", "n_words", "sha"]
    return run


def _open_windows(length: int, seed: int):
    """(h1, h2, alone, id, crc, start) for every window of the open contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(length, seed)
        for batch in batches:
            for i in range(batch.num_rows):
                spots = batch.column(3)[i].as_py()
                words = winnower.words((batch.column(2)[i].as_py() or b"").split())
                place = np.array([s["place"] for s in spots], np.int64)
                count = place % 64 + 1
                starts = np.repeat(first_window(place), count) + np.concatenate([np.arange(c) for c in count])
                alone = np.repeat(np.array([s["alone"] for s in spots]), count)
                one, two = winnower.windows(words, starts)
                same = pa.array(np.full(len(starts), i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(alone),
                     batch.column(0).take(same), batch.column(1).take(same), pa.array(starts)],
                    names=["h1", "h2", "alone", "id", "crc", "start"])

    return run


def maximal_spans(ranges, length: int) -> list[tuple[int, int]]:
    """Merged word spans, end exclusive, of windows starting in the given closed ranges."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high + length)
        else:
            out.append([low, high + length])
    return [tuple(x) for x in out]


def _remove(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, ranges in zip(batch["text"], batch["ranges"], strict=True):
                words, spans = text.split(), maximal_spans([(r["low"], r["high"]) for r in ranges], length)
                kept, at = [], 0
                for low, high in spans:
                    kept += words[at:low]
                    at = high
                kept += words[at:]
                rows.append((len(words) - len(kept), _digest(kept), [{"first": a, "end": b} for a, b in spans]))
            if rows:
                out = batch[["id", "crc"]].copy()
                out["n_removed"], out["kept"], out["spans"] = (list(x) for x in zip(*rows, strict=True))
                yield out

    return run


def repeated_passages(docs: DataFrame, length: int = 35, seed: int = 10, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, spans`` for every row of ``docs``.

    Words are split at ASCII blanks and compared as they are. Every word goes that a window covers whose word
    sequence also starts anywhere else, in the same text or another, as the input stands; ``spans`` are the
    removed stretches (``first`` word, ``end`` exclusive) and ``kept_sha256`` is the SHA-256 of the other words
    joined by one space.

    Null and empty texts have no words. Texts shorter than a window keep all. Repeated rows are copies of each
    other. Ids may be null or repeated: a row is known by its id and text. No rows give no rows.
    """
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    found = stored(base.mapInArrow(_find_anchors(length, seed), _ANCHOR), "anchors")
    anchors = found.where("seed is not null").select("seed", "ctx", "id", "crc", "place")
    shared = anchors.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
    anchors = stored(anchors.join(shared, "seed"), "shared")

    contexts = stored(anchors.groupBy("seed", "ctx").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "crc", "place")).alias("one")), "contexts")
    several = contexts.groupBy("seed").agg(F.count("*").alias("kinds")).where("kinds > 1").select("seed")
    spots = contexts.join(several, "seed").select(
        "one.id", "one.crc", F.struct((F.col("n") == 1).alias("alone"), F.col("one.place").alias("place")).alias("spot"))
    whole = anchors.join(contexts.where("n > 1").select("seed", "ctx"), ["seed", "ctx"]).select(
        "id", "crc", first_window_column().alias("low"), last_window_column().alias("high"))

    none = F.lit(None).cast(spots.schema["spot"].dataType)
    concerned = (anchors.select("id", "crc").distinct().withColumn("spot", none).unionByName(spots)
                 .groupBy(F.col("id").alias("of_id"), F.col("crc").alias("of_crc")).agg(F.collect_list("spot").alias("spots")))
    known = base.where("text is not null").withColumn("crc", F.crc32("text"))
    texts = stored(known.join(concerned, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("crc") == F.col("of_crc")))
                   .select("id", "crc", "text", "spots"), "passages")

    windows = stored(texts.where("size(spots) > 0").dropDuplicates(["id", "crc"]).mapInArrow(
        _open_windows(length, seed), "h1 long, h2 long, alone boolean, id long, crc long, start long"), "windows")
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    single = windows.where("alone").join(twice, ["h1", "h2"]).select(
        "id", "crc", F.col("start").alias("low"), F.col("start").alias("high"))
    ranges = (whole.unionByName(single).groupBy(F.col("id").alias("of_id"), F.col("crc").alias("of_crc"))
              .agg(F.collect_list(F.struct("low", "high")).alias("ranges")))
    kept = (texts.join(ranges, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("crc") == F.col("of_crc")))
            .select("id", "crc", "text", "ranges")
            .mapInPandas(_remove(length), "id long, crc long, n_removed long, kept string, spans array<struct<first: long, end: long>>")
            .dropDuplicates(["id", "crc"])
            .select(F.col("id").alias("of_id"), F.col("crc").alias("of_crc"), "n_removed", "kept", "spans"))
    every = found.where("seed is null").select("id", "crc", "n_words", "sha")
    joined = every.join(kept, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("crc") == F.col("of_crc")), "left")
    empty = F.array().cast("array<struct<first: bigint, end: bigint>>")
    return joined.select(
        F.col("id").alias(doc_id), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept", "sha").alias("kept_sha256"), F.coalesce("spans", empty).alias("spans"))


def first_window_column() -> F.Column:
    return F.expr(f"place div {_STEP} - (place % {_STEP}) div 64")


def last_window_column() -> F.Column:
    return first_window_column() + F.expr("place % 64")
