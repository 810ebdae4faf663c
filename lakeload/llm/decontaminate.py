"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

Every document is cut into overlapping passages, twice as long as the longest item, so that each place in
it lies in a passage that could hold a whole item. A passage is a query: all items whose BM25 score reaches
``threshold`` of the score they have with themselves are retrieved. A hit counts only if enough of the
word sequences of the item's question and of its answer stand in the passage.

Two exact bounds keep the search cheap. Per item, the least telling words that together could not decide
(``SLACK``) are left out; a document, and then a passage, whose other words cannot reach the threshold is
never searched. Within the search, blocks of postings whose largest impact cannot reach it are skipped.

The index travels to the tasks, one shard of at most ``shard_items`` items at a time, so its size has a
fixed bound however large the benchmark is; term statistics always cover all items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
BLOCK = 16
SLACK = 0.3
_WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(_WORDS).split()


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """An item's words in two parts: after the last sentence or line end that leaves both at least three
    words, else after two thirds of them."""
    body = text.strip()
    for at in sorted((i for i in range(len(body)) if body[i:i + 1] in (b".", b"?", b"!", b"\n")), reverse=True):
        first, second = words_of(body[:at]), words_of(body[at:])
        if len(first) >= 3 and len(second) >= 3:
            return first, second
    words = words_of(body)
    cut = max(1, 2 * len(words) // 3)
    return words[:cut], words[cut:]


def sequences(words: list[bytes], width: int = 3) -> set[tuple[bytes, ...]]:
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def overlap(part: set, words: list[bytes]) -> float:
    """Share of the word sequences ``part`` that stand in ``words``; 1 for an empty part."""
    if not part:
        return 1.0
    width = len(next(iter(part)))
    return len(part & {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}) / len(part)


@dataclass
class _Postings:
    items: list[int]
    impacts: list[float]
    block_max: list[float]
    most: float


class ItemIndex:
    """Inverted index with impacts divided by each item's score with itself, so that one threshold fits all."""

    def __init__(self, items: list[tuple[int, bytes]], df: dict[bytes, int], count: int, mean_words: float,
                 threshold: float, min_overlap: float):
        self.threshold, self.min_overlap = threshold, min_overlap
        self.ids, self.parts, self.longest = [], [], 1
        lists: dict[bytes, list[tuple[int, float]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            number = len(self.ids)
            self.ids.append(item_id)
            self.parts.append(tuple(sequences(p) for p in question_and_answer(text)))
            self.longest = max(self.longest, len(words))
            norm = K1 * (1 - B + B * len(words) / mean_words)
            impact = {w: math.log(1 + (count - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm)
                      for w, n in Counter(words).items()}
            total = sum(impact.values())
            for word in sorted(impact):
                lists.setdefault(word, []).append((number, impact[word] / total))
        self.vocabulary = {w: i for i, w in enumerate(sorted(lists))}
        self.postings = []
        for word in sorted(lists):
            numbers, impacts = (list(x) for x in zip(*lists[word], strict=True))
            self.postings.append(_Postings(numbers, impacts, [
                max(impacts[i:i + BLOCK]) for i in range(0, len(impacts), BLOCK)], max(impacts)))
        self._telling()

    def _telling(self) -> None:
        """Flat arrays of the postings that may decide; the others of an item sum to at most ``SLACK``."""
        own: list[list[tuple[float, int]]] = [[] for _ in self.ids]
        for term, p in enumerate(self.postings):
            for item, impact in zip(p.items, p.impacts, strict=True):
                own[item].append((impact, term))
        rest, telling = np.zeros(len(self.ids)), [[] for _ in self.postings]
        for item, impacts in enumerate(own):
            for impact, term in sorted(impacts):
                if rest[item] + impact <= SLACK:
                    rest[item] += impact
                else:
                    telling[term].append((item, impact))
        self.need = self.threshold - rest - 1e-9
        sizes = np.array([len(t) for t in telling], dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        self.flat_item = np.array([i for t in telling for i, _ in t], dtype=np.int64)
        self.flat_impact = np.array([x for t in telling for _, x in t], dtype=np.float64)

    def _sums(self, groups: np.ndarray, terms: np.ndarray, count: int) -> np.ndarray:
        """Telling impacts per (group, item) of distinct (group, term) pairs."""
        sizes = self.start[terms + 1] - self.start[terms]
        at = np.repeat(self.start[terms] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        cell = np.repeat(groups, sizes) * len(self.ids) + self.flat_item[at]
        return np.bincount(cell, self.flat_impact[at], count * len(self.ids)).reshape(count, len(self.ids))

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items scoring at least the threshold for these distinct terms, by block-max WAND."""
        cursors = [[self.postings[t], 0] for t in terms]
        found, floor = [], self.threshold - 1e-9
        while True:
            cursors = [c for c in cursors if c[1] < len(c[0].items)]
            cursors.sort(key=lambda c: c[0].items[c[1]])
            reach, pivot = 0.0, None
            for i, (postings, _) in enumerate(cursors):
                reach += postings.most
                if reach >= floor:
                    pivot = i
                    break
            if pivot is None:
                return found
            item = cursors[pivot][0].items[cursors[pivot][1]]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0].items[cursors[pivot + 1][1]] == item:
                pivot += 1
            ahead = cursors[:pivot + 1]
            bound, following = 0.0, None
            for c in ahead:
                self._shallow(c, item)
                block = c[1] // BLOCK
                if c[1] < len(c[0].items):
                    bound += c[0].block_max[block]
                    last = c[0].items[min(len(c[0].items), (block + 1) * BLOCK) - 1]
                    following = last if following is None else min(following, last)
            if bound < floor:
                target = item + 1 if following is None else max(item, following) + 1
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0].items[cursors[pivot + 1][1]])
                for c in ahead:
                    self._advance(c, max(target, item + 1))
                continue
            score = 0.0
            for c in ahead:
                self._advance(c, item)
                if c[1] < len(c[0].items) and c[0].items[c[1]] == item:
                    score += c[0].impacts[c[1]]
                    c[1] += 1
            if score >= floor:
                found.append((item, score))

    @staticmethod
    def _shallow(cursor: list, item: int) -> None:
        """Skip whole blocks that end before ``item``."""
        items, at = cursor[0].items, cursor[1]
        while at < len(items) and items[min(len(items), (at // BLOCK + 1) * BLOCK) - 1] < item:
            at = (at // BLOCK + 1) * BLOCK
        cursor[1] = at

    @staticmethod
    def _advance(cursor: list, item: int) -> None:
        ItemIndex._shallow(cursor, item)
        items, at = cursor[0].items, cursor[1]
        while at < len(items) and items[at] < item:
            at += 1
        cursor[1] = at

    def hits(self, text: bytes | None) -> list[tuple[int, float, float, float]]:
        """(item id, score, question overlap, answer overlap): the best verified passage of each item."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        known = np.fromiter((self.vocabulary.get(w, -1) for w in words), np.int64, len(words))
        inside = np.unique(known[known >= 0])
        if not (self._sums(np.zeros(len(inside), np.int64), inside, 1) >= self.need).any():
            return []
        stride, best = self.longest, {}
        starts = list(range(0, max(1, len(words) - stride), stride))
        pieces = [np.unique(p[p >= 0]) for p in (known[s:s + 2 * stride] for s in starts)]
        for at in range(0, len(pieces), 256):
            some = pieces[at:at + 256]
            groups = np.repeat(np.arange(len(some)), [len(p) for p in some])
            open_ = (self._sums(groups, np.concatenate(some), len(some)) >= self.need).any(axis=1)
            for i in np.flatnonzero(open_):
                passage = words[starts[at + i]:starts[at + i] + 2 * stride]
                for item, score in self.search(some[i].tolist()):
                    question, answer = (overlap(p, passage) for p in self.parts[item])
                    if min(question, answer) >= self.min_overlap:
                        best[item] = max(best.get(item, (0.0,)), (score, question, answer))
        return [(self.ids[item], *best[item]) for item in sorted(best)]


def _item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        terms = [(i, len(words), w) for i, text in zip(batch["shard"], batch["text"], strict=True)
                 for words in [words_of(text)] for w in set(words)]
        if terms:
            yield pd.DataFrame(terms, columns=["shard", "n", "term"])


def item_indexes(items: DataFrame, threshold: float, min_overlap: float, shard_items: int, item_id: str,
                 text: str) -> Iterator[ItemIndex]:
    """One index per shard of items."""
    body = items.select(F.col(f"`{item_id}`").cast("long").alias("item"),
                        F.col(f"`{text}`").cast("binary").alias("text")).where("text is not null").distinct()
    count = body.count()
    if not count:
        return
    shards = -(-count // shard_items)
    body = body.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards)))
    terms = body.select("shard", "text").mapInPandas(_item_terms, "shard long, n long, term binary")
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    lengths = F.size(F.filter(F.split(F.col("text").cast("string"), r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"), lambda w: w != ""))
    mean = body.agg(F.avg(lengths)).first()[0] or 1.0
    for shard in range(shards):
        own = body.where(F.col("shard") == shard)
        counts = df.join(terms.where(F.col("shard") == shard).select("term").distinct(), "term")
        yield ItemIndex([(r["item"], bytes(r["text"])) for r in own.orderBy("item", "text").collect()],
                        {bytes(r["term"]): r["df"] for r in counts.collect()}, count, mean, threshold, min_overlap)


def benchmark_hits(docs: DataFrame, items: DataFrame, hits: str = "hits", threshold: float = 0.6,
                   min_overlap: float = 0.6, shard_items: int = 20_000, item_id: str = "item_id",
                   text: str = "text") -> DataFrame:
    """``docs`` with ``hits``: per test item found, ``item_id, score, question_overlap, answer_overlap``.

    Words are runs of ASCII letters, digits and other characters, A-Z lower-cased. Null and empty
    texts, items without words and an empty benchmark give empty lists; repeated items count once, items with
    equal text are all reported. Rows in, rows out.
    """
    kind = "array<struct<item_id: bigint, score: double, question_overlap: double, answer_overlap: double>>"
    found = [F.coalesce(_searcher(index, kind)(F.col(f"`{text}`").cast("binary")), F.array().cast(kind))
             for index in item_indexes(items, threshold, min_overlap, shard_items, item_id, text)]
    return docs.withColumn(hits, F.flatten(F.array(*found)) if found else F.array().cast(kind))


def _searcher(index: ItemIndex, kind: str):
    names = ("item_id", "score", "question_overlap", "answer_overlap")

    @F.pandas_udf(kind)
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, h, strict=True)) for h in index.hits(t)] for t in texts], dtype=object)

    return search
