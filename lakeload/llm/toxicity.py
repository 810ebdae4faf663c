"""Toxicity by weak supervision.

Voters are lexicon terms (words and word beginnings: a fixed seed list and terms that labelled rows show to
be telling) and patterns of spelling. A generative label model fits each voter's firing rates in the two
classes by expectation maximisation and lowers the weight of voters whose votes stay correlated within a
class. A logistic regression is then trained on its posterior labels and scores every document. It does not
see votes but counts: how often each word and each word beginning of three to eight bytes stands in a text,
for up to ``MAX_TERMS`` of them. Several rare words of one stem thus tell, where each alone does not. Its
scores are calibrated on labelled rows that the fit at hand has not seen.

Fitting uses samples with fixed bounds (``max_labelled``, ``max_unlabelled`` rows, the smallest hashes of
the id); what reaches the driver are at most ``MAX_TERMS`` terms, ranked in Spark, and, per sampled document, its
counts of them as packed numbers. Scoring reads each whole text once and shuffles nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import stored

# Common English insults, which vote from the start.
SEED_TERMS = ("asshole", "bastard", "bitch", "clown", "coward", "cretin", "crap", "disgusting", "dumb", "fool", "freak",
              "garbage", "idiot", "imbecile", "jerk", "liar", "loser", "moron", "nasty", "pathetic", "pig", "scum", "shit",
              "stupid", "trash", "ugly", "vile", "worthless")
PREFIXES = (3, 4, 5, 6, 7, 8)
MAX_TERMS = 20_000
LEAST_ROWS = 3
HELD_TERMS = 200_000
MAX_VOTERS = 300
PATTERNS = 4
SEED_WEIGHT = 2.0
FOLDS = 3
_WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None, lengths: tuple[int, ...] = PREFIXES) -> set[bytes]:
    """Distinct lower-cased words, and beginnings of longer ones marked with ``*``."""
    words = set((text or b"").lower().translate(_WORDS).split())
    found = set(words)
    for n in lengths:
        found.update([w[:n] + b"*" for w in words if len(w) > n])
    return found


def counts_of(text: bytes | None, wanted, lengths: tuple[int, ...] = PREFIXES) -> dict[bytes, int]:
    """How often each wanted word, and word beginning, stands in a text."""
    found: dict[bytes, int] = {}
    for word, n in Counter((text or b"").lower().translate(_WORDS).split()).items():
        if word in wanted:
            found[word] = n
        for length in lengths:
            if len(word) <= length:
                break
            start = word[:length] + b"*"
            if start in wanted:
                found[start] = found.get(start, 0) + n
    return found


def patterns_of(text: bytes | None) -> list[float]:
    """Shouting, many exclamation marks, many symbols, much repetition."""
    text = text or b""
    letters = len(text) or 1
    words = text.split()
    upper = letters - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    symbols = letters - len(text.translate(None, b"!#$%&*@^"))
    return [float(upper > 0.4 * letters), float(text.count(b"!") > 3), float(symbols > 0.1 * letters),
            float(len(words) > 20 and len(set(words)) < 0.2 * len(words))]


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of terms and patterns, with what the label model found for each voter."""
    weights: dict[bytes, float]
    patterns: tuple[float, ...]
    bias: float
    voters: tuple[tuple[str, float, float, float], ...]  # term, rate if toxic, rate if not, weight for correlation

    def score(self, text: bytes | None) -> float:
        return self._score(text, self.lengths())

    def lengths(self) -> tuple[int, ...]:
        """Lengths of the beginnings that carry a weight."""
        return tuple(n for n in PREFIXES if any(t.endswith(b"*") and len(t) == n + 1 for t in self.weights))

    def _score(self, text: bytes | None, lengths: tuple[int, ...]) -> float:
        found = counts_of(text, self.weights, lengths)
        total = self.bias + sum(sorted(self.weights[t] * np.log1p(n) for t, n in found.items()))
        total += sum(w * x for w, x in zip(self.patterns, patterns_of(text), strict=True))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))

    def scores(self, texts: pd.Series) -> pd.Series:
        lengths = self.lengths()
        return pd.Series([self._score(t, lengths) for t in texts], dtype="float64")


def label_model(votes: np.ndarray, labels: np.ndarray, seeds: np.ndarray, rounds: int = 25):
    """Posterior of class 1 per row, and per voter its two firing rates and its correlation weight.

    ``votes`` holds 0 or 1, ``labels`` 0, 1 or -1 (unknown), ``seeds`` marks rows with a seed term. A known label
    is right in 98 of 100 cases, whatever the voters say: most toxic rows of a small language meet none of them.
    """
    known = labels >= 0
    q = np.where(known, np.where(labels == 1, 0.98, 0.02), np.where(seeds, 0.9, 0.05))
    weight = np.ones(votes.shape[1])
    # Where labels of both classes are at hand, rows without one count for a quarter of them together:
    # else a pair of voters that copy each other would become the class.
    anchored = (labels == 1).sum() >= 5 and (labels == 0).sum() >= 5
    share = min(1.0, 0.25 * known.sum() / max(1, (~known).sum())) if anchored else 1.0
    count = np.where(known, 1.0, share)
    for turn in range(rounds):
        use = count * known if anchored and turn == 0 else count
        rate1 = ((use * q) @ votes + 0.5) / ((use * q).sum() + 1)
        rate0 = ((use * (1 - q)) @ votes + 0.5) / ((use * (1 - q)).sum() + 1)
        rest = votes - (q[:, None] * rate1 + (1 - q)[:, None] * rate0)
        spread = np.sqrt((rest ** 2).mean(axis=0)) + 1e-9
        related = np.abs((rest.T @ rest) / max(1, len(votes)) / spread[:, None] / spread[None, :])
        weight = 1 / np.maximum(1.0, np.where(related > 0.2, related, 0).sum(axis=1))
        prior = np.clip((count * q).sum() / max(1e-9, count.sum()), 1e-3, 0.5)
        gain1 = weight * np.log(rate1 / rate0)
        gain0 = weight * np.log((1 - rate1) / (1 - rate0))
        found = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + votes @ gain1 + (1 - votes) @ gain0, -50, 50)))
        q = np.where(known, q, found)
    return q, rate1, rate0, weight


def logistic(row: np.ndarray, term: np.ndarray, value: np.ndarray, target: np.ndarray, weight: np.ndarray, expected: np.ndarray,
             ridge: float = 1e-4, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, from sparse entries (row, term, value).

    Gradient steps with momentum and a step size per weight. A term's weight is learned in units of the logarithm by which
    its mean value differs between the classes; terms that speak for class 1 by less than a factor of two have none.
    The ridge pulls weights towards ``expected``, which is what a term that never occurs keeps.
    """
    n_terms, mass = len(expected), max(1e-9, weight.sum())
    one, two = target * weight, (1 - target) * weight
    mean1 = np.bincount(term, value * one[row], n_terms) / max(1e-9, one.sum()) + 0.02
    mean0 = np.bincount(term, value * two[row], n_terms) / max(1e-9, two.sum()) + 0.02
    unit = np.log(mean1 / mean0)
    unit = np.where(unit > 0.7, unit, np.where(expected > 0, 1.0, 0.0))
    goal = np.divide(expected, unit, out=np.zeros(n_terms), where=unit > 0)
    # Entries of terms without a weight change nothing.
    used = unit[term] != 0
    row, term = row[used], term[used]
    scaled = value[used] * unit[term]
    w = np.append(goal, np.log(max(1e-3, one.sum()) / max(1e-3, two.sum())))
    speed, size = np.zeros(n_terms + 1), np.zeros(n_terms + 1)
    rate = np.append(np.full(n_terms, 0.02), 0.05)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, scaled * w[term], len(target)) + w[-1], -50, 50)))
        slope = weight * (p - target) / mass
        full = np.append(np.bincount(term, scaled * slope[row], n_terms) + ridge * (w[:-1] - goal), slope.sum())
        speed, size = 0.9 * speed + 0.1 * full, 0.999 * size + 0.001 * full ** 2
        w = w - rate * (speed / (1 - 0.9 ** step)) / (np.sqrt(size / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1] * unit, float(w[-1])


def calibration(scores: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift that turn scores into log odds of the labels, by Newton steps."""
    slope, shift = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slope * scores + shift, -50, 50)))
        spread = p * (1 - p) + 1e-6
        curve = np.array([[(spread * scores * scores).sum() + 1.0, (spread * scores).sum()],
                          [(spread * scores).sum(), spread.sum() + 1e-3]])
        off = np.array([((p - labels) * scores).sum() + slope - 1.0, (p - labels).sum()])
        change = np.linalg.solve(curve, off)
        slope, shift = slope - change[0], shift - change[1]
        if np.abs(change).max() < 1e-9:
            break
    # Scores that do not rise with the labels stay as they are.
    return (slope, shift) if slope > 0.1 else (1.0, 0.0)


def _rows_with(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``term, toxic, clean``: in how many rows of either label a term stands, in parts of bounded size."""
    seen: dict[bytes, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            for term in terms_of(text):
                seen.setdefault(term, [0, 0])[label] += 1
            if len(seen) > HELD_TERMS:
                yield _frame(seen)
                seen.clear()
    if seen:
        yield _frame(seen)


def _frame(seen: dict[bytes, list[int]]) -> pd.DataFrame:
    return pd.DataFrame({"term": list(seen), "toxic": [n[1] for n in seen.values()], "clean": [n[0] for n in seen.values()]})


def _ranked(sample: DataFrame, toxic: int, clean: int) -> DataFrame:
    """``term, telling``: the ``MAX_TERMS`` terms that speak most surely for label 1, surest first."""
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    c, d = toxic - F.col("toxic") + 0.5, clean - F.col("clean") + 0.5
    return (sample.where("label >= 0").select("text", "label")
            .mapInPandas(_rows_with, "term binary, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= LEAST_ROWS)
            .withColumn("odds", F.log(a / c) - F.log(b / d)).where("odds > 0")
            .withColumn("z", F.col("odds") / F.sqrt(1 / a + 1 / c + 1 / b + 1 / d))
            .orderBy(F.desc("z"), "term").limit(MAX_TERMS).select("term", F.expr("odds >= 2 and z >= 2").alias("telling")))


def _counts(terms: list[bytes]):
    """Per row the numbers of its terms, their counts (32 bits each) and the patterns, as bytes."""
    number = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.array(sorted((number[t], n) for t, n in counts_of(x, number).items()), "<i4").reshape(-1, 2)
                     for x in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"], "label": batch["label"], "terms": [f[:, 0].tobytes() for f in found],
                "counts": [f[:, 1].tobytes() for f in found],
                "patterns": [np.array(patterns_of(x), "<f8").tobytes() for x in batch["text"]]},
                columns=["id", "label", "terms", "counts", "patterns"])

    return run


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_labelled: int,
            max_unlabelled: int) -> DataFrame:
    """``id, label, text``; label -1 where unknown. One row per id."""
    known = (labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
             .where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label")))
    by_hash = F.xxhash64(F.lit("sample"), "id")
    learn = known.where(~held_out(F.col("id"))).orderBy(by_hash, "id").limit(max_labelled)
    others = (docs.select(F.col(f"`{doc_id}`").alias("id")).where("id is not null").distinct()
              .orderBy(by_hash, "id").limit(2 * max_unlabelled))
    unknown = (others.join(known.select("id"), "id", "left_anti").orderBy(by_hash, "id").limit(max_unlabelled)
               .withColumn("label", F.lit(-1)))
    ids = learn.unionByName(unknown)
    body = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    # At most max_labelled + max_unlabelled ids of a few bytes each.
    joined = body.join(F.broadcast(ids), "id")
    return stored(joined.groupBy("id").agg(F.min("label").alias("label"), F.min("text").alias("text")), "toxic")


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000, max_unlabelled: int = 2000,
                 doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Fit on a bounded sample. Rows held out (see :func:`held_out`) lend no labels.

    Without toxic labels the seed terms alone vote. Null labels are unknown; of several labels of one id
    the larger counts; a labelled id without document is ignored.
    """
    sample = _sample(docs, labels, doc_id, text, label, max_labelled, max_unlabelled)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)

    seeds = [t.encode() for t in SEED_TERMS]
    mined = [(bytes(r["term"]), r["telling"]) for r in _ranked(sample, toxic, clean).collect()]
    mined = [(t, yes) for t, yes in mined if t not in seeds]
    terms = seeds + [t for t, _ in mined]
    telling = list(range(len(seeds))) + [len(seeds) + i for i, (_, yes) in enumerate(mined) if yes][:10 * MAX_VOTERS]

    kind = sample.schema["id"].dataType.simpleString()
    rows = sample.select("id", "label", "text").mapInPandas(
        _counts(terms), f"id {kind}, label int, terms binary, counts binary, patterns binary").orderBy("id").collect()
    n = len(rows)
    if not n:
        rates = tuple((t.decode(), 0.5, 0.5, 1.0) for t in seeds)
        return ToxicityModel({t: SEED_WEIGHT for t in seeds}, (0.0,) * PATTERNS, -2.0, rates)
    marks = np.array([r["label"] for r in rows], dtype=int)
    row = np.repeat(np.arange(n), [len(r["terms"]) // 4 for r in rows])
    term = np.frombuffer(b"".join(r["terms"] for r in rows), "<i4").astype(np.int64)
    value = np.log1p(np.frombuffer(b"".join(r["counts"] for r in rows), "<i4"))
    shapes = np.frombuffer(b"".join(r["patterns"] for r in rows), "<f8").reshape(-1, PATTERNS)
    del rows

    def votes_of(wanted: list[int], of: np.ndarray) -> np.ndarray:
        """Votes (0 or 1) of the terms ``wanted``, a column each, on the rows ``of``."""
        column, line = np.full(len(terms), -1), np.full(n, -1)
        column[wanted], line[of] = np.arange(len(wanted)), np.arange(len(of))
        fits = (column[term] >= 0) & (line[row] >= 0)
        votes = np.zeros((len(of), len(wanted)), np.float32)
        votes[line[row[fits]], column[term[fits]]] = 1
        return votes

    chosen = _distinct_voters(votes_of(telling, np.flatnonzero(marks == 1)), len(seeds))
    votes = votes_of([telling[j] for j in chosen], np.arange(n)).astype(np.float64)
    posterior, rate1, rate0, trust = label_model(np.hstack([votes, shapes]), marks, votes[:, :len(seeds)].any(axis=1))

    # Patterns are four terms more. Rows without a label weigh as much together as a quarter of those with one.
    known = marks >= 0
    weight = np.where(known, 1.0, min(1.0, 0.25 * known.sum() / max(1, (~known).sum())) if toxic and clean else 1.0)
    at, which = np.nonzero(shapes)
    row, term, value = np.append(row, at), np.append(term, which + len(terms)), np.append(value, shapes[at, which])
    expected = np.where(np.arange(len(terms) + PATTERNS) < len(seeds), SEED_WEIGHT, 0.0)
    w, bias = logistic(row, term, value, posterior, weight, expected)
    slope, shift = 1.0, 0.0
    if min(toxic, clean) >= 10 * FOLDS:
        fold, unseen = np.arange(n) % FOLDS, np.zeros(n)
        for k in range(FOLDS):
            w_k, bias_k = logistic(row, term, value, posterior, np.where(fold == k, 0.0, weight), expected)
            unseen[fold == k] = (np.bincount(row, value * w_k[term], n) + bias_k)[fold == k]
        slope, shift = calibration(unseen[known], (marks[known] == 1).astype(float))
    w, bias = w * slope, bias * slope + shift
    names = [terms[telling[j]] for j in chosen]
    return ToxicityModel(
        {t: float(x) for t, x in zip(terms, w[:len(terms)], strict=True) if abs(x) > 1e-3}, tuple(float(x) for x in w[len(terms):]), float(bias),
        tuple((t.decode(errors="replace"), float(a), float(b), float(c))
              for t, a, b, c in zip(names, rate1, rate0, trust, strict=False)))


def _distinct_voters(votes: np.ndarray, seeds: int) -> list[int]:
    """Seeds, then terms in order unless they fire on nearly the same toxic rows as an earlier voter.

    A telling beginning makes every longer one that always follows it look telling too; such a family is one
    voter. A term that fires on few of an earlier voter's rows is kept: it may be the more precise one.
    """
    chosen = list(range(seeds))
    fired = votes.sum(axis=0)
    for j in range(seeds, votes.shape[1]):
        both = votes[:, chosen].T @ votes[:, j]
        if not (both >= 0.9 * np.maximum(fired[chosen], fired[j])).any():
            chosen.append(j)
            if len(chosen) >= MAX_VOTERS:
                break
    return chosen


def score_toxicity(docs: DataFrame, model: ToxicityModel, score: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the probability of toxicity; null and empty text score as no evidence does. Rows in, rows out."""
    run = F.pandas_udf(lambda texts: model.scores(texts), "double")
    return docs.withColumn(score, run(F.col(f"`{text}`").cast("binary")))
