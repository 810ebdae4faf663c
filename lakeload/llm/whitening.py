"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation over distributed rows.

Vectors become whole numbers and are stored once, packed in blocks of rows. Each Lanczos step is one Spark job over the
blocks: every task centres its rows X, multiplies them by a vector and multiplies their transpose by the result; the sums
over blocks, a few numbers per dimension, come back to the driver. Right vectors v are kept there. Left vectors u have
one entry per row and never leave the tasks: each is known by the weights w with u = Xw, so the products with all earlier
left vectors are Wᵀ(Xᵀu) and full reorthogonalisation on both sides costs no further pass. The singular vectors and values
of the small bidiagonal matrix yield components and deviations.

A step whose vector vanishes has met an invariant subspace; it goes on with a random vector orthogonal to all earlier
ones. Steps end when the leading triplets' residuals are at rounding level, at the latest with the last dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import stored

BLOCK_ROWS = 4096
# Beyond this size a whole number has no exact double.
LARGEST = float(1 << 42)
NO_VARIANCE = 1e-10


@dataclass(frozen=True)
class Whitening:
    """Mean, components (one per row, by falling deviation), deviations and shares of the variance of ``n`` vectors."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    steps: int

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n

    def project(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) @ self.components.T / self.deviations


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024,
                  offset: int = 100_000) -> DataFrame:
    """``ids, dims, block``: packed rows of floor(scale * entry) + offset as 64-bit whole numbers.

    Vectors that are null or empty, or hold null, non-finite or huge entries (2^42 and more) are left out, and so are those
    whose length is not the most frequent one (the larger of equals).
    """
    entries = F.col(f"`{vector}`").cast("array<double>")
    wrong = F.exists(entries, lambda c: F.coalesce(~(F.abs(c) < LARGEST), F.lit(True)))
    sound = (vectors.where(F.size(entries) > 0).where(~wrong)
             .select(F.col(f"`{vec_id}`").alias("id"), entries.alias("entries")))
    usual = sound.groupBy(F.size("entries").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = usual["dims"] if usual else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                x = np.floor(scale * flat).astype("<i8") + offset
                ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([dims], pa.int32()), pa.array([x.tobytes()], pa.binary())],
                                                 names=["ids", "dims", "block"])

    kind = sound.schema["id"].dataType.simpleString()
    return stored(sound.where(F.size("entries") == dims).mapInArrow(pack, f"ids array<{kind}>, dims int, block binary"), "blocks")


def _rows(body, dims: int) -> np.ndarray:
    return np.frombuffer(body.as_buffer(), "<i8").reshape(-1, dims)


def _summed(blocks: DataFrame, of_rows: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Entry-wise sum over all blocks of the short array that ``of_rows`` makes of a block's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for dims, body in zip(batch.column(0), batch.column(1), strict=True):
                part = of_rows(_rows(body, dims.as_py()))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "part"])

    sums = (blocks.select("dims", "block").mapInArrow(run, f"at int, part {kind}")
            .groupBy("at").agg(F.sum("part").alias("total")).orderBy("at").collect())
    return np.array([r["total"] for r in sums])


def _orthogonal(basis: list[np.ndarray], dims: int, rng: np.random.Generator) -> np.ndarray:
    fresh = rng.standard_normal(dims)
    for _ in range(2):
        for one in basis:
            fresh = fresh - one * (one @ fresh)
    return fresh / np.linalg.norm(fresh)


def bidiagonalise(product: Callable[[np.ndarray], tuple[np.ndarray, float]], dims: int, wanted: int, total: float,
                  tolerance: float = 1e-14, seed: int = 7) -> tuple[np.ndarray, np.ndarray, int]:
    """(right singular vectors as rows, singular values, steps) of the rows X behind ``product``.

    ``product(p)`` gives Xᵀ(Xp) and the squared length of Xp. ``total`` is the sum of all squared singular values.
    """
    rng = np.random.default_rng(seed)
    right, weights, back, diagonal, upper = [_orthogonal([], dims, rng)], [], [], [], []
    tiny, broken = 1e-13 * np.sqrt(total), False
    while True:
        v = right[-1]
        p = v - upper[-1] * weights[-1] if weights else v
        q, square = product(p)
        while weights:
            # Uᵀ(Xp) = Wᵀ(XᵀXp): what the new left vector still shares with the earlier ones.
            shared = np.array(weights) @ q
            p, q = p - shared @ np.array(weights), q - shared @ np.array(back)
            left_over = square - shared @ shared
            if square <= tiny ** 2 or left_over >= 0.01 * square:
                square = left_over
                break
            # Nearly all of it was shared: what is left must be computed anew to be known at all.
            q, square = product(p)
        alpha = np.sqrt(max(square, 0.0))
        if alpha <= tiny:
            alpha, p, q = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            p, q = p / alpha, q / alpha
        weights.append(p)
        back.append(q)
        diagonal.append(alpha)

        left, values, turned = np.linalg.svd(np.diag(diagonal) + np.diag(upper, 1))
        steps = len(diagonal)
        if steps == dims:
            break
        rest = q - alpha * v
        for _ in range(2):
            rest = rest - (np.array(right) @ rest) @ np.array(right)
        beta = np.linalg.norm(rest)
        if beta <= tiny:
            beta, broken = 0.0, True
        # A closed subspace may lack further copies of a value: then all but the rest of the variance must be found.
        found = steps >= wanted and np.all(beta * np.abs(left[-1, :wanted]) <= tolerance * values[0])
        if found and (not broken or total - values @ values < values[wanted - 1] ** 2 * (1 - 1e-9)):
            break
        right.append(rest / beta if beta else _orthogonal(right, dims, rng))
        upper.append(beta)
    return (turned @ np.array(right))[:wanted], values[:wanted], steps


def fit_whitening(blocks: DataFrame, wanted: int = 8) -> Whitening | None:
    """The leading ``wanted`` components of packed rows; None without rows.

    Components without variance (a deviation of 1e-10 of the first or less) are left out, so fewer may come.
    """
    head = blocks.select("dims").first()
    if head is None:
        return None
    dims = head["dims"]
    counted = _summed(blocks, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    n, sums = int(counted[-1]), counted[:-1]
    mean = sums / n

    def product(p: np.ndarray) -> tuple[np.ndarray, float]:
        def of_rows(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            u = centred @ p
            return np.append(centred.T @ u, u @ u)

        both = _summed(blocks, of_rows)
        return both[:-1], both[-1]

    total = float(_summed(blocks, lambda x: np.array([((x - mean) ** 2).sum()]))[0])
    if total == 0:
        return Whitening(n, sums, np.empty((0, dims)), np.empty(0), np.empty(0), 0)
    vectors, values, steps = bidiagonalise(product, dims, min(wanted, dims), total)
    real = values > NO_VARIANCE * values[0]
    vectors, values = vectors[real], values[real]
    largest = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]
    return Whitening(n, sums, vectors * np.sign(largest)[:, None], values / np.sqrt(n), values ** 2 / total, steps)


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity; 0 without components."""
    count = len(model.components)
    if not count:
        return 0.0
    middle = _summed(blocks, lambda x: model.project(x).sum(axis=0)) / model.n

    def squares(x: np.ndarray) -> np.ndarray:
        centred = model.project(x) - middle
        return (centred.T @ centred).ravel()

    return float(np.abs(_summed(blocks, squares).reshape(count, count) / model.n - np.eye(count)).max())


def _square_sums(y: np.ndarray) -> list[int]:
    """Exact sums of squares per row of 64-bit numbers below 2^48 in size."""
    high, low = y >> 20, y & ((1 << 20) - 1)
    parts = ((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
    return [(int(a) << 40) + (int(b) << 21) + int(c) for a, b, c in zip(*parts, strict=True)]


def whiten(vectors: DataFrame, wanted: int = 8, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, one row per vector and component.

    All sound vectors are fitted on and whitened (see ``whole_vectors`` for those left out). ``deviation`` is the exact sum
    over dimensions of (n * x - S)^2, S being the sums, as decimal(38, 0). The largest entry of each component is positive.

    Fewer components come where there are fewer dimensions or directions with variance; equal vectors, or one alone, have
    none and give no rows, as no vectors do. Among components of equal variance any basis may come. Ids may be of any
    type, null or repeated; repeated rows count and are returned each. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    blocks = whole_vectors(vectors, vec_id, vector)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit_whitening(blocks, wanted)
    if model is None or not len(model.components):
        return spark.createDataFrame([], f"`{vec_id}` {kind}, {schema}")
    error, n, sums = identity_error(blocks, model), model.n, model.sums

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = _rows(batch.column(2)[i], batch.column(1)[i].as_py())
                ids, values = batch.column(0)[i].values, model.project(x)
                whitened = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))
                deviation = pa.array(_square_sums(n * x - sums), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([ids, deviation, whitened], names=["id", "deviation", "whitened"])

    done = blocks.select("ids", "dims", "block").mapInArrow(rows, f"id {kind}, deviation decimal(38,0), whitened array<double>")
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return (done.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select(F.col("id").alias(vec_id), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error")))
