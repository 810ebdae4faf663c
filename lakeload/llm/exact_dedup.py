"""Exact dedup: counting quotient filters find fingerprints seen more than once, bytes decide.

1. One pass over the texts writes a short row per document (fingerprint, length, digests) and, per task, counting
   quotient filters of at most ``filter_rows`` documents each, cut into segments of the fingerprint range.
2. The filters of one segment merge by their sorted remainders, without loss. What comes out are the fingerprints with
   a count above one, once for every filter that holds them: (fingerprint, filter) is a cell.
3. Documents of such cells are read again and compared, byte by byte, with one text of their fingerprint. Texts that
   differ from it, by chance of the hash, are compared among themselves in a further round.

Joins go by cell. A text that a third of all documents share is one entry per filter in 2 and one cell per filter in
3, so no task meets more than ``filter_rows`` of its rows and no group is ever gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm import quotient_filter
from lakeload.llm.common import BLANKS, stored

_BLANKS = BLANKS.encode()
_CONTINUED = bytes(range(0x80, 0xC0))


def _fingerprints(id_type: pa.DataType, filter_rows: int, segment_bits: int):
    names = ["filter", "pos", "fp", "id", "raw", "n_chars", "sha", "segment", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Partition and running number name a filter; the rows are written before anything else reads them.
        number, held, prints = TaskContext.get().partitionId() << 24, 0, []

        def filled() -> pa.RecordBatch:
            found = quotient_filter.build(np.concatenate(prints), segment_bits)
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, id_type),
                 pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                 pa.array([s for s, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], names=names)

        for whole in batches:
            for at in range(0, whole.num_rows, filter_rows):
                batch = whole.slice(at, filter_rows)
                if held and held + batch.num_rows > filter_rows:
                    yield filled()
                    number, held, prints = number + 1, 0, []
                rows = []
                for text in batch.column(1):
                    body = text.as_py() or b""
                    plain = body.translate(None, _BLANKS)
                    rows.append((xxhash.xxh3_64_intdigest(plain), xxhash.xxh3_128_digest(body),
                                 len(body.translate(None, _CONTINUED)), hashlib.sha256(plain).digest()))
                n = len(rows)
                fp = np.array([r[0] for r in rows], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * n, pa.int64()), pa.array(np.arange(held, held + n)), pa.array(fp.view(np.int64)),
                     batch.column(0), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([r[3] for r in rows], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
                held += n
                prints.append(fp)
        if held:
            yield filled()

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells (fingerprint, filter) whose fingerprint was seen more than once; rows arrive sorted by segment."""

    def merged(bodies: list[bytes], filters: list[int]) -> pa.RecordBatch:
        prints, owner, total = quotient_filter.merge(bodies)
        many = total > 1
        return pa.RecordBatch.from_arrays([pa.array(prints[many].view(np.int64)),
                                           pa.array(np.array(filters, np.int64)[owner[many]])], names=["fp", "filter"])

    now, bodies, filters = None, [], []
    for batch in batches:
        for segment, number, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment != now:
                if bodies:
                    yield merged(bodies, filters)
                now, bodies, filters = segment, [], []
            bodies.append(body)
            filters.append(number)
    if bodies:
        yield merged(bodies, filters)


def _plain_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = [text.as_py() or b"" for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([xxhash.xxh3_128_digest(b) for b in bodies], pa.binary()),
             pa.array([b.translate(None, _BLANKS) for b in bodies], pa.binary())], names=["of_id", "of_raw", "plain"])


def _verified(texts: DataFrame) -> DataFrame:
    """``id, raw, round`` for every text; texts of a fingerprint are equal where they end in the same round."""
    done = None
    for number in range(1 << 30):
        one = texts.groupBy("fp").agg(F.min(F.struct("filter", "pos")).alias("one"))
        chosen = (texts.join(one.select("fp", "one.filter", "one.pos"), ["fp", "filter", "pos"])
                  .select("fp", F.col("plain").alias("chosen")))
        cells = texts.select("fp", "filter").distinct().join(chosen, "fp")
        equal = F.col("plain") == F.col("chosen")
        judged = stored(texts.join(cells, ["fp", "filter"]).select(
            "fp", "filter", "pos", "id", "raw", F.when(~equal, F.col("plain")).alias("plain")), "judged")
        agreed = judged.where("plain is null").select("id", "raw", F.lit(number).alias("round"))
        done = agreed if done is None else done.unionAll(agreed)
        texts = judged.where("plain is not null")
        if texts.isEmpty():
            return done


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_rows: int = 1 << 18,
                     segment_bits: int = 12) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when they are the same bytes once all ASCII blanks are deleted. Of equal texts the row with the most
    code points in its original text stays, then the one with the smallest id (null after all others), and of rows that
    still tie any single one. ``text_sha256`` is that of the text without blanks.

    Null text counts as empty; all empty and blank texts are one group. Ids may be of any type with an order, null or
    repeated. Repeated rows count one by one and one of them stays. Other columns are not looked at, so none can clash.
    No rows give no rows. A segment holds one in ``2 ** segment_bits`` of all fingerprints in one task: 12 million,
    about 300 MB, for 50,000 million documents.
    """
    base = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    kind = base.schema["id"].dataType
    schema = (f"filter long, pos long, fp long, id {kind.simpleString()}, raw binary, n_chars long, sha binary, "
              "segment int, body binary")
    found = stored(base.mapInArrow(_fingerprints(_arrow_type(kind), filter_rows, segment_bits), schema), "fingerprints")
    rows = found.where("segment is null").drop("segment", "body")
    cells = stored(found.where("segment is not null").select("segment", "filter", "body")
                   .repartition("segment").sortWithinPartitions("segment").mapInArrow(_repeated, "fp long, filter long"), "repeated")

    routed = rows.join(cells, ["fp", "filter"])
    keys = (routed.groupBy("id", "raw", "fp").agg(F.min(F.struct("filter", "pos")).alias("one"))
            .select("id", "raw", "fp", "one.filter", "one.pos"))
    plain = base.mapInArrow(_plain_texts, f"of_id {kind.simpleString()}, of_raw binary, plain binary")
    texts = stored(plain.join(keys, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("raw") == F.col("of_raw")))
                   .select("fp", "filter", "pos", "id", "raw", "plain"), "texts")
    judged = _verified(texts.dropDuplicates(["fp", "filter", "pos"]))

    same = judged.select(F.col("id").alias("of_id"), F.col("raw").alias("of_raw"), "round")
    members = stored(
        routed.join(same, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("raw") == F.col("of_raw")))
        .select("fp", "round", "filter", "pos", "id", "n_chars", "sha"), "members")
    order = F.struct((-F.col("n_chars")).alias("chars"), F.col("id").isNull().alias("no_id"), "id", "filter", "pos")
    groups = (members.groupBy("fp", "round")
              .agg(F.count("*").alias("group_size"), F.min(order).alias("best"), F.collect_set("filter").alias("filters"))
              .select("fp", "round", "group_size", "best", F.explode("filters").alias("filter")))
    kept = (F.col("filter") == F.col("best.filter")) & (F.col("pos") == F.col("best.pos"))
    several = members.join(groups, ["fp", "round", "filter"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"), "sha")
    single = rows.join(cells, ["fp", "filter"], "left_anti").select(
        F.col("id").alias("doc_id"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    return several.unionAll(single).select(
        F.col("doc_id").alias(doc_id), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
