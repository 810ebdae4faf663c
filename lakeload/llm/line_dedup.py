"""Line dedup: lines found in many documents stay in one of them only. DataFrame functions throughout.

Every line is normalised and hashed next to its position. The documents of a hash are counted in two
steps, first per (hash, salt of the document), so that a line in a third of all documents is spread over
many tasks and no group is ever gathered. The totals return to exactly the (hash, salt) cells that exist,
which makes the join back as even as the counting. Each document then receives the positions it loses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import BLANKS, ascii_lower, pack, stored, with_results


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, salts: int = 64,
                        doc_id: str = "doc_id", text: str = "text", n_lines: str = "n_lines",
                        n_dropped: str = "n_dropped") -> DataFrame:
    """All documents with ``text`` rid of repeated lines, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without ASCII blanks at its ends and with A-Z lower-cased. A key of at least
    ``min_chars`` code points in at least ``min_docs`` documents keeps its lines in the largest ``doc_id``
    only. Keys are compared by their 128-bit MD5.

    Null or empty text is one empty line and comes back as empty text. Rows sharing a ``doc_id`` count as
    one document, and null as the smallest id; each row keeps its own lines. Repeated rows stay repeated.
    No rows give no rows. A document all of whose lines go stays, with empty text.
    """
    others = [c for c in docs.columns if c != text]
    body = F.col(f"`{text}`")
    base = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(body).alias("body"), pack(others).alias("row"),
        F.split(F.coalesce(body, F.lit("")), "\n", -1).alias("lines"))
    line = F.btrim(F.col("line"), F.lit(BLANKS))
    hits = stored(
        base.select("id", "body", F.posexplode("lines").alias("pos", "line"))
        .where(F.char_length(line) >= min_chars)
        .select("id", "body", "pos", F.unhex(F.md5(ascii_lower(line))).alias("key")), "lines")
    hits = hits.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))

    cells = (hits.select("key", "salt", "id").distinct()
             .groupBy("key", "salt").agg(F.count("*").alias("n"), F.max("id").alias("last")))
    repeated = (cells.groupBy("key")
                .agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.collect_list("salt").alias("cells"))
                .where(F.col("n") >= min_docs)
                .select("key", "last", F.explode("cells").alias("salt")))
    gone = (hits.join(repeated, ["key", "salt"]).where(~F.col("id").eqNullSafe(F.col("last")))
            .groupBy(F.col("id").alias("gone_id"), F.col("body").alias("gone_body"))
            .agg(F.collect_set("pos").alias("gone")))

    joined = base.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("body") == F.col("gone_body")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    lines = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(kept, lambda i: F.col("lines")[i]))
    joined = joined.withColumn("gone", F.when(F.size("gone") > 0, F.col("gone")))
    return with_results(joined, "row", others, {
        n_lines: F.size("lines").cast("long"),
        n_dropped: F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
        text: F.array_join(lines, "\n")})
