"""N-gram Jaccard join with PartEnum signatures.

Two sets of similarity ``s`` or more lie in the same or in neighbouring size bands and differ in at most
``(r + s) (1 - s) / (1 + s)`` elements. For each band the domain of shingles is hashed into more partitions
than that bound, so similar sets agree on at least one partition, and what a set has in it is the signature:
the enumeration of PartEnum with all but one partition left free. A set signs for its own band and, as
the smaller partner, for the next one. Two rules keep this exact:

* an empty partition signs nothing as long as a set has more partitions in use than it may differ in;
  a set with fewer signs its empty ones too;
* words are hashed to 64 bits and what shares a signature is compared on the texts themselves.

Signatures are shuffled and sorted once, straight from the texts, and the descriptions of the sets travel with them; a
signature held by one set only is done with and never written. In the other buckets
members are told apart by counts of their elements in hash ranges: the counts of similar sets differ by no
more than the sets may, so a passage that many different texts share gives no candidates. Finer counts are
compared before any text is fetched. A bucket links its
members to the one nearest its centre, and other pairs follow directly if they are few. A bucket with many
more (a group of near copies) is looked at again when the components of the first links are known, and then
only for pairs of different components. So no group is ever turned into all its pairs.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import stored
from lakeload.llm.components import connected_components
from lakeload.llm.shingles import Shingler, mix

NO_ID = 2 ** 63 - 1
COARSE, FINE = 64, 256
ROWS_AT_ONCE = 500_000
SHARED = ["of_set", "sig", "id", "n", "c1", "c2", "coarse", "fine"]
BLOCK = 256


class Bands:
    """Size bands and, per band, the number of partitions for the similarity ``num / den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.first = [1]

    def of(self, size: int) -> int:
        while self.last(len(self.first) - 1) < size:
            self.first.append(self.last(len(self.first) - 1) + 1)
        return int(np.searchsorted(self.first, size, side="right")) - 1

    def last(self, band: int) -> int:
        while len(self.first) <= band:
            self.first.append(self.first[-1] * self.den // self.num + 1)
        return self.first[band] * self.den // self.num

    def differ(self, sizes: int) -> int:
        """Most elements in which two similar sets of this total size can differ."""
        return sizes * (self.den - self.num) // (self.den + self.num)

    def partitions(self, band: int) -> int:
        bound = self.differ(2 * self.last(band)) + 1
        return 1 if bound == 1 else bound + bound // 10 + 3


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of a non-empty set."""
    size, out = len(shingles), []
    own = bands.of(size)
    for band in (own, own + 1):
        parts = bands.partitions(band)
        place = (mix(shingles, 101 + band) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        place = place.astype(np.int64)
        value = mix(shingles, 102 + band)
        low = np.bincount(place, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), parts).astype(np.uint64)
        high = np.bincount(place, (value >> np.uint64(32)).astype(np.float64), parts).astype(np.uint64)
        signature = mix(low + (high << np.uint64(32)), 103) ^ mix(np.arange(parts, dtype=np.uint64), 104 + band)
        used = np.bincount(place, minlength=parts) > 0
        partner = min(bands.last(band), size * bands.den // bands.num)
        if used.sum() > bands.differ(size + partner):
            signature = signature[used]
        out.append(signature)
    return np.concatenate(out)


def counts_in_ranges(shingles: np.ndarray, ranges: int) -> bytes:
    """Elements per hash range, one byte each. Their differences never exceed those of the sets."""
    place = (mix(shingles, 203) >> np.uint64(64 - ranges.bit_length() + 1)).astype(np.int64)
    return np.minimum(np.bincount(place, minlength=ranges), 255).astype(np.uint8).tobytes()


def _describe(width: int, num: int, den: int):
    """(sig, id, info): every signature of every set, and one row per text with ``info``.

    That holds the size of its set, two sums that tell sets apart, and counts in hash ranges; its ``sig`` is a mere number
    that spreads such rows. Of equal sets within a task only the first one signs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bands, seen, row = Shingler(width), Bands(num, den), set(), 0
        for batch in batches:
            ids, infos, holders, sigs, held = [], [], [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shingles = shingler(text.as_py())
                key = (len(shingles), int(mix(shingles, 201).sum(dtype=np.uint64)), int(mix(shingles, 202).sum(dtype=np.uint64)))
                ids.append(doc)
                infos.append(np.array(key, "<u8").tobytes() + counts_in_ranges(shingles, FINE))
                if key not in seen and len(shingles):
                    sigs.append(signatures(shingles, bands))
                    holders.append((doc, len(sigs[-1])))
                    held += len(sigs[-1])
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(key)
                if held > ROWS_AT_ONCE:
                    yield _signed(ids, infos, holders, sigs, row)
                    row += len(ids)
                    ids, infos, holders, sigs, held = [], [], [], [], 0
            yield _signed(ids, infos, holders, sigs, row)
            row += len(ids)

    return run


def _signed(ids: list[int], infos: list[bytes], holders: list[tuple[int, int]], sigs: list[np.ndarray], row: int) -> pa.RecordBatch:
    spread = mix(np.arange(row, row + len(ids), dtype=np.uint64), 205)
    owner = np.repeat(np.array([h[0] for h in holders], np.int64), [h[1] for h in holders])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([spread, *sigs]).view(np.int64)), pa.array(np.concatenate([np.array(ids, np.int64), owner])),
         pa.concat_arrays([pa.array(infos, pa.binary()), pa.nulls(len(owner), pa.binary())])], names=["sig", "id", "info"])


def _described(ids: pa.Array, info: pa.Array) -> pa.RecordBatch:
    """The rows of sets: their numbers, and counts in many and in fewer ranges."""
    body = np.frombuffer(b"".join(info.to_pylist()), np.uint8).reshape(-1, 24 + FINE)
    numbers = np.ascontiguousarray(body[:, :24]).view("<i8")
    rough = np.minimum(body[:, 24:].reshape(-1, COARSE, FINE // COARSE).sum(axis=2, dtype=np.int64), 255).astype(np.uint8)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(body), bool)), pa.nulls(len(body), pa.int64()), ids, *(pa.array(numbers[:, i]) for i in range(3)),
         pa.array([c.tobytes() for c in rough], pa.binary()), pa.array([c.tobytes() for c in body[:, 24:]], pa.binary())], names=SHARED)


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray]]:
    """Columns of rows sorted by their first one, cut so that no bucket is divided; starts and sizes of buckets."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = batch.column(0).to_numpy()
        start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        if held and len(start) == 1 and held[-1].column(0)[-1].as_py() == sig[0]:
            held.append(pa.Table.from_batches([batch]))
            continue
        cut = int(start[-1])
        if held or cut:
            yield _cut(pa.concat_tables([*held, pa.Table.from_batches([batch.slice(0, cut)])]))
        held = [pa.Table.from_batches([batch.slice(cut)])]
    if held:
        yield _cut(pa.concat_tables(held))


def _cut(table: pa.Table) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    columns = [c.combine_chunks() for c in table.columns]
    sig = columns[0].to_numpy()
    start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    return columns, start, np.diff(np.append(start, len(sig)))


def _several(columns: list[pa.Array]) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """Rows sorted by (sig, id) without repeats and without buckets of one id; starts and sizes of the rest."""
    sig, doc = columns[0].to_numpy(), columns[1].to_numpy()
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (sig[1:] != sig[:-1])))
    start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    several = np.repeat(np.add.reduceat(fresh.astype(np.int64), start) > 1, np.diff(np.append(start, len(sig))))
    keep = pa.array(np.flatnonzero(fresh & several))
    kept = [c.take(keep) for c in columns]
    sig = kept[0].to_numpy()
    start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.empty(0, np.int64)
    return kept, start, np.diff(np.append(start, len(sig)))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of sets, and (sig, id), once each, of signatures that several ids hold."""
    sets: list[pa.RecordBatch] = []

    def signed() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_set = batch.column(2).is_valid()
            found = batch.filter(of_set)
            if found.num_rows:
                sets.append(_described(found.column(1), found.column(2)))
            rest = batch.filter(pc.invert(of_set))
            yield pa.RecordBatch.from_arrays(rest.columns[:2], names=["sig", "id"])

    for columns, _, _ in _whole_buckets(signed()):
        sig, doc = _several(columns)[0]
        none = [pa.nulls(len(sig), kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sig), bool)), sig, doc, *none], names=SHARED)
        yield from sets
        sets.clear()
    yield from sets


def _counts(column: pa.Array, ranges: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, ranges).astype(np.int16)


class _Bound:
    """Whether sets can be similar, by their sizes and counts."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def __call__(self, n, counts, m, others) -> np.ndarray:
        apart = np.abs(others - counts).sum(axis=-1)
        return (apart <= (n + m) * (self.den - self.num) // (self.den + self.num)) \
            & (self.den * np.minimum(n, m) >= self.num * np.maximum(n, m))


def _near_pairs(num: int, den: int):
    """(a, b) of the rows whose counts in many ranges let their sets be similar."""
    near = _Bound(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m = batch.columns[:4]
            fits = near(n.to_numpy(), _counts(batch.column(4), FINE), m.to_numpy(), _counts(batch.column(5), FINE))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(fits))

    return run


def _candidates(num: int, den: int):
    """(a, b, sig): pairs to compare, and with null b the members of buckets to look at again."""
    near = _Bound(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, _, _ in _whole_buckets(batches):
            (sig, doc, size_of, coarse), start, size = _several(columns)
            if not len(start):
                continue
            sig, doc, n, counts = sig.to_numpy(), doc.to_numpy(), size_of.to_numpy(), _counts(coarse, COARSE)
            two = start[size == 2]
            two = two[near(n[two], counts[two], n[two + 1], counts[two + 1]) & (doc[two] != doc[two + 1])]
            ones, others, again = [doc[two + 1]], [doc[two]], []
            for s, m in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                ids, sizes, own = doc[s:s + m], n[s:s + m], counts[s:s + m]
                centre = int(np.abs(own - own.sum(axis=0) // m).sum(axis=1).argmin())
                linked = near(sizes[centre], own[centre], sizes, own)
                ones.append(ids[linked])
                others.append(np.full(int(linked.sum()), ids[centre]))
                rest, found, many = np.flatnonzero(~linked), [], int(linked.sum()) > 2
                for i in rest.tolist():
                    good = near(sizes[i], own[i], sizes, own)
                    good &= linked | (np.arange(m) > i)
                    good[centre] = False
                    found.append((i, np.flatnonzero(good)))
                    if sum(len(g) for _, g in found) > 4 * m:
                        many = True
                        break
                if many:
                    again.append(np.arange(s, s + m))
                else:
                    for i, good in found:
                        ones.append(np.full(len(good), ids[i]))
                        others.append(ids[good])
            a, b = np.concatenate(ones), np.concatenate(others)
            pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)])[:, a != b], axis=1)
            more = np.concatenate(again) if again else np.empty(0, np.int64)
            k = pairs.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([pairs[0], doc[more]])), pa.concat_arrays([pa.array(pairs[1]), pa.nulls(len(more), pa.int64())]),
                 pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(sig[more])])], names=["a", "b", "sig"])

    return run


def _across(num: int, den: int):
    """(a, root, others): for a member of a bucket, the ids in another component that may be similar to it.

    Of two components of a bucket the larger one is looked through for each member of the smaller.
    """
    near = _Bound(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, doc, root, size_of, fine), start, size in _whole_buckets(batches):
            doc, root, n, counts = doc.to_numpy(), root.to_numpy(), size_of.to_numpy(), _counts(fine, FINE)
            rough = counts.reshape(len(counts), COARSE, -1).sum(axis=2)
            rows: list[tuple[int, int, np.ndarray]] = []
            for s, m in zip(start.tolist(), size.tolist(), strict=True):
                part = slice(s, s + m)
                names, count = np.unique(root[part], return_counts=True)
                if len(names) < 2:
                    continue
                small = root[part] != names[count.argmax()]
                for i in (s + np.flatnonzero(small)).tolist():
                    open_ = (root[part] != root[i]) & (~small | (np.arange(s, s + m) > i))
                    j = s + np.flatnonzero(open_)
                    j = j[near(n[i], rough[i], n[j], rough[j])]
                    j = j[near(n[i], counts[i], n[j], counts[j])]
                    j = j[doc[j] != doc[i]]
                    rows += [(doc[i], r, doc[j[root[j] == r]]) for r in np.unique(root[j])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["a", "root", "others"])

    return run


def _joined_lists(table: pa.Table) -> pa.Table:
    """(a, b, root), once each, from the lists of one (a, root)."""
    others = np.unique(table.column("others").combine_chunks().flatten().to_numpy())
    k = len(others)
    return pa.table({"a": pa.array(np.full(k, table.column("a")[0].as_py(), np.int64)), "b": pa.array(others),
                     "root": pa.array(np.full(k, table.column("root")[0].as_py(), np.int64))})


def _similar_in_block(width: int, num: int, den: int):
    """(a, b) of a block's pairs whose texts are similar enough; each text comes once."""

    def run(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        shingler, sets = Shingler(width), {}
        for doc, text in zip(texts.column("id").to_pylist(), texts.column("text"), strict=True):
            sets.setdefault(doc, []).append(shingler(text.as_py()))
        good = [(a, b) for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True)
                if any(_close(x, y, num, den) for x in sets.get(a, ()) for y in sets.get(b, ()))]
        return pa.table({"a": pa.array([g[0] for g in good], pa.int64()), "b": pa.array([g[1] for g in good], pa.int64())})

    return run


def _close(one: np.ndarray, two: np.ndarray, num: int, den: int) -> bool:
    small, large = sorted((len(one), len(two)))
    if small == 0 or den * small < num * large:
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return den * common >= num * (small + large - common)


def _similar(width: int, num: int, den: int):
    """(a, b) of the rows whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, recent = Shingler(width), OrderedDict()

        def shingles(doc: int, text: bytes) -> np.ndarray:
            key = (doc, len(text))
            if key not in recent:
                recent[key] = (text, shingler(text))
                if len(recent) > 32:
                    recent.popitem(last=False)
            known, found = recent[key]
            return found if known == text else shingler(text)

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = []
            for i in range(len(a)):
                one, two = (shingles(x, batch.column(c)[i].as_py() or b"") for x, c in ((a[i], 2), (b[i], 3)))
                if _close(one, two, num, den):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([a[i] for i in good], [b[i] for i in good])],
                                             names=["a", "b"])

    return run


def jaccard_components(docs: DataFrame, similarity: tuple[int, int] = (80, 100), width: int = 5,
                       doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    A row's set holds its distinct ``width``-word shingles (words split at ASCII blanks, A-Z lower-cased),
    or its whole word sequence if that is shorter. Rows link when intersection / union is at least
    ``similarity``; ``component_id`` is the smallest id reachable by links, itself included.

    Null, empty and blank texts have an empty set and link with nothing. Rows sharing an id are one
    document (so are all rows without an id, which sort last and whose component id is null unless they
    link to others): they share a component, and each row reports its own set size. No rows give no rows.
    """
    num, den = similarity
    base = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.col(f"`{text}`").cast("binary").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    described = base.mapInArrow(_describe(width, num, den), "sig long, id long, info binary")
    both = stored(described.repartition(parts, "sig").sortWithinPartitions("sig", "id").mapInArrow(
        _shared, "of_set boolean, sig long, id long, n long, c1 long, c2 long, coarse binary, fine binary"), "members", by="of_set")
    sets, members = both.where("of_set").drop("of_set", "sig"), both.where("not of_set").select("sig", "id")
    # Equal sets are one member of a bucket from here on, under their smallest id.
    classes = stored(_classes(sets), "classes")
    first = sets.join(classes, ["id", "n", "c1", "c2"]).select(F.col("id").alias("of"), F.col("b").alias("id"), "n", "coarse")
    counted = members.select("sig", F.col("id").alias("of")).join(first, "of").select("sig", "id", "n", "coarse")
    found = stored(counted.repartition(parts, "sig").sortWithinPartitions("sig", "id")
                   .mapInArrow(_candidates(num, den), "a long, b long, sig long"), "candidates")

    alike = found.where("b is not null").select("a", "b").distinct()
    fine_a = sets.where("n > 0").select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("fine").alias("fine_a"))
    fine_b = sets.where("n > 0").select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("fine").alias("fine_b"))
    pairs = stored(alike.join(fine_b, "b").join(fine_a, "a").select("a", "b", "n_a", "n_b", "fine_a", "fine_b")
                   .mapInArrow(_near_pairs(num, den), "a long, b long").distinct(), "pairs")
    wanted = (pairs.select(F.explode(F.array("a", "b")).alias("id"))
              .unionAll(found.where("b is null").select(F.col("a").alias("id"))).distinct())
    texts = stored(base.join(wanted, "id"), "texts")
    links = stored(_verified(texts, pairs, width, num, den)
                   .unionAll(classes.where("id <> b").select(F.col("id").alias("a"), "b")), "similar")
    roots = connected_components(links)

    again = (found.where("b is null").select("sig", F.col("a").alias("id")).join(roots, F.col("id") == F.col("node"), "left")
             .select("sig", "id", F.coalesce("root", "id").alias("root")))
    open_ = (again.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"))
             .where("low <> high").select("sig"))
    fine = again.join(open_, "sig").join(sets.where("n > 0").select("id", "n", "fine"), "id")
    lists = (fine.select("sig", "id", "root", "n", "fine").repartition(parts, "sig").sortWithinPartitions("sig", "id")
             .mapInArrow(_across(num, den), "a long, root long, others array<long>"))
    rest = stored(lists.groupBy("a", "root").applyInArrow(_joined_lists, "a long, b long, root long")
                  .join(pairs.unionAll(pairs.select("b", "a")), ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        roots = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
                                     .unionAll(_verified_in_blocks(texts, rest, width, num, den)))
    out = sets.join(roots, sets["id"] == roots["node"], "left")
    component = F.coalesce("root", "id")
    return out.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(component != NO_ID, component).alias("component_id"))


def _classes(sets: DataFrame) -> DataFrame:
    """(id, n, c1, c2, b): every set with the smallest id that has the same one; per salted cell first."""
    key = ["n", "c1", "c2"]
    same = sets.where("n > 0").select("id", *key).distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    cells = same.groupBy(*key, "salt").agg(F.min("id").alias("least"))
    firsts = (cells.groupBy(*key).agg(F.min("least").alias("b"), F.collect_list("salt").alias("salts"))
              .select(*key, "b", F.explode("salts").alias("salt")))
    return same.join(firsts, [*key, "salt"]).select("id", *key, "b")


def _verified(texts: DataFrame, pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(_similar(width, num, den), "a long, b long"))


def _verified_in_blocks(texts: DataFrame, pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The same for many pairs (a, b) with b in few components ``root``.

    The pairs of a component are dealt into blocks of about ``BLOCK`` documents on either side, and a
    block gets each of its texts once instead of once per pair.
    """
    def chunks(name: str) -> F.Column:
        return F.ceil(F.approx_count_distinct(name) / F.lit(BLOCK)).cast("long")

    sizes = pairs.groupBy("root").agg(chunks("a").alias("na"), chunks("b").alias("nb"))
    block = ["root", "ca", "cb"]
    dealt = stored(pairs.join(sizes, "root").select(
        "root", F.pmod(F.xxhash64("a"), "na").alias("ca"), F.pmod(F.xxhash64("b"), "nb").alias("cb"), "a", "b"), "blocks")
    needed = dealt.select(*block, F.col("a").alias("id")).unionAll(dealt.select(*block, F.col("b").alias("id"))).distinct()
    left = needed.join(texts, "id").select(*[F.col(c).alias(f"of_{c}") for c in block], "id", "text")
    return left.groupBy(*[f"of_{c}" for c in block]).cogroup(dealt.groupBy(*block)).applyInArrow(
        _similar_in_block(width, num, den), "a long, b long")
