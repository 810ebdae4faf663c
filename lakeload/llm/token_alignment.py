"""Cross-tokenizer alignment: interval coalescing over the byte ranges of two tokenizers' tokens.

A text is cut at blanks after visible characters. No token of either vocabulary crosses such a cut (checked when the
vocabularies are read), so encoding the pieces gives the tokens of the whole, and a piece met before need not be encoded
again. All new pieces of a batch are aligned at once: the A and B tokens' byte ranges lie on one axis, are sorted by
start, ends are accumulated by maximum, and groups break where a start reaches the running maximum.

1. One pass over the texts tokenizes and aligns them in blocks of bounded size and writes a row per document and one per
   block: the block's distinct linked pairs with the number of its documents that hold them, and which document holds
   which piece how often.
2. Pair counts are summed over blocks, and the highest count of each A id is found: plain aggregations of rows that are
   already one per pair and block.
3. Counts return to the blocks that hold the pair, and each block sums them for its documents.

A document's links are never written one by one: what is shuffled are the distinct pairs of blocks.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import stored

# A blank that follows a visible character begins a piece; further white space stays with what stands before it.
_PIECE = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")
_SPACE = "▁"
# Fixed value: how byte-level vocabularies of this kind cut text into words.
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bounds of one block, and of the pieces remembered from one block to the next.
BLOCK_CHARS = 1_000_000
KNOWN_CHARS = 1_500_000
ALIGNED_AT_ONCE = 1 << 14
# Groups with more links than this are counted by their distinct ids.
SMALL_GROUP = 256
_ID = 1 << 20
_NONE = np.empty(0, np.int64)


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class TokenizerPair:
    """Tokenizer A (byte-level BPE) and B (pieces with byte fallback), giving ids and byte lengths of pieces.

    A's ids must rise in the order of its merges; the merge of lowest id is then always the next one to apply, which is how
    the encoder used for it works, several times faster than by looking up merges.
    """

    def __init__(self, byte_bpe: str, piece_bpe: str):
        import sentencepiece
        import tiktoken

        with open(byte_bpe, encoding="utf-8") as file:
            model = json.load(file)["model"]
        alphabet, vocabulary = _byte_alphabet(), model["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.a_bytes[number] = bytes(alphabet[c] for c in entry)
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("the ids of the first vocabulary do not rise with its merges")
        usable = {data: number for number, data in enumerate(self.a_bytes) if number <= merged[-1]}
        self.a = tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=usable, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        self.b_bytes = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            if self.b.is_byte(number):
                self.b_bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.b_bytes.append(piece.replace(_SPACE, " ").encode())
        for number, data in enumerate(self.b_bytes):
            if b" " in data.lstrip(b" "):
                raise ValueError(f"piece {number} of the second vocabulary holds a blank after a visible character")
        self.space = self.b.piece_to_id(_SPACE)
        self.a_sizes = np.fromiter(map(len, self.a_bytes), np.int64, len(self.a_bytes))
        self.b_sizes = np.fromiter(map(len, self.b_bytes), np.int64, len(self.b_bytes))
        # An id and what follows it: A within a group, A before B, B within a group, B at the end of one.
        count = max(len(self.a_bytes), len(self.b_bytes))
        if count > _ID:
            raise ValueError(f"vocabularies of more than {_ID} entries")
        self.names = np.array([[f"{i}{mark}" for i in range(count)] for mark in ",|,;"], dtype=object)

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of pieces, each of which begins with a blank; B adds a blank of its own to any text but the empty one."""
        a = list(map(self.a.encode_ordinary, pieces))
        b = self.b.encode([p[1:] for p in pieces], num_threads=1)
        return a, [ids if len(p) > 1 else [self.space] for ids, p in zip(b, pieces, strict=True)]


@functools.lru_cache(maxsize=2)
def tokenizer_pair(byte_bpe: str, piece_bpe: str) -> TokenizerPair:
    return TokenizerPair(byte_bpe, piece_bpe)


def coalesce(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group) of half-open ranges of two sides: groups break where a start reaches the largest end so far."""
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.append(False, starts[order][1:] >= reach[:-1])
    return order, np.cumsum(breaks)


@dataclass
class Pieces:
    """Aligned pieces: token and group counts, the groups as text (None where the tokens' bytes are not the piece's), and the
    distinct linked pairs (A id * 2^20 + B id) of all pieces, ``n_pairs`` for each, with the number of their links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str | None]
    n_pairs: np.ndarray
    pairs: np.ndarray
    links: np.ndarray

    @classmethod
    def none(cls) -> Pieces:
        return cls(*[np.empty(0, np.int64)] * 3, [], *[np.empty(0, np.int64)] * 3)

    def __add__(self, more: Pieces) -> Pieces:
        both = [self.groups + more.groups if k == "groups" else np.concatenate((getattr(self, k), getattr(more, k)))
                for k in self.__dataclass_fields__]
        return Pieces(*both)


def _flat(tokens: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(chain.from_iterable(tokens), np.int64), np.fromiter(map(len, tokens), np.int64, len(tokens))


def _spelled(ids: np.ndarray, count: np.ndarray, entries: list[bytes], sizes: np.ndarray, bodies: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """For each piece, whether its tokens' bytes are its own."""
    ends = count.cumsum()
    spans = np.append(0, sizes[ids].cumsum())[np.append(0, ends)]
    right = np.diff(spans) == lengths
    every = b"".join(map(entries.__getitem__, ids.tolist()))
    if right.all() and every == b"".join(bodies):
        return right
    starts = spans.tolist()
    return np.array([ok and every[starts[i]:starts[i + 1]] == bodies[i] for i, ok in enumerate(right.tolist())], bool)


def align(pair: TokenizerPair, pieces: list[str]) -> Pieces:
    """Groups and links of pieces, all in one sort."""
    n = len(pieces)
    if not n:
        return Pieces.none()
    bodies = [p.encode() for p in pieces]
    lengths = np.fromiter(map(len, bodies), np.int64, n)
    a, b = pair.encode(pieces)
    (a_ids, a_count), (b_ids, b_count) = _flat(a), _flat(b)
    right = (_spelled(a_ids, a_count, pair.a_bytes, pair.a_sizes, bodies, lengths)
             & _spelled(b_ids, b_count, pair.b_bytes, pair.b_sizes, bodies, lengths))
    a_owner, b_owner = np.repeat(np.arange(n), a_count), np.repeat(np.arange(n), b_count)
    a_good, b_good = right[a_owner], right[b_owner]
    a_ids, b_ids, a_owner, b_owner = a_ids[a_good], b_ids[b_good], a_owner[a_good], b_owner[b_good]

    # The tokens' ranges on one axis: spelled pieces lie end to end, so their tokens do.
    a_end, b_end = pair.a_sizes[a_ids].cumsum(), pair.b_sizes[b_ids].cumsum()
    starts = np.concatenate((a_end - pair.a_sizes[a_ids], b_end - pair.b_sizes[b_ids]))
    side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
    order, group = coalesce(starts, np.concatenate((a_end, b_end)), side)
    # Tokens by group, A before B, each in the order of the text.
    again = np.lexsort((side[order], group))
    order, group = order[again], group[again]
    side, ids, owner = side[order], np.concatenate((a_ids, b_ids))[order], np.concatenate((a_owner, b_owner))[order]

    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(ids)))
    size_b = np.bincount(group, side, len(first)).astype(np.int64)
    of_group = owner[first]
    out_a, out_b = np.bincount(owner[side == 0], minlength=n), np.bincount(owner[side == 1], minlength=n)

    last_a = np.zeros(len(ids), bool)
    last_a[first + size - size_b - 1] = True
    last_b = np.zeros(len(ids), bool)
    last_b[first + size - 1] = True
    words = pair.names[side * 2 + (last_a | last_b), ids]
    cuts = np.append(0, np.cumsum(out_a + out_b)).tolist()
    groups = ["".join(words[cuts[i]:cuts[i + 1]]) if ok else None for i, ok in enumerate(right.tolist())]

    code, times, at_group = _links(ids, first, size - size_b, size_b)
    at_piece = of_group[at_group]
    order = np.lexsort((code, at_piece))
    code, times, at_piece = code[order], times[order], at_piece[order]
    starts = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (at_piece[1:] != at_piece[:-1]))) if len(code) else first
    small = (x.astype(np.int32) for x in (out_a, out_b, np.bincount(of_group, minlength=n)))
    times = np.add.reduceat(times, starts) if len(starts) else times
    return Pieces(*small, groups, np.bincount(at_piece[starts], minlength=n).astype(np.int32), code[starts], times.astype(np.int32))


def _links(ids: np.ndarray, first: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, number of links, group): every A-B pair of small groups one by one, distinct ids of large groups."""
    product = size_a * size_b
    small = np.flatnonzero(product <= SMALL_GROUP)
    total = product[small]
    within = _spans(np.zeros(len(small), np.int64), total)
    start, y = np.repeat(first[small], total), np.repeat(size_b[small], total)
    code = ids[start + within // y] * _ID + ids[start + np.repeat(size_a[small], total) + within % y]
    parts = [(code, np.ones(len(code), np.int64), np.repeat(small, total))]
    for g in np.flatnonzero(product > SMALL_GROUP).tolist():
        s, x, y = int(first[g]), int(size_a[g]), int(size_b[g])
        a, n = np.unique(ids[s:s + x], return_counts=True)
        b, m = np.unique(ids[s + x:s + x + y], return_counts=True)
        code = (a[:, None] * _ID + b).ravel()
        parts.append((code, np.outer(n, m).ravel(), np.full(len(code), g)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class _Numbers(dict):
    """Running numbers of keys, in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class _Block:
    """Aligns the documents of one block, and remembers pieces of earlier blocks of the task."""

    def __init__(self, pair: TokenizerPair):
        self.pair = pair
        self._forget()

    def _forget(self) -> None:
        self.known, self.pieces, self.chars = _Numbers(), Pieces.none(), 0

    def __call__(self, texts: list[str | None]) -> dict:
        if self.chars > KNOWN_CHARS:
            self._forget()
        before = len(self.known)
        index = [np.fromiter(map(self.known.__getitem__, _PIECE.findall(" " + t)), np.int64) if t else _NONE for t in texts]
        new = list(islice(self.known, before, None))
        for at in range(0, len(new), ALIGNED_AT_ONCE):
            self.pieces += align(self.pair, new[at:at + ALIGNED_AT_ONCE])
        self.chars += sum(map(len, new))
        pieces, n_docs = self.pieces, len(texts)
        texts_of = ["".join(g)[:-1] if len(row) and all(g := [pieces.groups[i] for i in row.tolist()]) else None for row in index]
        index = [row for row, text in zip(index, texts_of, strict=True) if text]
        good = np.flatnonzero([text is not None for text in texts_of])

        doc = np.repeat(good, [len(row) for row in index]) if index else _NONE
        piece = np.concatenate(index) if index else _NONE
        out = {k: np.bincount(doc, getattr(pieces, k)[piece], n_docs).astype(np.int64) for k in ("n_a", "n_b", "n_groups")}
        out["sha"] = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts_of]
        here, piece = np.unique(piece, return_inverse=True)
        cells, n = np.unique(doc * max(1, len(here)) + piece, return_counts=True)
        doc, piece = np.divmod(cells, max(1, len(here)))

        size = pieces.n_pairs[here]
        place = _spans(pieces.n_pairs.cumsum()[here] - size, size)
        pairs, at = np.unique(pieces.pairs[place], return_inverse=True)
        links = pieces.links[place]
        # Documents that hold a pair, in whichever of their pieces.
        held = np.repeat(doc, size[piece]) * max(1, len(pairs)) + at[_spans(size.cumsum()[piece] - size[piece], size[piece])]
        docs = np.bincount(np.unique(held) % max(1, len(pairs)), minlength=len(pairs))
        total = np.bincount(np.repeat(np.arange(len(here)), size), links, len(here)).astype(np.int64)
        n_links = np.zeros(n_docs, np.int64)
        np.add.at(n_links, doc, n * total[piece])
        return {**out, "n_links": n_links, "pairs": pairs, "docs": docs, "at": at, "links": links, "size": size, "piece": piece, "n": n,
                "cells": np.bincount(doc, minlength=n_docs)}


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the given stretches, one after another."""
    ends = sizes.cumsum()
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^31, compressed byte plane by byte plane: most high bytes are zero."""
    return zstandard.ZstdCompressor().compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4")[:, 0].astype(np.int64)


_DOC = ["block", "pos", "id", "n_a", "n_b", "n_groups", "n_links", "sha"]
_ARRAYS = ["at", "links", "size", "piece", "n", "cells"]
_PAIRS = ["pairs", "docs"]


def _aligned(byte_bpe: str, piece_bpe: str, id_type: pa.DataType, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(tokenizer_pair(byte_bpe, piece_bpe))
        # Partition and running number name a block; its rows are written before anything else reads them.
        number, texts, ids, chars = TaskContext.get().partitionId() << 24, [], [], 0

        def filled() -> pa.RecordBatch:
            matrix, n = block(texts), len(texts)
            columns = {"block": [number] * n, "pos": list(range(n)), "id": ids,
                       **{k: matrix[k] for k in ("n_a", "n_b", "n_groups", "n_links", "sha")}}
            documents = pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)
            packed = {"block": pa.array([number], pa.int64()),
                      **{k: pa.array([_packed(matrix[k])], pa.binary()) for k in _ARRAYS},
                      **{k: pa.ListArray.from_arrays(pa.array([0, len(matrix[k])], pa.int32()), pa.array(matrix[k], pa.int64())) for k in _PAIRS}}
            whole = pa.RecordBatch.from_arrays([packed[f.name] if f.name in packed else pa.nulls(1, f.type) for f in schema], schema=schema)
            return documents, whole

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                if texts and chars + len(text or "") > BLOCK_CHARS:
                    yield from filled()
                    number, texts, ids, chars = number + 1, [], [], 0
                texts.append(text)
                ids.append(batch.column(0)[i].as_py())
                chars += len(text or "")
        if texts:
            yield from filled()

    return run


def _scored(block: pa.Table, scores: pa.Table) -> pa.Table:
    """``block, pos, n_best, count_sum`` for the documents of one block from its pairs' counts."""
    if not block.num_rows:
        return pa.table({"block": _NONE, "pos": _NONE, "n_best": _NONE, "count_sum": _NONE})
    at, links, size, piece, n, cells = (_unpacked(block.column(k)[0].as_py()) for k in _ARRAYS)
    pairs = scores.column("pair").to_numpy()
    order = np.argsort(pairs)
    owner, doc = np.repeat(np.arange(len(size)), size), np.repeat(np.arange(len(cells)), cells)
    out = {}
    for name, column in (("n_best", "best"), ("count_sum", "count")):
        value = scores.column(column).to_numpy()[order].astype(np.int64)
        of_piece, out[name] = np.zeros(len(size), np.int64), np.zeros(len(cells), np.int64)
        np.add.at(of_piece, owner, links * value[at])
        np.add.at(out[name], doc, n * of_piece[piece])
    return pa.table({"block": np.full(len(cells), block.column("of")[0].as_py()), "pos": np.arange(len(cells)), **out})


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, count, best``: documents that hold a linked pair, and whether no pair of its A id is held by more."""
    counts = (blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
              .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count")))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 20)), "pairs")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokenizers(docs: DataFrame, byte_bpe: str, piece_bpe: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    ``byte_bpe`` and ``piece_bpe`` are paths of the two vocabularies, readable on every executor. A is encoded from a space
    and the text, B from the text, which adds that space itself. Offsets where tokens of both end cut the bytes into groups;
    every A token is linked with every B token of its group. A pair of ids counts in how many rows it is linked.

    Null and empty texts, and texts whose tokens do not spell them (such as those with U+2581), have no tokens: zeros and an
    empty ``groups_sha256``. Ids may be of any type, null or repeated; repeated rows count one by one. Other columns are not
    looked at. No rows give no rows. A very long text is a block of its own.
    """
    base = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = base.schema["id"].dataType
    spark_schema = (f"block long, pos int, id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, sha string, "
                    + ", ".join(f"{k} binary" for k in _ARRAYS) + ", pairs array<long>, docs array<long>")
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(spark_schema))
    found = stored(base.mapInArrow(_aligned(byte_bpe, piece_bpe, to_arrow_type(kind), schema), spark_schema), "alignment")
    rows, blocks = found.where("pos is not null").select(*_DOC), found.where("pos is null").select("block", *_ARRAYS, *_PAIRS)

    scores = (blocks.select("block", F.explode("pairs").alias("pair")).join(pair_counts(blocks), "pair")
              .select("block", "pair", "count", F.col("best").cast("long").alias("best")))
    sums = (blocks.select(F.col("block").alias("of"), *_ARRAYS).groupBy("of").cogroup(scores.groupBy("block"))
            .applyInArrow(lambda block, found: _scored(block, found), "block long, pos long, n_best long, count_sum long"))
    return rows.join(sums, ["block", "pos"], "left").select(
        F.col("id").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), F.col("sha").alias("groups_sha256"))
