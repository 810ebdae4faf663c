"""Near duplicates: Jaccard join, repeated passages, embeddings, components."""

import random

import brute
import numpy as np
import pytest
from awkward import documents, rows, unique
from pyspark.sql import functions as F

from lakeload.llm.components import connected_components
from lakeload.llm.embedding_dedup import embedding_components
from lakeload.llm.jaccard_join import Bands, jaccard_components, signatures
from lakeload.llm.shingles import Shingler
from lakeload.llm.substring_dedup import Winnower, maximal_spans, repeated_passages


def near_copies():
    """A group of near copies of very different closeness, short texts, a shared passage, copies, and empty ones."""
    pick = random.Random(3)
    vocabulary = ["".join(pick.choice("abcdefgh") for _ in range(4)) for _ in range(3000)]
    base, out = [pick.choice(vocabulary) for _ in range(150)], []
    for i in range(300):
        words = list(base)
        for _ in range(pick.randint(0, 9)):
            words[pick.randrange(len(words))] = pick.choice(vocabulary)
        out.append((i, " ".join(words)))
    for i in range(300, 390):
        words = [pick.choice(vocabulary) for _ in range(pick.choice([3, 4, 5, 6, 7, 9, 20, 120]))]
        out.append((i, " ".join(words + (base[20:70] if i % 2 else []))))
    out += [(i, out[pick.randrange(390)][1].upper()) for i in range(390, 420)]
    for i in range(420, 460):
        words = out[300 + pick.randrange(90)][1].split()
        words[pick.randrange(len(words))] = "zz"
        out.append((i, "\t".join(words)))
    return out + [(500, None), (501, ""), (502, " \n ")]


def test_jaccard_join(spark):
    data = near_copies()
    got = {tuple(r) for r in jaccard_components(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == brute.jaccard_components(data)
    assert {(500, 0, 500), (501, 0, 501), (502, 0, 502)} <= got


def test_similar_sets_share_a_signature():
    pick, bands = np.random.default_rng(1), Bands(80, 100)
    for _ in range(600):
        size = int(pick.integers(1, 400))
        one = np.unique(pick.integers(0, 2 ** 63, size, dtype=np.uint64))
        two = set(one.tolist())
        for _ in range(int(pick.integers(0, 1 + len(one) // 5))):
            if len(two) > 1 and pick.random() < 0.6:
                two.discard(next(iter(two)))
            else:
                two.add(int(pick.integers(0, 2 ** 63)))
        other = np.array(sorted(two), dtype=np.uint64)
        common = len(np.intersect1d(one, other))
        if 100 * common >= 80 * (len(one) + len(other) - common):
            assert len(np.intersect1d(signatures(one, bands), signatures(other, bands)))


def test_bands_cover_neighbours():
    bands = Bands(80, 100)
    for size in range(1, 3000):
        assert bands.of(size) <= bands.of(size * 100 // 80) <= bands.of(size) + 1


def test_jaccard_awkward_rows(spark):
    docs = documents(spark)
    got = jaccard_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(rows())
    plain = brute.jaccard_components([(r[0], r[1]) for r in unique(rows())])
    size, root = {i: n for i, n, _ in plain}, {i: c for i, _, c in plain}
    for i, n, component in found:
        if i is not None:
            assert (n, component) == (size[i], root[i])
    # Rows without an id are one document; its version with text is a copy of document 30.
    assert sorted(n for i, n, _ in found if i is None) == [0, size[30]] and {c for i, _, c in found if i is None} == {30}
    assert jaccard_components(docs.where("false")).count() == 0


@pytest.mark.parametrize("length,seed", [(35, 10), (6, 2)])
def test_repeated_passages(spark, length, seed):
    pick = random.Random(length)
    words = [f"w{i}" for i in range(400)]
    passages = [pick.choices(words, k=pick.randint(length - 2, 3 * length)) for _ in range(12)]
    data = []
    for i in range(120):
        text = pick.choices(words, k=pick.randint(0, 60))
        for _ in range(pick.randint(0, 3)):
            at, part = pick.randint(0, len(text)), pick.choice(passages)
            cut = pick.randint(0, len(part) // 3)
            text[at:at] = part[cut:]
        data.append((i, " ".join(text)))
    data += [(200, "same " * 90), (201, "same " * 40), (202, "one two " * 50), (203, None), (204, ""), (205, data[3][1])]
    got = repeated_passages(spark.createDataFrame(data, "doc_id long, text string"), length, seed)
    found = got.collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == brute.repeated_passages(data, length)
    for r in found:
        assert sum(s["end"] - s["first"] for s in r.spans) == r.n_removed


def test_repeated_passages_awkward_rows(spark):
    docs = documents(spark)
    found = [tuple(r)[:4] for r in repeated_passages(docs).collect()]
    assert sorted(found, key=repr) == brute.repeated_passages([(r[0], r[1]) for r in rows()])
    assert repeated_passages(docs.where("false")).count() == 0


def test_winnowing_depends_on_the_window_only():
    pick, winnower = random.Random(2), Winnower(12, 4)
    words = winnower.words([f"w{pick.randrange(30)}".encode() for _ in range(300)])
    value, _, place = winnower.anchors(words)
    known = dict(zip((place // 4096).tolist(), value.tolist(), strict=True))
    for start in range(len(words) - 11):
        alone, _, at = winnower.anchors(words[start:start + 12])
        assert known[start + int(at[0]) // 4096] == alone[0]
    assert maximal_spans([(5, 6), (0, 0), (9, 9)], 4) == [(0, 4), (5, 13)]


def vectors(count=160, dim=24):
    pick = np.random.default_rng(4)
    centres = pick.normal(size=(12, dim))
    out = [(i, (centres[i % 12] + pick.normal(size=dim) * pick.choice([0.05, 0.3, 0.5])).tolist()) for i in range(count)]
    out += [(count + i, out[i % 3][1]) for i in range(40)] + [(300, [x * 2 for x in out[0][1]]), (301, [1e200] * dim), (302, [2e200] * dim)]
    bad = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim]
    return out + [(400 + i, v) for i, v in enumerate(bad)] + [(500, [1.0, 0.0]), (501, [1.0, 0.1]), (502, [-0.0, 1.0])]


@pytest.mark.parametrize("tile_rows", [4096, 30])
def test_embeddings(spark, tile_rows):
    data = vectors()
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumns({"k1": F.lit(1), "links": F.lit(2), "id": F.lit(3)})
    got = sorted(tuple(r) for r in embedding_components(df, tile_rows=tile_rows).collect())
    want = brute.embedding_components([r for r in data if r[0] not in (301, 302)])
    assert [g for g in got if g[0] not in (301, 302)] == want
    assert {g[:3] for g in got if g[0] in (301, 302)} == {(301, 1, 301), (302, 1, 301)}
    assert sum(w[1] for w in want) > 1000


def test_embeddings_awkward_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.01]), (1, [1.0, 0.01]), (2, None)], "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in embedding_components(df).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (None, 2, 1, False)]
    assert embedding_components(df.where("false")).count() == 0
    assert embedding_components(df.where("embedding is null")).count() == 1


def test_components(spark):
    pick = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(pick.randrange(100, 300), pick.randrange(100, 300)) for _ in range(120)] + [(7, 7)]
    nodes = {n for e in edges for n in e}
    want = {(n, r) for n, r in brute.roots(nodes, edges).items() if n != r}
    assert {tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles():
    shingler = Shingler(5)
    assert len(shingler(b"a b c d e f")) == 2 and len(shingler(b"A b\tc d e a b c d e")) == 6 - 1
    assert len(shingler(b"a b")) == 1 and shingler(b"a b")[0] != shingler(b"b a")[0] and len(shingler(None)) == 0
