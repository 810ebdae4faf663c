"""Exact dedup, embedding whitening and tokenizer alignment against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeload.llm import quotient_filter, token_alignment, whitening
from lakeload.llm.corpus_queries import TOKENIZERS
from lakeload.llm.exact_dedup import exact_duplicates
from lakeload.llm.queries import QUERIES
from lakeload.llm.token_alignment import align_tokenizers
from lakeload.llm.whitening import bidiagonalise, fit_whitening, identity_error, whiten, whole_vectors

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
BLANKS = " \t\n\x0b\f\r"


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_quotient_filters_lose_nothing(bits):
    pick = np.random.default_rng(bits)
    pools = [pick.integers(0, 1 << 64, 3000, dtype=np.uint64), pick.integers(0, 50, 400, dtype=np.uint64),
             np.full(70_000, 7, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)]
    whole, segments = Counter(), defaultdict(list)
    for pool in [*pools, np.concatenate(pools)]:
        whole.update(pool.tolist())
        for segment, body in quotient_filter.build(pool, bits):
            prints, counts = quotient_filter.decode(body)
            assert (prints >> np.uint64(64 - bits) == segment).all() and (np.diff(prints.astype(object)) > 0).all()
            assert dict(zip(prints.tolist(), counts.tolist())) == {p: n for p, n in Counter(pool.tolist()).items() if p >> (64 - bits) == segment}
            segments[segment].append(body)
    merged = {}
    for bodies in segments.values():
        prints, owner, total = quotient_filter.merge(bodies)
        assert len(set(zip(prints.tolist(), owner.tolist()))) == len(prints)
        merged.update(zip(prints.tolist(), total.tolist()))
    assert merged == whole
    assert quotient_filter.build(np.empty(0, np.uint64), bits) == [] and len(quotient_filter.merge([])[0]) == 0


def plain_duplicates(rows):
    groups = defaultdict(list)
    for number, (key, text) in enumerate(rows):
        groups["".join(c for c in text or "" if c not in BLANKS)].append((-len(text or ""), key is None, key if key is not None else 0, number))
    out = []
    for body, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        sha = hashlib.sha256(body.encode()).hexdigest()
        ids = [None if m[1] else m[2] for m in members]
        out += [(i, keep, len(members), sha) for i in ids]
    return Counter(out), len(groups)


def test_exact_duplicates_of_awkward_rows(spark):
    pick = random.Random(3)
    rows = [(i, t) for i, t in enumerate(["", None, " \n\t", "a b", "ab", " a  b ", "A b", "é x", "é  x", "x" * 200_000, "x " * 200_000])]
    rows += [(None, "a b"), (None, "a b"), (3, "a b"), (3, "a b"), (40, "a  b"), (None, None), (-(2**63), "ab   "), (2**63 - 1, "ab   ")]
    rows += [(100 + i, " ".join(pick.choices("abc", k=4))) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, keep_id int").repartition(3)
    for options in ({}, {"filter_rows": 7, "segment_bits": 2}):
        got = exact_duplicates(docs, **options).collect()
        want, groups = plain_duplicates(rows)
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == groups and all(r.doc_id == r.keep_id for r in got if r.kept)
    texts = exact_duplicates(docs.selectExpr("concat('k', doc_id) AS doc_id", "text").where("doc_id is not null")).collect()
    assert len(texts) == sum(i is not None for i, _ in rows) and all(isinstance(r.keep_id, str) for r in texts)
    assert exact_duplicates(docs.where("false")).count() == 0


def test_texts_of_one_fingerprint_are_told_apart(spark, monkeypatch):
    """With a fingerprint of one bit nearly all texts collide; bytes still decide."""
    import lakeload.llm.exact_dedup as module

    rows = [(i, f"text {i % 6}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    real = module._fingerprints

    def coarse(*args):
        run = real(*args)

        def wrapped(batches):
            import xxhash

            xxhash.xxh3_64_intdigest = lambda data: len(data) % 2
            return run(batches)

        return wrapped

    monkeypatch.setattr(module, "_fingerprints", coarse)
    got = exact_duplicates(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == plain_duplicates(rows)[0]


def vectors(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<double>{extra}")


def check_whitening(spark, rows, wanted=8):
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:wanted], axes[:, ::-1][:, :wanted]
    got = whiten(vectors(spark, rows)).toPandas()
    count = got.component.nunique()
    assert len(got) == n * count
    table = got.sort_values(["vec_id", "component"]).whitened.to_numpy().reshape(n, count)
    order = np.argsort([i for i, _ in rows])
    want = (centred @ axes / np.sqrt(np.maximum(values, 1e-30)))[order][:, :count]
    want *= np.sign((want * table).sum(axis=0))
    assert np.abs(table - want).max() < 1e-6
    share = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(share, values[:count] / (centred ** 2).sum() * n, rtol=1e-6)
    exact = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    assert {r.vec_id: int(r.deviation) for r in got.itertuples()} == {i: int(e) for (i, _), e in zip(rows, exact)}
    assert (got.n == n).all() and got.identity_error.max() <= 1e-4
    return count


def test_whitening_against_eigenvectors(spark):
    pick = np.random.default_rng(5)
    mixed = pick.standard_normal((300, 20)) * np.linspace(3, 0.1, 20)
    assert check_whitening(spark, [(i, v.tolist()) for i, v in enumerate(mixed)]) == 8
    few = pick.standard_normal((40, 3)) @ pick.standard_normal((3, 12)) * 50
    flat = np.hstack([few[:, :2], np.zeros((40, 4))])
    assert check_whitening(spark, [(i, v.tolist()) for i, v in enumerate(flat)]) == 2


def test_equal_values_are_found_as_often_as_they_occur():
    """Identical singular values close the first subspace early; the steps go on until all are found."""
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((10, 10)))[0]
    x = np.diag([5.0, 5, 5, 5, 2, 2, 1, 1, 1, 0]) @ turn
    found, values, _ = bidiagonalise(lambda p: (x.T @ (x @ p), float((x @ p) @ (x @ p))), 10, 8, float((x ** 2).sum()))
    assert np.allclose(values, [5, 5, 5, 5, 2, 2, 1, 1]) and np.allclose(found @ found.T, np.eye(8))
    assert np.allclose(np.linalg.norm(x @ found.T, axis=0), values)


def test_whitening_of_awkward_vectors(spark):
    sound = [(i, [float(i % 3), float(i * i % 7), 0.5]) for i in range(12)]
    wrong = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 1.0, 2.0]),
             (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0])]
    both = vectors(spark, [(i, v, 1, "z") for i, v in sound + wrong + [(None, sound[0][1]), (3, sound[3][1])]], ", n int, component string")
    got = whiten(both).toPandas()
    assert got.n.unique().tolist() == [14] and sorted(got.component.unique()) == [1, 2]
    assert set(got.vec_id.dropna().astype(int)) == set(range(12)) and len(got) == 28
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whiten(both.where("vec_id = 0")).count() == 0 and whiten(both.where("false")).count() == 0
    same = whole_vectors(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)]))
    model = fit_whitening(same)
    assert len(model.components) == 0 and identity_error(same, model) == 0.0
    assert whitening._square_sums(np.array([[-(1 << 47), 3], [5, -(1 << 20)]])) == [(1 << 94) + 9, 25 + (1 << 40)]


def test_whitening_query(spark, sf_dir):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert check_whitening(spark, rows) == 8
    assert dict(QUERIES["op12_embedding_whitening"](spark, sf_dir).dtypes)["deviation"] == "bigint"


def plain_alignment(texts):
    """One text at a time, with the tokenizers' own encoders."""
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in letters}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        byte[chr(256 + n)] = b
    found, held = [], Counter()
    for text in texts:
        found.append(None)
        if not text:
            continue
        a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
        a_bytes = [bytes(byte[c] for c in one.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(two.id_to_piece(i)[1:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        body = (" " + text).encode()
        if b"".join(a_bytes) != body or b"".join(b_bytes) != body:
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        groups, i, j = [], 0, 0
        for cut in sorted(set(a_ends.tolist()) & set(b_ends.tolist())):
            x, y = int(np.searchsorted(a_ends, cut)) + 1, int(np.searchsorted(b_ends, cut)) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        links = Counter((u, v) for g, h in groups for u in g for v in h)
        held.update(links.keys())
        found[-1] = (len(a), len(b), groups, links)
    best = defaultdict(int)
    for (u, _), n in held.items():
        best[u] = max(best[u], n)
    out = []
    for row in found:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = row
        spelled = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for k, n in links.items() if held[k] == best[k[0]]),
                    sum(n * held[k] for k, n in links.items()), hashlib.sha256(spelled.encode()).hexdigest()))
    return out


def check_alignment(docs):
    texts = docs.collect()
    got = Counter(tuple(r) for r in align_tokenizers(docs, A, B).collect())
    assert got == Counter((r.doc_id, *x) for r, x in zip(texts, plain_alignment([r.text for r in texts]), strict=True))


def test_alignment_of_awkward_texts(spark, monkeypatch):
    pick = random.Random(9)
    parts = [" ", "  ", "\n", "\t", " ", "　", "a", "the", "don't", "Wörter", "日本語", "é", "é", "🙂", "1234", "...", "<|endoftext|>",
             "<s>", "<0x41>", "▁", "\x00", "﻿", "\x1c", "​", "ſt", "ﬁ", "x" * 40, "!?!?", "http://a.b/c?d=e"]
    texts = ["".join(pick.choices(parts, k=pick.randint(1, 14))) for _ in range(400)]
    texts += [None, "", " ", "   ", "\n", "a", "a ", "a  ", " a", "a▁b", "ab" * 3000, "日" * 500, "word " * 4000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the end"), (7, "the end"), (7, "the end")]
    docs = spark.createDataFrame([(i, t, 0, "p") for i, t in rows], "doc_id long, text string, block int, pair string").repartition(2)
    check_alignment(docs)
    assert align_tokenizers(docs.where("false"), A, B).count() == 0


def test_alignment_in_small_blocks():
    """Pieces remembered from earlier blocks, slices and large groups give what one block gives."""
    pair = token_alignment.tokenizer_pair(A, B)
    pick = random.Random(4)
    texts = [" ".join(pick.choices(["alpha", "beta,", "gammaδ", "\n", "x" * 300, "日本語日本語"], k=30)) for _ in range(40)]
    whole = token_alignment._Block(pair)(texts)
    small = token_alignment._Block(pair)
    rows = [small(texts[i:i + 3]) for i in range(0, 40, 3)]
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        assert np.concatenate([r[name] for r in rows]).tolist() == whole[name].tolist()
    assert sum((r["sha"] for r in rows), []) == whole["sha"]
    total = Counter()
    for r in rows:
        total.update(dict(zip(r["pairs"].tolist(), r["docs"].tolist())))
    assert total == Counter(dict(zip(whole["pairs"].tolist(), whole["docs"].tolist())))


def test_alignment_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in QUERIES["op11_tokenizer_alignment"](spark, sf_dir).collect())
    assert got == [(r.doc_id, *x) for r, x in zip(docs, plain_alignment([r.text for r in docs]), strict=True)]
