"""The corpus pipeline against a plain version of its stages."""

import brute
import corpus_pipeline
import pytest
from awkward import CLASHES, documents, rows
from pyspark.sql import functions as F
from test_llm_quality import plain_hits

from lakeload.llm.toxicity import fit_toxicity


def test_stages(spark, sf_dir):
    """Every stage on whole texts, each judged on what the one before it kept."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = {r.doc_id: r for r in docs.collect()}

    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = {i: r.text for i, r in plain.items() if model.score(r.text.encode()) < 0.3}
    texts = {i: t for i, (t, _, _) in brute.line_dedup(list(texts.items())).items()}
    texts = {i: texts[i] for i, _, root in brute.jaccard_components(list(texts.items())) if i == root}
    items = [(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i, _ in plain_hits(list(texts.items()), items)}
    texts = {i: t for i, t in texts.items() if i not in leaks}
    want = {i: v for i, v in brute.mix([(i, plain[i].source, t) for i, t in texts.items()]).items() if v[3] > 0}

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == set(want) and 0 < len(leaks) and len(want) < len(plain)
    for i, (size, source_size, target, taken) in want.items():
        r = got[i]
        assert (r.text, r["size"], r.source_size, r.taken) == (texts[i], size, source_size, taken)
        assert r.target == pytest.approx(target) and r.source == plain[i].source
        assert r.n_chars == (plain[i].n_chars if texts[i] == plain[i].text else len(texts[i]))


def test_awkward_rows(spark, sf_dir):
    docs = documents(spark)
    for start in (docs, docs.where("false")):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf_dir)
            if name != "source_mixing":
                assert now.columns == docs.columns
            now = spark.createDataFrame(now.collect(), now.schema)
        if start is docs:
            kept = now.collect()
            assert 0 < len(kept) < len(rows())
            assert all(r[c] == "taken" for r in kept for c in CLASHES if c not in ("size", "taken", "target"))
            ids = [r.doc_id for r in kept]
            assert 30 in ids and None not in ids
        else:
            assert now.count() == 0


def test_mixture_meets_targets(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    totals = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"))
    assert all(abs(r.taken - r.target) <= 0.5 for r in totals.collect())
