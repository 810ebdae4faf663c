"""Line dedup, mixing, URL filters, license scans."""

import hashlib

import pytest
from awkward import CLASHES, COLUMNS, documents, rows, unique
from brute import line_dedup, mix, targets
from pyspark.sql import functions as F

from lakeload.llm import license_scan, line_dedup as line_module, mixing, url_filter


def test_line_dedup(spark):
    docs = documents(spark)
    got = line_module.drop_repeated_lines(docs)
    assert set(got.columns) == {*docs.columns, "n_dropped"}
    found = got.collect()
    assert len(found) == len(rows())
    want = line_dedup([(r[0], r[1]) for r in unique(rows())])
    for r in found:
        assert r["key"] == "taken"
        if r["doc_id"] is not None:
            assert (r["text"], r["n_lines"], r["n_dropped"]) == want[r["doc_id"]]
        else:
            assert r["n_dropped"] == 0
    assert sum(r["n_dropped"] for r in found) > 0
    assert line_module.drop_repeated_lines(docs.where("false")).count() == 0


def test_line_rules(spark):
    line = "É" + "a" * 39
    data = [(i, f"{'' if i else chr(9)}{line}\x0b\nkeep") for i in range(5)] + [(7, line.lower()), (8, line[:-1])]
    found = {r.doc_id: r for r in line_module.drop_repeated_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert [found[i].text for i in range(4)] == ["keep"] * 4 and line in found[4].text
    assert found[7].n_dropped == 0 and found[8].n_dropped == 0


def test_mixing(spark):
    plain = unique(rows())
    got = {r.doc_id: r for r in mixing.mix_sources(spark.createDataFrame(plain, COLUMNS)).collect()}
    want = mix([(r[0], r[3], r[1]) for r in plain])
    assert set(got) == set(want)
    taken = {}
    for i, (size, source_size, target, words) in want.items():
        assert (got[i]["size"], got[i].source_size, got[i].taken) == (size, source_size, words), i
        assert got[i].target == pytest.approx(target)
        assert words <= 3 * size
        taken.setdefault(got[i].source, [0, target])[0] += words
    assert all(abs(words - target) <= 0.5 for words, target in taken.values())


def test_mixing_awkward_rows(spark):
    docs = documents(spark)
    got = mixing.mix_sources(docs)
    assert set(got.columns) == {*docs.columns, "source_size", "epochs"} and got.count() == len(rows())
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix_sources(docs.repartition(5)).collect()))
    assert mixing.mix_sources(docs.where("false")).count() == 0
    assert mixing.mix_sources(docs.where("text is null")).agg(F.sum("taken")).first()[0] == 0


@pytest.mark.parametrize("chars", [6, 1000, 100_000])
def test_mixing_ranges_are_even(spark, monkeypatch, chars):
    """No range holds much of a source, also where texts have hardly any blanks."""
    seen, stored = [], mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: seen.append(stored(df, name)) or seen[-1])
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"),
                                      F.expr(f"CASE WHEN id % 10 = 0 THEN 'short' ELSE repeat('x', {chars}) END").alias("text"))
    got = mixing.mix_sources(docs, keep=["doc_id"], budget=7_777)
    assert got.agg(F.sum("taken")).first()[0] == 7_777
    per_range = [r["count"] for r in seen[0].groupBy("range").count().collect()]
    assert sum(per_range) == 20_000 and max(per_range) <= 40


@pytest.mark.parametrize("sizes", [{"a": 5}, {"a": 1, "b": 1000, "c": 3}, {"a": 0, "b": 10}, {None: 7, "": 7, "z": 7, "é": 90}, {"a": 0}])
def test_source_targets(spark, sizes):
    df = spark.createDataFrame([(("1" if s is None else "0" + s), n) for s, n in sizes.items()], "src string, source_size long")
    got = {r.src: r.target for r in mixing.source_targets(df).collect()}
    for s, value in targets(sizes).items():
        assert got["1" if s is None else "0" + s] == pytest.approx(value)


RULES = (url_filter.UrlRule("allow", "com"), url_filter.UrlRule("block", "example.com", "/en/"), url_filter.UrlRule("allow", "www.example.com", "/en/"))
URLS = {
    "http://EXAMPLE.com/en/x?y#z": ("example.com", "/en/x", "example.com/en/", "block"),
    "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://example.com": ("example.com", "", None, "allow"),
    "http://free-poker.org/#x": ("free-poker.org", "/", None, "block"),
    "http://freedom-poker.org/": ("freedom-poker.org", "/", None, "allow"),
    "http://free-free.org/": ("free-free.org", "/", None, "allow"),
    "http://x.org/PORN": ("x.org", "/PORN", None, "block"),
    "http://x.org/pornography": ("x.org", "/pornography", None, "allow"),
    "x.org/casino": ("", "", None, "block"), "": ("", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"),
}


def test_urls(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(99, None), (99, None)], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit("x"), "rule": F.lit("y"), "hits": F.lit(1)})
    got = url_filter.filter_urls(pages, RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == URLS.get(r.url, ("", "", None, "allow")), r.url
    assert url_filter.filter_urls(pages.where("false"), RULES).count() == 0


def test_licenses(spark):
    texts = {
        1: "Released under the MIT License.", 2: "x\nLicensed under the Apache License, Version 2.0.", 3: "CC BY-NC 4.0 cc by nc",
        4: "This work is licensed under the GNU General Public License, version 3.", 5: "under the mit lice nse", 6: None, 7: "",
        8: "under the mit license under the mit license é5", 9: "licensed under apache", 10: "word " * 50_000 + "under the MIT license"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({"labels": F.lit(1), "score": F.lit("s")})
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    short = {i: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for i, r in got.items()}
    assert short == {
        1: (5, 1, 1, 1, "mit", "mit"), 2: (9, 1, 4, 4, "apache-2", "apache-2"), 3: (8, 2, 0, 5, "cc-by-nc", "cc-by-nc"),
        4: (12, 0, None, None, "", "gpl-3"), 5: (5, 0, None, None, "", ""), 6: (0, 0, None, None, "", ""), 7: (0, 0, None, None, "", ""),
        8: (9, 2, 0, 4, "mit", "mit"), 9: (3, 0, None, None, "", ""), 10: (50_004, 1, 50_000, 50_000, "mit", "mit")}
    assert all(0 <= r.score <= 1 for r in got.values()) and got[4].score == 1 and got[5].score == 0
    assert license_scan.scan_licenses(docs.where("false")).count() == 0
    assert license_scan.scan_licenses(documents(spark)).count() == len(rows())


def test_template_join_finds_every_match():
    """The filters lose nothing: the index agrees with counting every template in every block."""
    import random

    pick = random.Random(5)
    words = [w for _, t in license_scan.TEMPLATES for w in t.split()]
    counts = {w: pick.randrange(50) for w in words}
    index = license_scan.TemplateIndex(license_scan.TEMPLATES, counts, 0.8)
    for _ in range(400):
        _, text = pick.choice(license_scan.TEMPLATES)
        block = [w for w in text.split() if pick.random() < 0.9] + pick.choices(words, k=pick.randrange(6)) + ["other"]
        want = set()
        for label, template in license_scan.TEMPLATES:
            own = set(template.split())
            if 10 * len(own & set(block)) >= 8 * len(own):
                want.add((label, len(own & set(block)) / len(own)))
        assert set(index.matches([w.encode() for w in block])) == want


def test_license_notices_across_lines(spark):
    """Notices wrapped as in source files, at every offset; words strewn over a long line are no notice."""
    import textwrap

    cases, want = [], {}
    for number, (label, text) in enumerate(license_scan.TEMPLATES):
        for width in (20, 40, 72):
            cases.append((len(cases), "\n".join(f"# {line}" for line in textwrap.wrap(text, width))))
            want[len(cases) - 1] = label
        for before in range(0, 2 * len(text.split()), 3):
            cases.append((len(cases), "other " * before + "\n".join(textwrap.wrap(text, 30)) + " other" * 50))
            want[len(cases) - 1] = label
        cases.append((len(cases), "".join(w + " other" * 40 + " " for w in text.split())))
        want[len(cases) - 1] = None
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(cases, "doc_id long, text string")).collect()}
    for i, label in want.items():
        assert got[i].labels == "" if label is None else label in got[i].labels.split(",") and got[i].score == 1, cases[i]


def test_license_blocks_are_exact():
    import random

    pick = random.Random(3)
    words = [w for _, t in license_scan.TEMPLATES for w in t.split()]
    index = license_scan.TemplateIndex(license_scan.TEMPLATES, {w: pick.randrange(50) for w in words}, 0.8)
    for _ in range(60):
        label, text = pick.choice(license_scan.TEMPLATES)
        own = []
        for w in text.split():
            own += ([w] if pick.random() < 0.95 else []) + ["other"] * pick.choice((0, 0, 1, 2))
        block = ["other"] * pick.randrange(40) + own + pick.choices(words, k=pick.randrange(30))
        most = max(len(set(text.split()) & set(block[k:k + 2 * len(text.split())])) for k in range(len(block)))
        size = len(set(text.split()))
        assert ((label, most / size) in index.matches_in_blocks([w.encode() for w in block])) == (10 * most >= 8 * size)


def test_licenses_of_one_family_are_told_apart(spark):
    lgpl = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
            "License as published by the Free Software Foundation; either version 3 of the License")
    cases = {
        "Released under the BSD license.": "", "Released under the BSD license.\nMit freundlichen Grüßen": "",
        "Licensed under CC BY 4.0": "", "Licensed under CC BY-SA 4.0": "", "Licensed under CC NC 4.0": "cc-by-nc",
        "This work is licensed under the GNU General Public License version 2": "",
        "This work is licensed under the GNU General Public License version 2. See our manual, version 3": "",
        "This work is licensed under the GNU Affero General Public License version 3": "",
        "This work is licensed under the GNU General Public License v3": "gpl-3",
        "This work is licensed under the GNU General Public License, version 2 or version 3": "gpl-3",
        "Licensed under the Apache License 2.0": "apache-2", "Licensed under the Apache 2.0 License": "apache-2",
        "Licensed under the Apache License, Version 1.1": "", "Released under the MIT open source license": "mit", lgpl: "",
        lgpl.replace("Lesser ", "").replace("library", "program"): "gpl",
        "You can redistribute it and/or modify it under the terms of the CeCILL license": "",
        "This Source Code Form is subject to the terms of the Common Public License": "",
        "Permission to use, copy, modify, and/or distribute this software and its documentation for any purpose is hereby granted": "",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software": "",
        "Redistribution and use in source and binary forms, with or without modification, are not permitted": "",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": ""}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(docs).collect()}
    assert {text: got[i] for i, text in enumerate(cases)} == cases


def test_license_query(spark, sf_dir):
    """The base part of the query against a plain version."""
    import re

    from lakeload.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in QUERIES["op9_license_scan"](spark, sf_dir).collect():
        words = word.findall(re.sub("[A-Z]", lambda m: m.group().lower(), texts[r.doc_id] or ""))
        places = [(k, label) for phrase, label in license_scan.PHRASES.items() for k in range(len(words))
                  if words[k:k + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert (r.first_word, r.last_word) == (min(places)[0] if places else None, max(places)[0] if places else None)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_line_query_hash(spark, sf_dir):
    from lakeload.llm.queries import QUERIES

    want = line_dedup([tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()])
    for r in QUERIES["op6_line_dedup"](spark, sf_dir).collect():
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id][0].encode()).hexdigest()


def test_clashing_names_survive(spark):
    docs = documents(spark, lambda r: r[0] is not None)
    for out in (line_module.drop_repeated_lines(docs), mixing.mix_sources(docs)):
        row = out.first()
        assert all(row[c] == "taken" for c in CLASHES if c not in ("n_lines", "size", "taken", "target"))
