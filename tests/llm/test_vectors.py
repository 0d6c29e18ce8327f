"""Top-k search, embedding near-dedup, license scan, pipeline."""

import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import embedding_dedup, license_scan, topk


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>")


ODD = [(900, None), (901, [None, 1.0]), (902, [math.nan, 1.0]), (903, [math.inf, 0.0]), (904, [0.0, 0.0])]


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, np.round(rng.standard_normal(12), 1) * (rng.random(12) < 0.6)) for i in range(300)] + ODD + [(7, [1.0] * 12), (950, [2.0, -1.0])]
    df = table(spark, rows)
    got = {}
    for r in topk.search(df, df.where("vec_id % 50 = 0"), k=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    exact = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in exact:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in exact if i != q)[:10]
            assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert set(got) == {q for q, _ in exact if q % 50 == 0}


def test_topk_with_huge_components_and_few_rows(spark):
    df = table(spark, [(100, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 3.0]), (3, [])])
    got = [(r["rank"], r.vec_id, r.score) for r in topk.search(df, df.where("vec_id = 100"), k=10).orderBy("rank").collect()]
    assert got == [(1, 1, 2**63 - 1), (2, 3, 0), (3, 2, -(2**63))]
    assert topk.search(df.where("false"), df.where("false")).collect() == []


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 64)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 24))
    group = base[0] + 0.16 * rng.standard_normal((200, 24))
    far = base[:60] + 0.2 * rng.standard_normal((60, 24))
    x = np.vstack([base, group, far]).astype(np.float32).astype(float)
    rows = [(int(i), v) for i, v in zip(rng.permutation(1200)[: len(x)] + 1000, x)]
    got = {r.id: r for r in embedding_dedup.near_duplicates(table(spark, rows + ODD + [rows[5]])).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    ids = np.array([i for i, _ in rows])
    label = ids.copy()
    while (new := np.minimum(label, np.where(link, label[None, :], 10**9).min(1))).tolist() != label.tolist():
        label = new
    assert link.sum() > 1000
    found = sum(got[i].n_links for i in ids)
    assert 0.99 * link.sum() <= found <= link.sum()
    assert np.mean([got[i].component_id == c for i, c in zip(ids, label)]) > 0.98
    for i, _ in ODD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert len(got) == len(rows) + len(ODD)


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(table(spark, [])).collect() == []
    assert [r.kept for r in embedding_dedup.near_duplicates(table(spark, ODD[:2])).collect()] == [True, True]


def test_license_notices_at_every_place(spark):
    words = [f"w{i}" for i in range(90)]
    rows = [(0, None), (1, ""), (2, "Released under the MIT"), (3, "x" * 200_000)]
    for n, (name, text) in enumerate(sorted(license_scan.TEMPLATES.items())):
        for at in range(0, 90, 7):
            rows.append((100 + n * 100 + at, " ".join(words[:at]) + "\n" + text.upper() + " " + " ".join(words[at:])))
    cut = " ".join(license_scan.TEMPLATES["gpl"].split()[:16])
    rows.append((9999, cut + " " + " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("matches", F.lit(1))
    got = {r.doc_id: r.matches for r in license_scan.scan(df).collect()}
    names = sorted(license_scan.TEMPLATES)
    for doc, matches in got.items():
        if 100 <= doc < 9999:
            hit = {m.license: m for m in matches}[names[(doc - 100) // 100]]
            assert hit.containment == 1.0
        else:
            assert matches == []


#: License lines as they stand in documents, and others of their families.
NOTICES = {
    "Licensed under the Apache License, Version 2.0.": ["apache-2.0-notice"],
    "Released under the MIT License.": ["mit-notice"],
    "This work is licensed under the GNU General Public License, version 3.": ["gpl-notice"],
    "Licensed under CC BY-NC 4.0.": ["cc-by-nc-4.0-notice"],
    "Licensed under the GNU Lesser General Public License, version 2.1.": ["lgpl-notice"],
    "Licensed under the GNU Affero General Public License v3.": ["agpl-notice"],
    "Licensed under CC BY-SA 4.0.": ["cc-by-sa-4.0-notice"],
    "Licensed under CC BY-NC-SA 4.0.": ["cc-by-nc-sa-4.0-notice"],
    "This work is under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["cc-by-sa-4.0-name"],
    "All rights reserved.": [],
}


def test_license_lines_of_documents(spark):
    rows = [(i, "some words before\n" + line + "\nand after") for i, line in enumerate(NOTICES)]
    got = {r.doc_id: [m.license for m in r.matches] for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(NOTICES.values()))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_license_lines_of_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    named = 0
    for r in license_scan.scan(docs).collect():
        lines = [x for x in (r.text or "").split("\n") if re.search("(licensed|released) under", x, re.I)]
        assert {m.license for m in r.matches} >= {n for x in lines for n in NOTICES[x]}
        assert not lines or r.matches
        named += bool(lines)
    assert named


def test_license_bands_meet_in_their_class(spark):
    def met(templates, text):
        df = license_scan.scan(spark.createDataFrame([(text,)], "text string"), templates)
        return [m.license for m in df.first().matches], df._jdf.queryExecution().optimizedPlan().toString().lower()

    # Bands decide for longer templates, also beside a template of one shingle.
    short, long = license_scan.TEMPLATES["mit-notice"], license_scan.TEMPLATES["gpl"]
    found, plan = met({"a": short, "b": long}, f"w1 w2 {long} w3")
    assert found == ["b"] and "shiftrightunsigned" in plan + plan.replace(">>>", "shiftrightunsigned")
    assert met({"a": short, "b": long}, "w1 w2 w3 w4 w5 w6")[0] == []
    assert met({"a": short, "b": long}, short)[0] == ["a"]


def test_whole_licenses_in_long_texts(spark):
    words = " ".join(f"w{i}" for i in range(700))
    texts = {n: f"{words} {t} {words}" for n, t in license_scan.WHOLE.items()}
    cut = {f"cut {n}": " ".join(t.split()[: len(t.split()) // 2]) for n, t in license_scan.WHOLE.items()}
    df = spark.createDataFrame(sorted((texts | cut).items()), "name string, text string")
    got = {r.name: {m.license: m for m in r.matches} for r in license_scan.scan(df).collect()}
    for n in texts:
        assert got[n][n].containment == 1.0 and got[n][n].first_word <= 700
        assert n not in got[f"cut {n}"]


def test_license_bands_keep_their_bound():
    assert all(license_scan.miss(n) < 1e-3 for n in range(1, 40) if n != 2)
    sizes = [len(t.split()) - license_scan.WORDS + 1 for t in license_scan.TEMPLATES.values()]
    assert all(license_scan.miss(c) < 2e-4 for c in license_scan._classes(sizes))
