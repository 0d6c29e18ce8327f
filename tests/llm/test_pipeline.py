"""The corpus pipeline against a brute-force version of its stages."""

import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from sievemark.llm import language_id, pii, word_bpe

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(rng):
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        words = rng.sample(base, rng.randint(30, 90))
        rows.append((i, " ".join(words) + rng.choice(["", " mail a@b.org now", " call +1 415 555 0100 x"]), rng.choice(["en", "de", None])))
    rows += [(200 + i, rows[i][1] + " tail", "en") for i in range(0, 40, 2)]  # near copies
    rows += [(300 + i, rows[i][1], "en") for i in range(0, 40, 3)]  # exact copies
    rows += [(400, None, "en"), (401, "", "en"), (402, "12 34 !!", "en"), (403, "one two", None), (404, " ".join(["long"] * 5 + [f"z{i}" for i in range(30_000)]), "de")]
    rows += [(7, "quite another text of the same id " + " ".join(rng.sample(base, 50)), "en"), rows[9], (None, "no id " + " ".join(rng.sample(base, 40)), "en"), (None, rows[11][1], "en")]
    return [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(id, final text) of the documents that the stages keep."""
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    distinct = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    sets = [shingles(t) for _, t in distinct]
    group = list(range(len(distinct)))
    for i in range(len(distinct)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    kept = [r for i, r in enumerate(distinct) if group[i] == i]
    return sorted(((i, pii.redacted(t, pii.spans(t))) for i, t in kept), key=str)


def stages(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = seen[name] = spark.read.parquet(f"{tmp_path}/{name}")
    return seen


def test_stages_equal_brute_force(spark, tmp_path):
    rows = documents(random.Random(5))
    seen = stages(spark, tmp_path, spark.createDataFrame(rows, COLUMNS))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "pii", "packing"]
    want = brute(rows)
    got = seen["pii"].collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == want
    assert all(r.n_chars == len(r.text) and r.lang in ("en", "de") for r in got)
    tok = word_bpe.encoder(word_bpe.default_path())
    tokens = sorted(((i, len(tok.encode(t)) // 4 + 1) for i, t in want), key=str)
    packed = seen["packing"].groupBy("doc_id", (F.col("start") - F.col("start")).alias("z")).agg(F.sum("length").alias("n")).collect()
    by_id = {}
    for i, n in tokens:
        by_id[i] = by_id.get(i, 0) + n
    assert {r.doc_id: r.n for r in packed} == by_id
    fill = seen["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in fill) <= 2048 and len(fill) <= sum(n for _, n in tokens) / 2048 * 1.05 + 1
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["packing"].count()


def test_unique_ids_take_the_short_way(spark, tmp_path):
    rows = [r for i, r in enumerate(documents(random.Random(6))) if r[0] is not None and r[0] not in (7,)]
    rows = list({r[0]: r for r in rows}.values())
    seen = stages(spark, tmp_path, spark.createDataFrame(rows, COLUMNS))
    assert sorted(((r.doc_id, r.text) for r in seen["pii"].collect()), key=str) == brute(rows)


def test_empty_table_and_clashing_names(spark, tmp_path):
    more = ", score double, lang_pred string, spans string, row_key string, _place long, `a.b` int, x0 int, c0 int, id long, component_id long"
    empty = stages(spark, tmp_path / "a", spark.createDataFrame([], COLUMNS + more))
    assert all(df.count() == 0 for df in empty.values())
    row = (1, "Write to a@b.org please and all the others here", "en", "s", 5, 0.25, "mine", "own", "k", 9, 3, 4, 5, 6, 7)
    seen = stages(spark, tmp_path / "b", spark.createDataFrame([row], COLUMNS + more))
    kept = seen["pii"].first()
    assert tuple(kept)[5:] == row[5:] and kept.text.startswith("Write to <EMAIL>")


def test_without_labels_every_document_with_letters_stays(spark):
    docs = spark.createDataFrame([(1, "abc", None, "s", 3), (2, "12", None, "s", 2)], COLUMNS)
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()] == [1]
    assert language_id.fit(docs).languages == []
