"""Each operator on empty tables, repeated rows, ties, nulls and clashing names."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import embedding_dedup, language_id, license_scan, minhash, packing, pii, sentence_pieces, token_counts, topk, warc, word_bpe
from sievemark.llm.queries import op8_token_counts
from sievemark.llm.storage import Workspace, among, left_out

ODD = "`a.b` int, _text string, _ids string, _hashes int, _met int, _key int, _label int, x0 int, c0 int, y0 int, hashes int, shares int"
ODD_ROW = (1, "t", "i", 2, 3, 4, 5, 6, 7, 8, 9, 10)


def odd(spark, text):
    return spark.createDataFrame([(3, text, *ODD_ROW)], f"doc_id long, text string, {ODD}")


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers

    return sentence_pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def test_clashing_names_pass_through(spark, pieces):
    df = odd(spark, "Licensed under the MIT License. a@b.org")
    teach = spark.createDataFrame([(1, "the cat", "en")], "doc_id long, text string, lang string")
    for out in (license_scan.scan(df), pii.detect(df), language_id.predict(df, language_id.fit(teach)), sentence_pieces.decode(sentence_pieces.encode(df, pieces), pieces)):
        row = out.first()
        assert tuple(row[c] for c in df.columns[2:]) == ODD_ROW and row["doc_id"] == 3
    assert minhash.near_duplicates(df, words=3).first().component_id == 3


def test_empty_tables(spark, pieces):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language_id.fit(none)
    assert model.languages == [] and language_id.predict(none, model).collect() == []
    for out in (license_scan.scan(none), pii.detect(none), sentence_pieces.decode(sentence_pieces.encode(none, pieces), pieces), packing.pack(none, word_bpe.default_path()), minhash.near_duplicates(none)):
        assert out.collect() == []


def test_token_counts_of_an_empty_table_and_repeated_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/a/documents.parquet")
    assert op8_token_counts(spark, f"{tmp_path}/a").collect() == []
    spark.createDataFrame([(1, "the cat"), (1, "the cat"), (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/b/documents.parquet")
    rows = op8_token_counts(spark, f"{tmp_path}/b").collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.ended) for r in rows) == [(0, 0, True), (1, 2, True), (1, 2, True)]


def test_runs_of_blocks_are_stitched(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN", 3)
    rng = random.Random(2)
    ids = [rng.choice([9, 1, 2, 3, 4, 5]) for _ in range(200)] + [1] * 60 + [9, 2, 9]
    (tmp_path / "a.bin").write_bytes(np.array(ids, "<u2").tobytes())
    want = [len(x) for x in "".join("|" if i == 9 else "x" for i in ids).split("|")[:-1]]
    got = token_counts.count_tokens(spark, str(tmp_path), 9, block=4).orderBy("ordinal").collect()
    assert [r.n_tokens for r in got] == want and all(r.ended for r in got)


def test_packing_keeps_large_null_and_repeated_ids(spark):
    rows = [(2**60 + 1, "one"), (2**60 + 3, "two words"), (None, "three"), (5, "same"), (5, "same"), (5, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), word_bpe.default_path(), 16).collect()
    e = word_bpe.encoder(word_bpe.default_path())
    want = sorted((str(i), zlib.crc32(e.encode(t or "") + bytes(4))) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == want
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length


def test_language_learns_from_rows_without_ids_and_keeps_its_bound(spark):
    rows = [(None, "the cat sat", "en"), (None, "der hund und", "de")] + [(1, "the the", "en")] * 5 + [(2, "die das", None), (3, None, "en")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=2)
    assert model.languages == ["de", "en"]
    same = spark.createDataFrame([(1, "x y", "aa"), (2, "x y", "bb")], "doc_id long, text string, lang string")
    got = language_id.predict(same, language_id.fit(same)).collect()
    assert [(r.lang_pred, round(r.score, 6)) for r in got] == [("aa", 0.5)] * 2  # a tie goes to the first name
    many = spark.range(300).select("id", F.concat(F.lit("word "), "id").alias("text"), F.concat(F.lit("l"), "id").alias("lang")).withColumnRenamed("id", "doc_id")
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(many)


def test_languages_teach_a_bounded_sample(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 4000).alias("text"), F.lit("en").alias("lang"))
    seen = []
    original = language_id.Workspace.write

    class Spy(language_id.Workspace):
        def write(self, df, name):
            out = original(self, df, name)
            seen.append(out.count())
            return out

    language_id.Workspace, kept = Spy, language_id.Workspace
    try:
        language_id.fit(rows, sample=50)
    finally:
        language_id.Workspace = kept
    assert 50 <= seen[0] < 400


def test_license_ties_and_repeated_rows(spark):
    text = license_scan.TEMPLATES["mit-notice"]
    df = spark.createDataFrame([(1, text), (1, text), (2, None), (3, "")], "doc_id long, text string")
    got = [(r.doc_id, [m.license for m in r.matches]) for r in license_scan.scan(df, {"b": text, "a": text}).collect()]
    assert sorted(got) == [(1, ["a", "b"]), (1, ["a", "b"]), (2, []), (3, [])]


def test_ids_outside_the_model_fail(spark, pieces):
    with pytest.raises(Exception, match="KeyError|IndexError"):
        sentence_pieces.decode(spark.createDataFrame([(1, [10**7])], "doc_id long, ids array<int>"), pieces).collect()
    twice = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert len({str(r.ids) for r in sentence_pieces.encode(twice, pieces).collect()}) == 1


def test_archive_of_repeated_rows_has_unique_record_ids(spark):
    rows = [(1, "u", "x"), (1, "u", "x"), (None, "u", "x"), (None, "v", None), (2, None, "x")]
    path = Workspace(spark, "test").fresh("archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    heads = [bytes(r.record).split(b"\r\n\r\n")[0].decode() for r in warc.read_records(spark, path).collect()]
    ids = [line for h in heads for line in h.split("\r\n") if line.startswith("WARC-Record-ID")]
    assert len(set(ids)) == len(rows)
    index = sorted((r.key or 0, r.record_type, r.refers_to or 0) for r in warc.read_index(spark, path).collect())
    assert index == [(0, "response", 0), (0, "revisit", 1), (1, "response", 0), (1, "response", 0), (2, "revisit", 1)]


def test_many_copies_of_a_vector(spark):
    rows = spark.range(30_000).select(F.col("id").alias("vec_id"), F.array(*(F.lit(float(i)) for i in range(1, 9))).cast("array<float>").alias("embedding"))
    some = spark.createDataFrame([(-5, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.5]), (None, [1.0] * 8), (-7, [1.0, 0.0]), (-8, [1.0, 0.01]), (-9, [5.0])], "vec_id long, embedding array<float>")
    got = embedding_dedup.near_duplicates(rows.unionByName(some)).cache()
    assert got.where("id >= 0 AND (n_links != 30000 OR component_id != -5 OR kept)").count() == 0
    assert sorted((r.id or 0, r.n_links, r.component_id or 0, r.kept) for r in got.where("id IS NULL OR id < 0").collect()) == [(-9, 0, -9, True), (-8, 1, -8, True), (-7, 1, -8, False), (-5, 30000, -5, True), (0, 0, 0, True)]


def test_links_of_copies_are_counted_with_their_weight(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((1_500, 16))
    near = base[:50] + 0.02 * rng.standard_normal((50, 16))
    x = np.vstack([base, near, base[:30], base[:30]]).astype(np.float32).astype(float)
    got = {r.id: r.n_links for r in embedding_dedup.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.95
    assert sum(got.values()) >= 0.99 * (link.sum() - len(x)) and all(got[i] <= link[i].sum() - 1 for i in got)


def test_a_recall_out_of_reach_fails():
    units = embedding_dedup._units(__import__("pyarrow").array(np.random.default_rng(1).standard_normal((500, 32)).tolist()))
    books = embedding_dedup.codebook(units[:, :16], 64), embedding_dedup.codebook(units[:, 16:], 64)
    with pytest.raises(ValueError, match="recall"):
        embedding_dedup.cells_for_recall(units, books, 0.5, 0.999, most=1)


def test_topk_in_groups_equals_one_group(spark, monkeypatch):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.standard_normal(6).tolist()) for i in range(200)], "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, topk.search(df, df, k=3).collect()))
    monkeypatch.setattr(topk, "QUERIES", 50)
    assert sorted(map(tuple, topk.search(df, df, k=3).collect())) == whole


def test_rows_are_looked_up_exactly(spark):
    df = spark.range(2000).withColumn("_place", F.lit("mine"))
    ids = spark.range(0, 2000, 7).union(spark.range(5000, 5100))
    assert {r.id for r in among(df, ids).collect()} >= set(range(0, 2000, 7))
    assert among(df, ids).count() < 600
    assert sorted(r.id for r in left_out(df, ids, "id").collect()) == [i for i in range(2000) if i % 7]
    assert left_out(df, ids.where("false"), "id").count() == 2000 and among(df, ids.where("false")).count() == 0


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from sievemark.llm.storage import shared_dir

    def session(master, folder):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key: folder), getCheckpointDir=lambda: None))

    assert shared_dir(session("spark://x:7077", "hdfs://a/b/")) == "hdfs://a/b"
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(session("spark://x:7077", None))


def test_small_tables_are_few_files(spark):
    work = Workspace(spark, "test")
    table = work.write(spark.range(1_000).repartition(9), "small", rows=1_000)
    assert len(table.inputFiles()) == 1 and table.count() == 1_000
    assert len(work.write(spark.range(1_000).repartition(9), "free").inputFiles()) == 9
