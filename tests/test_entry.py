"""Registered queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = {k: v for k, v in entry.oracle_sql().items() if not k.startswith(("op", "pipeline"))}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plain(v):
    v = v.tolist() if hasattr(v, "tolist") else v
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    want = sql.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    rows = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    assert rows == sorted(str([plain(r[i]) for i in order]) for r in want.fetchall())


def same_over(spark, name, **tables):
    """A query over made tables, whose rows have to be those of its SQL."""
    con = duckdb.connect()
    for t, path in tables.items():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'")
    folder = os.path.dirname(next(iter(tables.values())))
    df = entry.queries()[name](spark, folder)
    rows = sorted(str(list(r)) for r in df.collect())
    assert rows == sorted(str(list(r)) for r in con.sql(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall())
    return rows


def test_added_parts_under_keys_in_use(spark, tmp_path):
    """Keys from 1,000,000 on come twice after the change: every row of them is compared."""
    path = f"{tmp_path}/part.parquet"
    keys = [0, 1, 7, 11, 13, 91, 143, 1_000_000, 1_000_013, 1_000_065, 1_000_091, 1_000_143, 2_000_013]
    rows = [(k, None if k in (13, 1_000_143) else f"part {k % 4}", None if k == 1_000_065 else k / 8) for k in keys] + [(None, "no key", 1.0)] * 2 + [(7, "again", 2.0), (91, "again", 2.0)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_retailprice double").write.parquet(path)
    got = same_over(spark, "cutover_diff", part=path)
    assert got.count("[1000091, 'changed']") > 1


def test_phones_one_character_apart(spark, tmp_path):
    """Of numbers with one character between them the SQL of ``detect_phone`` passes over the second."""
    path = f"{tmp_path}/documents.parquet"
    texts = ["ede43f6405768150e0411590525cf", "(212) 555-0100 212-555-0101 212-555-0102", "212-555-0100  212-555-0101", "212\x0b555-0100", "212\t555\n0100\n", "9+1 212.555.0100\r\n", "+1(212)5550100", "9(212) 555 0100", "\U0001f4de2125550100\u00e9", "12125550100", "", None]
    spark.createDataFrame([(i, t, None if i == 5 else "abc"[i % 3]) for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(path)
    assert same_over(spark, "detect_phone", documents=path)


def test_no_query_takes_a_share_of_ids():
    """No SQL of a query keeps a share of its table by a remainder of its key alone."""
    import re

    for name in ("entity_language_filter", "keyword_fan_out"):
        assert not re.search(r"FROM (customer|part) WHERE \w+ % ", entry.oracle_sql()[name])


def test_entry_and_names(spark):
    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
