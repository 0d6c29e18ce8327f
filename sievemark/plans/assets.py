"""Queries: candidates, keyword tables, ledgers, assets and locks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calibration as C
from ..operators import gazetteer as G
from ..operators import integrity as I
from ..operators import merge as M
from ..operators import ordered as O
from ..operators import schema as S
from .registry import query, table

_PART_FILE = "'src/' || p_brand || '/' || p_partkey || CASE WHEN p_partkey % 10 = 0 THEN '.csv.sha256' ELSE '.csv' END"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made files (rel_path, sha256, bytes, source), one a part."""
    k = F.col("p_partkey")
    path = F.concat(F.lit("src/"), F.col("p_brand"), F.lit("/"), k.cast("string"), F.when(k % 10 == 0, ".csv.sha256").otherwise(".csv"))
    return table(spark, sf_dir, "part").select(k, path.alias("rel_path"), F.sha2(F.col("p_name").cast("binary"), 256).alias("sha256"), F.length("p_name").cast("long").alias("bytes"), F.col("p_type").alias("source"), "p_size")


@query(f"""WITH f AS (SELECT p_partkey AS k, {_PART_FILE} AS p, p_size FROM part), l AS (SELECT DISTINCT CASE WHEN k % 10 = 0 THEN p[1:length(p) - 7] WHEN k % 9 = 0 THEN p || '.gone' ELSE p END AS p FROM f WHERE p_size % 4 <> 0)
SELECT p AS rel_path, 'unlisted' AS status FROM (SELECT DISTINCT p FROM f) WHERE p NOT IN (SELECT p FROM l) AND p NOT IN (SELECT p || '.sha256' FROM l) UNION ALL SELECT p, 'absent' FROM l WHERE p NOT IN (SELECT p FROM f)""")
def unlisted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked files without a ledger row, and rows without a file."""
    f = _files(spark, sf_dir)
    k, p = F.col("p_partkey"), F.col("rel_path")
    ledger = f.where("p_size % 4 != 0").select(F.when(k % 10 == 0, F.regexp_replace(p, r"\.sha256$", "")).when(k % 9 == 0, F.concat(p, F.lit(".gone"))).otherwise(p).alias("rel_path"))
    return I.without_row(f, ledger)


@query(f"""WITH f AS (SELECT p_partkey AS k, {_PART_FILE} AS p, sha256(p_name) AS d, CASE p_partkey % 5 WHEN 0 THEN 'MIT' WHEN 1 THEN 'CPT AND MIT' WHEN 2 THEN 'CC-BY-4.0' WHEN 3 THEN 'Beerware' ELSE 'CC0' END AS license FROM part)
SELECT p AS rel_path, CASE k % 5 WHEN 1 THEN 'forbidden' WHEN 2 THEN 'gated' ELSE 'unknown' END AS offence FROM f WHERE k % 5 IN (1, 3) OR k % 5 = 2 AND k % 3 <> 0 UNION ALL SELECT p, 'digest' FROM f WHERE k % 17 = 0""")
def ledger_offences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License and digest offences of a made ledger."""
    f = _files(spark, sf_dir)
    k = F.col("p_partkey")
    license = F.when(k % 5 == 0, "MIT").when(k % 5 == 1, "CPT AND MIT").when(k % 5 == 2, "CC-BY-4.0").when(k % 5 == 3, "Beerware").otherwise("CC0")
    ledger = f.select("rel_path", license.alias("license"), F.when(k % 17 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    return I.ledger_check(ledger, f, f.where("p_partkey % 3 = 0"))


@query(f"""WITH f AS (SELECT p_partkey AS k, {_PART_FILE} AS p, sha256(p_name) AS d FROM part)
SELECT p AS rel_path, CASE WHEN k % 2 = 0 THEN 'built' WHEN k % 3 = 0 THEN 'installed' ELSE 'skipped' END AS origin, CASE WHEN k % 2 = 0 THEN d WHEN k % 3 = 0 THEN sha256(d) END AS sha256, CASE WHEN (k % 2 = 0 OR k % 3 = 0) AND k % 7 <> 0 THEN k % 2 = 0 END AS matches FROM f""")
def asset_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each asset comes from, and whether it is the locked one."""
    f = _files(spark, sf_dir)
    installed = f.where("p_partkey % 3 = 0").select("rel_path", F.sha2("sha256", 256).alias("sha256"))
    return I.resolved_assets(f, f.where("p_partkey % 2 = 0"), installed, f.where("p_partkey % 7 != 0"))


@query(f"""WITH f AS (SELECT p_partkey AS k, {_PART_FILE} AS p FROM part) SELECT p AS rel_path, CASE WHEN k % 5 = 0 THEN 'extra' ELSE 'changed' END AS status FROM f WHERE k % 3 <> 0 AND (k % 5 = 0 OR k % 11 = 0)""")
def lock_of_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lock against what was built alone: what is not there is not asked for."""
    f = _files(spark, sf_dir)
    present = f.where("p_partkey % 3 != 0").select("rel_path", F.when(F.col("p_partkey") % 11 == 0, F.lit("0")).otherwise(F.col("sha256")).alias("sha256"))
    return I.lock_diff(f.where("p_partkey % 5 != 0"), present, built_only=True)


@query("""SELECT CASE WHEN grouping(p_brand) = 1 THEN '*' ELSE p_brand END AS folder, count(*) AS n_files, sum(length(p_name))::BIGINT AS bytes FROM part GROUP BY ROLLUP (p_brand)""")
def folder_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes by folder, and in total."""
    return I.folder_sizes(_files(spark, sf_dir).withColumn("rel_path", F.regexp_replace("rel_path", "^src/", "")))


@query(f"""WITH f AS (SELECT {_PART_FILE} AS p, length(p_name) AS n, sha256(p_name) AS d, p_type FROM part) SELECT sha256(string_agg(p || chr(1) || n || chr(1) || d || chr(1) || p_type || chr(1), '' ORDER BY p)) AS digest, count(*) AS n_files FROM f""".replace("chr(1)", "'|'"))
def files_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint of sources, fields ended by bars, as the comparing database has no NUL."""
    return I.files_fingerprint(_files(spark, sf_dir), "|")


@query("""WITH f AS (SELECT p_name AS name, min(p_partkey) AS k FROM part GROUP BY 1) SELECT name, CASE WHEN k % 4 = 0 THEN 'not_reviewed' ELSE 'changed' END AS status FROM f WHERE k % 4 = 0 OR k % 6 = 1""")
def reviewed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live candidates that were not reviewed as they are."""
    live = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("k")).withColumn("sha256", F.sha2(F.col("name").cast("binary"), 256))
    seen = live.where("k % 4 != 0").select("name", F.when(F.col("k") % 6 == 1, F.lit("0")).otherwise(F.col("sha256")).alias("sha256"))
    return I.reviewed_version(live, seen)


@query("""SELECT p_partkey::VARCHAR || '.zip' AS rel_path, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS verified FROM part""")
def archive_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives against the digest files beside them."""
    k = F.col("p_partkey")
    archives = table(spark, sf_dir, "part").select(k, F.concat(k.cast("string"), F.lit(".zip")).alias("rel_path"), F.sha2(F.col("p_name").cast("binary"), 256).alias("sha256"))
    text = F.concat(F.when(k % 3 == 0, F.upper("sha256")).otherwise(F.sha2("sha256", 256)), F.lit("  "), F.col("rel_path"), F.lit("\n"))
    sidecars = archives.where("p_partkey % 3 != 2").select(F.concat("rel_path", F.lit(".sha256")).alias("rel_path"), text.alias("text"))
    return I.digest_rows(archives.select("rel_path", "sha256"), sidecars).select("rel_path", "verified")


@query("""SELECT p_brand IN ('Brand#11', 'Brand#12') OR starts_with(p_type, 'PROMO') AS off, count(*) AS n, sum(length(p_name))::BIGINT AS bytes, min(sha256(p_name)[1:12]) AS least FROM part GROUP BY 1""")
def out_of_band_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that a rebuild does not make, with short digests."""
    rows = table(spark, sf_dir, "part").select((I.out_of_band(F.col("p_brand"), ("Brand#11", "Brand#12")) | I.out_of_band(F.col("p_type"), ("PROMO",))).alias("off"), I.short_digest(F.col("p_name")).alias("d"))
    return rows.groupBy("off").agg(F.count("*").alias("n"), F.sum("d.bytes").alias("bytes"), F.min("d.digest").alias("least"))


@query("""WITH c AS (SELECT p_brand AS g, count(*) AS total, count(DISTINCT p_name) AS uniq FROM part GROUP BY 1 UNION ALL SELECT '*', count(*), count(DISTINCT p_name) FROM part), p AS (SELECT g, total + CASE WHEN g = 'Brand#11' THEN 1 ELSE 0 END AS wt, uniq + CASE WHEN g = '*' THEN 2 ELSE 0 END AS wu, total, uniq FROM c UNION ALL SELECT 'none', 1, 0, 0, 0)
SELECT * FROM (SELECT g AS p_brand, 'total' AS counter, wt AS wanted, total AS found FROM p UNION ALL SELECT g, 'unique', wu, uniq FROM p) WHERE wanted <> found""")
def pinned_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that are not the pinned ones."""
    part = table(spark, sf_dir, "part")
    counts = lambda df, g: df.groupBy(g.alias("p_brand")).agg(F.count("*").alias("total"), F.countDistinct("p_name").alias("unique"))
    true = counts(part, F.col("p_brand")).unionByName(counts(part, F.lit("*")))
    pins = true.select("p_brand", (F.col("total") + (F.col("p_brand") == "Brand#11").cast("long")).alias("total"), (F.col("unique") + 2 * (F.col("p_brand") == "*").cast("long")).alias("unique"))
    pins = pins.unionByName(spark.createDataFrame([("none", 1, 0)], "p_brand string, total long, unique long"))
    return I.cardinality_violations(part, pins, "p_brand", "p_name")


@query("""WITH r AS (SELECT p_partkey AS o, lower(split_part(p_name, ' ', 1)) AS keyword, p_brand AS source, CASE WHEN p_size % 2 = 0 THEN 'phone' ELSE 'account' END AS category, CASE WHEN p_size % 3 = 0 THEN 'court' ELSE 'generic' END AS doctype FROM part),
u AS (SELECT *, 0 AS spec FROM r WHERE o % 2 = 0 UNION ALL SELECT *, 1 FROM r WHERE o % 2 = 1), k AS (SELECT * FROM u WHERE NOT (source = 'Brand#11' AND keyword < 'h'))
SELECT keyword, category, doctype, arg_min(source, spec * 100000000 + o) AS source FROM k GROUP BY 1, 2, 3""")
def keyword_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First proposals of keywords, corpora before manual rows, less what is removed."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("keyword"), F.col("p_brand").alias("source"), F.when(F.col("p_size") % 2 == 0, "phone").otherwise("account").alias("category"), F.when(F.col("p_size") % 3 == 0, "court").otherwise("generic").alias("doctype"))
    removed = rows.where("source = 'Brand#11' AND keyword < 'h'").select("source", "keyword")
    return G.first_proposals(rows.where("ordinal % 2 = 0"), rows.where("ordinal % 2 = 1"), removed)


@query("""WITH r AS (SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'proposed' END AS status, p_brand AS category, p_size % 4 = 0 AS excluded, p_size % 5 = 0 AS embargoed, p_size % 2 = 0 AS candidate_only, p_container FROM (SELECT *, p_type[1:3] AS p_container FROM part))
SELECT 'keyword' AS kind, count(*) AS n, min(id) AS least FROM r WHERE status = 'approved' AND category IN ('Brand#11', 'Brand#22') UNION ALL SELECT 'issuer', count(*), min(id) FROM r WHERE NOT excluded AND NOT embargoed AND (NOT candidate_only OR p_container = 'PRO')""")
def shipped_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords and issuers that ship."""
    k, s = F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part").select(k.alias("id"), F.when(k % 3 == 0, "approved").when(k % 3 == 1, "proposed").alias("status"), F.col("p_brand").alias("category"), (s % 4 == 0).alias("excluded"), (s % 5 == 0).alias("embargoed"), (s % 2 == 0).alias("candidate_only"), F.substring("p_type", 1, 3).alias("issuer"))
    counted = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.min("id").alias("least"))
    return counted(G.shipped(rows, ("Brand#11", "Brand#22")), "keyword").unionByName(counted(G.shipped_issuers(rows, ("PRO",)), "issuer"))


@query("""WITH n AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'US ' || s_name || ' (S' || s_suppkey || ')' WHEN 1 THEN s_name || ' (see note below, which is long enough to be none)' WHEN 2 THEN s_name || '  (A & B-' || s_suppkey || ') ' ELSE 'US ' || s_name END AS v FROM supplier),
m AS (SELECT *, regexp_matches(v, '^(.+?)\\s*\\(([A-Z0-9][A-Za-z0-9&/\\- ]{0,31})\\)\\s*$') AS hit FROM n), s AS (SELECT *, trim(CASE WHEN hit THEN regexp_extract(v, '^(.+?)\\s*\\(([A-Z0-9][A-Za-z0-9&/\\- ]{0,31})\\)\\s*$', 1) ELSE v END) AS stem FROM m)
SELECT s_suppkey, stem, regexp_replace(stem, '^US (.)', '\\1') AS name, CASE WHEN hit THEN trim(regexp_extract(v, '^(.+?)\\s*\\(([A-Z0-9][A-Za-z0-9&/\\- ]{0,31})\\)\\s*$', 2)) END AS acronym FROM s""")
def acronym_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names taken apart from their acronyms."""
    k, name = F.col("s_suppkey"), F.col("s_name")
    text = k.cast("string")
    v = F.when(k % 4 == 0, F.concat(F.lit("US "), name, F.lit(" (S"), text, F.lit(")"))).when(k % 4 == 1, F.concat(name, F.lit(" (see note below, which is long enough to be none)"))).when(k % 4 == 2, F.concat(name, F.lit("  (A & B-"), text, F.lit(") "))).otherwise(F.concat(F.lit("US "), name))
    return table(spark, sf_dir, "supplier").select("s_suppkey", G.acronym(v).alias("a")).select("s_suppkey", "a.*")


@query("""WITH h AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+[0-9]*')) AS token FROM documents) SELECT source AS path, token FROM (SELECT DISTINCT source, token FROM h JOIN documents USING (doc_id) WHERE source IS NOT NULL) WHERE token NOT IN ('License', 'Licensed') AND NOT (source = (SELECT min(source) FROM documents) AND contains(token, 'er'))""")
def identifier_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier-like tokens of the documents' sources, less what is allowed."""
    docs = table(spark, sf_dir, "documents")
    tokens = spark.createDataFrame([("License",), ("Licensed",)], "token string")
    places = docs.agg(F.min("source").alias("path")).withColumn("part", F.lit("er"))
    return G.identifier_hits(docs.where("source IS NOT NULL").select(F.col("source").alias("path"), "text"), "[A-Z][a-z]+[0-9]*", tokens, places)


@query("""WITH p(phrase, pattern) AS (VALUES ('the and', '(?i)\\bthe\\s+and\\b'), ('of the', '(?i)\\bof\\s+the\\b'), ('100%', '(?i)\\b100%')), t AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL)
SELECT phrase, doc_id, len(regexp_extract_all(text, pattern)) AS n FROM t, p WHERE regexp_matches(text, pattern)""")
def phrase_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases by document, counted from the places at which they are found."""
    hits = G.phrase_hits(table(spark, sf_dir, "documents").where("text IS NOT NULL"), ["the and", "of the", "100%"])
    whole = hits.where(F.length("excerpt") >= F.col("end") - F.col("start"))
    return whole.groupBy("phrase", "doc_id").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT p_brand AS category, least(1, 0.2 + p_size / 40.0::DOUBLE) AS conservative, 0.4 + p_size / 200.0::DOUBLE AS balanced, 0.3::DOUBLE AS aggressive FROM part WHERE p_partkey <= 40 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1)
SELECT coalesce(category, w) AS category, CASE WHEN category IS NULL THEN 'absent' WHEN w IS NULL THEN 'unknown' ELSE 'order' END AS rule FROM r FULL JOIN (VALUES ('Brand#11'), ('Brand#12'), ('Brand#13'), ('Brand#21'), ('Brand#22'), ('Brand#99')) d(w) ON category = w WHERE category IS NULL OR w IS NULL OR conservative < balanced OR balanced < aggressive""")
def preset_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-set thresholds that lack a category, or do not fall from preset to preset."""
    size = F.col("p_size")
    first = table(spark, sf_dir, "part").where("p_partkey <= 40").groupBy(F.col("p_brand").alias("category")).agg(F.min_by("p_size", "p_partkey").alias("p_size"))
    rows = first.select("category", F.least(F.lit(1.0), 0.2 + size / 40.0).alias("conservative"), (0.4 + size / 200.0).alias("balanced"), F.lit(0.3).alias("aggressive"))
    return C.checked_presets(rows, ("Brand#11", "Brand#12", "Brand#13", "Brand#21", "Brand#22", "Brand#99"))


@query("""SELECT c_custkey, unnest(list_filter([CASE WHEN NOT regexp_matches(c_name, '^Customer#[0-9]+$') THEN 'c_name:pattern' END, CASE WHEN c_acctbal < 0 THEN 'c_acctbal:minimum' END, CASE WHEN c_acctbal >= 9000 THEN 'c_acctbal:exclusiveMaximum' END, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'c_mktsegment:enum' END, CASE WHEN length(c_mktsegment) > 9 THEN 'c_mktsegment:maxLength' END], lambda x: x IS NOT NULL)) AS broken FROM customer""")
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that break a JSON schema, field by field."""
    rule = {"type": "object", "required": ["c_name", "c_acctbal"], "properties": {"c_name": {"type": "string", "pattern": "^Customer#[0-9]+$"}, "c_acctbal": {"type": "number", "minimum": 0, "exclusiveMaximum": 9000}, "c_mktsegment": {"enum": ["BUILDING", "MACHINERY"], "maxLength": 9}}}
    found = S.row_violations(table(spark, sf_dir, "customer"), rule, "c_custkey")
    return found.select("c_custkey", F.concat_ws(":", "field", "rule").alias("broken"))


@query("""WITH r AS (SELECT o_orderkey, o_custkey // 10 AS k, o_custkey // 10 IS DISTINCT FROM lag(o_custkey // 10) OVER (ORDER BY o_orderkey) AS start FROM orders) SELECT k, count(*) FILTER (WHERE start) AS runs FROM r GROUP BY 1 HAVING count(*) FILTER (WHERE start) > 1""")
def broken_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of customers whose orders are not together in order of key."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_custkey") / 10).alias("k"))
    return M.broken_runs(rows, "k", "o_orderkey")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) - 1 AS ordinal FROM orders""")
def ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's place by price among those of its status."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return O.ordinals(rows, ["o_orderstatus"], ["o_totalprice", "o_orderkey"]).select("o_orderkey", "ordinal")


@query("SELECT count(DISTINCT l_comment) AS n_keys FROM (SELECT l_orderkey || ':' || l_partkey AS l_comment FROM lineitem)")
def sorted_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys behind a digest taken over ranges of the sorted keys."""
    return O.sorted_digest(table(spark, sf_dir, "lineitem").select(F.concat_ws(":", "l_orderkey", "l_partkey").alias("k")), "k").select("n_keys")
