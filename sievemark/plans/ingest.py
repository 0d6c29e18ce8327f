"""Queries: normalising, merging and lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import last_token, nfkc_lower, tokens
from ..operators import gazetteer as G
from ..operators import merge as M
from .registry import query, table

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("""
WITH s AS (SELECT l_partkey, sum(l_quantity) AS total, sum(CASE WHEN o_orderpriority LIKE '1%' THEN l_quantity ELSE 0 END) AS a, sum(CASE WHEN o_orderpriority LIKE '2%' THEN l_quantity ELSE 0 END) AS b,
  sum(CASE WHEN o_orderpriority LIKE '3%' THEN l_quantity ELSE 0 END) AS c, sum(CASE WHEN o_orderpriority LIKE '4%' THEN l_quantity ELSE 0 END) AS d, sum(CASE WHEN o_orderpriority LIKE '5%' THEN l_quantity ELSE 0 END) AS e
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
r AS (SELECT l_partkey, 100.0::DOUBLE * a / total AS a, 100.0::DOUBLE * b / total AS b, 100.0::DOUBLE * c / total AS c, 100.0::DOUBLE * d / total AS d, 100.0::DOUBLE * e / total AS e FROM s),
g AS (SELECT *, greatest(a, b, c, d, e) AS top FROM r)
SELECT CASE WHEN top < 40 THEN 'unlabeled' WHEN a = top THEN 'white' WHEN b = top THEN 'black' WHEN c = top THEN 'asian' WHEN d = top THEN 'ai_an' ELSE 'hispanic' END AS bucket, count(*) AS n, min(l_partkey) AS least FROM g GROUP BY 1""")
def plurality_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plurality label of each part, by its share of quantity in five order priorities."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    sums = rows.groupBy("l_partkey").agg(F.sum("l_quantity").alias("total"), *(F.sum(F.when(F.col("o_orderpriority").startswith(str(i + 1)), F.col("l_quantity")).otherwise(0.0)).alias(f"s{i}") for i in range(5)))
    shares = {label: 100.0 * F.col(f"s{i}") / F.col("total") for i, label in enumerate(M.DEMOGRAPHICS[:5])}
    return sums.select("l_partkey", M.plurality(shares).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"), F.min("l_partkey").alias("least"))


def _name_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    specs = [
        part.select(nfkc_lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("key"), F.lit("part").alias("source"), F.lit("white").alias("bucket"), F.col("p_partkey").alias("row_ord")),
        customer.select(nfkc_lower(F.col("c_mktsegment")).alias("key"), F.lit("segment").alias("source"), F.lit("black").alias("bucket"), F.col("c_custkey").alias("row_ord")),
        part.select(nfkc_lower(last_token(F.col("p_name"))).alias("key"), F.lit("type").alias("source"), F.lit("asian").alias("bucket"), F.col("p_partkey").alias("row_ord")),
        table(spark, sf_dir, "documents").select(nfkc_lower(F.col("lang")).alias("key"), F.lit("lang").alias("source"), F.lit("unlabeled").alias("bucket"), F.col("doc_id").alias("row_ord")),
    ]
    return M.concat_specs(specs)


_NAME_SQL = """SELECT lower(split_part(p_name, ' ', 1)) AS key, 'part' AS source, 'white' AS bucket, 0 AS spec_ord, p_partkey AS row_ord FROM part
UNION ALL SELECT lower(c_mktsegment), 'segment', 'black', 1, c_custkey FROM customer UNION ALL SELECT lower(regexp_extract(trim(p_name), '[^ ]+$')), 'type', 'asian', 2, p_partkey FROM part UNION ALL SELECT lower(lang), 'lang', 'unlabeled', 3, doc_id FROM documents"""


@query(f"""
WITH r AS ({_NAME_SQL}), f AS (SELECT key, arg_min({{'s': source, 'b': bucket}}, spec_ord * 10000000000 + row_ord) AS x FROM r WHERE key <> '' GROUP BY 1)
SELECT x.s AS source, x.b AS bucket, count(*) AS n_keys, min(key) AS least, max(key) AS most FROM f GROUP BY 1, 2""")
def first_wins_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by the source that names them first."""
    won = M.first_wins(_name_rows(spark, sf_dir).where("key != ''"), "key", ["source", "bucket"], ["spec_ord", "row_ord"])
    return won.groupBy("source", "bucket").agg(F.count("*").alias("n_keys"), F.min("key").alias("least"), F.max("key").alias("most"))


@query(f"""
WITH r AS ({_NAME_SQL}), f AS (SELECT key, arg_min(bucket, spec_ord * 10000000000 + row_ord) AS bucket FROM r WHERE key <> '' GROUP BY 1), c AS (SELECT bucket, count(*) AS n FROM f GROUP BY 1)
SELECT d.bucket, coalesce(n, 0) AS n FROM (VALUES ('white'), ('black'), ('asian'), ('ai_an'), ('hispanic'), ('unlabeled')) d(bucket) LEFT JOIN c USING (bucket)""")
def demographic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by label, every label of the closed set present."""
    won = M.first_wins(_name_rows(spark, sf_dir).where("key != ''"), "key", ["bucket"], ["spec_ord", "row_ord"])
    return M.zero_filled(won.groupBy("bucket").agg(F.count("*").alias("n")), "bucket", M.DEMOGRAPHICS)


@query(f"WITH r AS ({_NAME_SQL}) SELECT source, count(*) AS n_rows, count(DISTINCT key) AS n_keys FROM r GROUP BY 1")
def seen_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources that were read, those included whose keys earlier ones have."""
    return _name_rows(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n_rows"), F.countDistinct("key").alias("n_keys"))


@query("SELECT sha256(string_agg(p_name, chr(10) ORDER BY p_name)) AS digest, count(*) AS n_keys FROM (SELECT DISTINCT p_name FROM part)")
def source_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of the sorted distinct part names."""
    return M.keys_digest(table(spark, sf_dir, "part").select("p_name"), "p_name")


_ZIP_SQL = """q AS (SELECT lpad(l_partkey::VARCHAR, 5, '0') AS zip, n_name AS state, sum(l_quantity)::BIGINT AS area FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
r AS (SELECT zip, state, area::DOUBLE / sum(area) OVER (PARTITION BY zip)::DOUBLE AS ratio FROM q), w AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY zip ORDER BY ratio DESC, state) = 1)"""


def _zip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    places = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("state"))
    return items.join(places, F.col("l_suppkey") == F.col("s_suppkey")).select(F.lpad(F.col("l_partkey").cast("string"), 5, "0").alias("zip"), "state", F.col("l_quantity").cast("long").alias("area"))


@query(f"WITH {_ZIP_SQL} SELECT state, count(*) AS n, min(zip) AS least, round(max(ratio), 6) AS top FROM w GROUP BY 1")
def zip_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each postal code's state of the largest share, by state."""
    won = G.winners(G.area_share(_zip_rows(spark, sf_dir), "zip", "state", "area"), "zip", "share", "state")
    return won.groupBy("state").agg(F.count("*").alias("n"), F.min("zip").alias("least"), F.round(F.max("share"), 6).alias("top"))


@query(f"""WITH {_ZIP_SQL}, p AS (SELECT *, zip[1:3] AS prefix FROM w), c AS (SELECT prefix, state, count(*) AS n FROM p GROUP BY 1, 2), d AS (SELECT prefix, state AS dominant FROM c QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY n DESC, state) = 1)
SELECT zip, state, prefix, dominant FROM p JOIN d USING (prefix) WHERE state <> dominant""")
def prefix_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postal codes whose state is not the dominant one of their prefix."""
    won = G.winners(G.area_share(_zip_rows(spark, sf_dir), "zip", "state", "area"), "zip", "share", "state")
    return G.prefix_overrides(won, "zip", "state")


@query("""WITH q AS (SELECT o_custkey % 1000 AS zone, o_orderpriority AS part, sum(CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE o_orderkey % 97 END)::BIGINT AS area FROM orders GROUP BY 1, 2)
SELECT zone, part, round(CASE WHEN sum(area) OVER w = 0 THEN 1.0::DOUBLE / count(*) OVER w ELSE area::DOUBLE / (sum(area) OVER w)::DOUBLE END, 9) AS share FROM q WINDOW w AS (PARTITION BY zone)""")
def area_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of zones with and without area."""
    k = F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select((k % 1000).alias("zone"), F.col("o_orderpriority").alias("part"), F.when(k % 7 == 0, F.lit(0)).otherwise(F.col("o_orderkey") % 97).alias("area"))
    return G.area_share(rows, "zone", "part", "area").withColumn("share", F.round("share", 9))


_STRIP_SQL = lambda c: "CASE " + " ".join(f"WHEN suffix({c}, '{s}') THEN trim({c}[1:length({c}) - {len(s)}])" for s in G.STRIP_SUFFIXES) + f" ELSE {c} END"


@query(f"""
WITH u AS (SELECT lower(n_name) || ' bank, n.a.' AS name, 'agency' AS category, 0 AS o FROM nation UNION ALL SELECT lower(s_name) || CASE s_suppkey % 3 WHEN 0 THEN ', inc.' WHEN 1 THEN ' trust corp' ELSE '' END, 'supplier', 1 FROM supplier UNION ALL SELECT lower(n_name) || ' bank, n.a.', 'late', 2 FROM nation),
f AS (SELECT name, arg_min(category, o) AS category FROM u GROUP BY 1), h AS (SELECT *, trim(split_part(name, ',', 1)) AS head FROM f),
a AS (SELECT name, category, [{_STRIP_SQL('name')}, head, {_STRIP_SQL('head')}] AS every FROM h)
SELECT name, category, regexp_matches(name, '{"|".join(G.FINANCIAL_WORDS)}') AS financial, list_sort(list_distinct(list_filter(every, lambda x: x <> name AND x <> ''))) AS aliases FROM a""")
def institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institution names of three sources in order of priority, with their aliases."""
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    tail = F.when(k % 3 == 0, ", inc.").when(k % 3 == 1, " trust corp").otherwise("")
    bank = F.concat(F.lower("n_name"), F.lit(" bank, n.a."))
    sources = [nation.select(bank.alias("name"), F.lit("agency").alias("category")), supplier.select(F.concat(F.lower("s_name"), tail).alias("name"), F.lit("supplier").alias("category")), nation.select(bank.alias("name"), F.lit("late").alias("category"))]
    name = F.col("name")
    return G.priority_union(sources, "name", ["category"]).select("name", "category", G.is_financial(name).alias("financial"), G.aliases(name).alias("aliases"))


@query("""WITH p AS (SELECT unnest(string_split(p_name, ' ')) AS alias, lower(p_brand) AS canonical FROM part), u AS (SELECT * FROM p UNION ALL SELECT canonical, canonical FROM p)
SELECT alias, list_sort(list_distinct(list(canonical))) AS canonicals FROM u WHERE alias <> '' GROUP BY 1""")
def nickname_multimap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of part names to the brands that use them."""
    pairs = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("alias"), F.lower("p_brand").alias("canonical"))
    return G.multimap(pairs, "alias", "canonical")


@query("""SELECT n_name, n_nationkey FROM nation WHERE lower(n_name) IN (SELECT lower(n.n_name) FROM nation n JOIN supplier s ON s_nationkey = n_nationkey WHERE s_acctbal > 5000)""")
def semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations that have a supplier with a large balance."""
    nation = table(spark, sf_dir, "nation")
    rich = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(nfkc_lower(F.col("n_name")).alias("k"))
    return nation.join(rich, nfkc_lower(nation["n_name"]) == F.col("k"), "left_semi").select("n_name", "n_nationkey")


_CLASSES = {"court": ("the", "of", "court"), "medical": ("and", "is", "patient"), "financial": ("to", "in", "bank"), "foia": ("de", "la", "les"), "generic": ("der", "die", "und")}


@query(f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) AS keyword FROM documents), k(class, keyword) AS (VALUES {", ".join(f"('{c}', '{w}')" for c, ws in _CLASSES.items() for w in ws)}),
h AS (SELECT doc_id, class, keyword, least(count(*), 5) AS n FROM t JOIN k USING (keyword) GROUP BY 1, 2, 3)
SELECT doc_id, class, sum(n)::BIGINT AS score, count(*) AS n_terms FROM h GROUP BY 1, 2""")
def token_hits_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword evidence for each document class, each term capped."""
    words = spark.createDataFrame([(c, w) for c, ws in _CLASSES.items() for w in ws], "class string, keyword string")
    return G.capped_hits(table(spark, sf_dir, "documents"), tokens(F.col("text")), F.broadcast(words))


_PHRASES = ("the and", "of the", "to the", "in der", "100%", "guaranteed", "tamper-proof")


@query(r"""WITH p(phrase, pattern) AS (VALUES ('the and', '(?i)\bthe\s+and\b'), ('of the', '(?i)\bof\s+the\b'), ('to the', '(?i)\bto\s+the\b'), ('in der', '(?i)\bin\s+der\b'), ('100%', '(?i)\b100%'), ('guaranteed', '(?i)\bguaranteed\b'), ('tamper-proof', '(?i)\btamper-proof\b'))
SELECT phrase, sum(len(regexp_extract_all(text, pattern)))::BIGINT AS n, count(*) FILTER (WHERE regexp_matches(text, pattern)) AS n_docs FROM documents, p WHERE text IS NOT NULL GROUP BY 1""")
def banned_phrase_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of each phrase, whatever white space is between its words."""
    docs = table(spark, sf_dir, "documents")
    counts = [F.regexp_count("text", F.lit(G.phrase_pattern(p))).alias(f"c{i}") for i, p in enumerate(_PHRASES)]
    sums = docs.select(*counts).agg(*(F.struct(F.sum(f"c{i}").cast("long").alias("n"), F.sum((F.col(f"c{i}") > 0).cast("long")).alias("n_docs")).alias(f"s{i}") for i in range(len(_PHRASES))))
    each = F.array(*(F.struct(F.lit(p).alias("phrase"), F.col(f"s{i}.n"), F.col(f"s{i}.n_docs")) for i, p in enumerate(_PHRASES)))
    return sums.select(F.inline(each))


@query("""WITH RECURSIVE t AS (SELECT p_partkey AS c, p_partkey // 5 AS p FROM part), up(node, pos, depth) AS (SELECT c, p, 0 FROM t UNION ALL SELECT u.node, t.p, u.depth + 1 FROM up u JOIN t ON u.pos = t.c WHERE u.depth < 32)
SELECT node, arg_max(pos, depth) AS root, max(depth) AS depth FROM up GROUP BY 1""")
def recursive_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root above each part in a tree made from its key."""
    nodes = table(spark, sf_dir, "part").select("p_partkey", F.floor(F.col("p_partkey") / 5).alias("parent"))
    return G.roots(nodes, "p_partkey", "parent")


@query("""WITH r AS (SELECT c_nationkey AS wid, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS language, lower(c_name[10:18]) AS label FROM customer),
g AS (SELECT wid, count(DISTINCT language) AS n_languages, list_distinct(list(label)) AS labels FROM r WHERE language <> '' GROUP BY 1 HAVING count(DISTINCT language) >= 5)
SELECT wid, n_languages, unnest(labels) AS label FROM g""")
def entity_language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the entities that occur in five languages at least."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("wid"), F.when(k % 11 == 0, "").otherwise(F.col("c_mktsegment")).alias("language"), F.substring("c_name", 10, 9).alias("name"))
    return M.keep_entities(rows, "wid", "language", nfkc_lower(F.col("name")))


@query("""WITH s AS (SELECT unnest(string_split(lower(p_name), ' ')) AS w, p_partkey AS o FROM part), f AS (SELECT w, min(o) AS first FROM s GROUP BY 1)
SELECT w AS word, first, regexp_full_match(w, '[a-z][a-z''\\-]*') AS well_formed FROM f""")
def common_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words, where each first occurs, and whether it is well formed."""
    rows = table(spark, sf_dir, "part").select(F.explode(F.split(nfkc_lower(F.col("p_name")), " ")).alias("w"), "p_partkey")
    return G.word_list(rows, F.col("w"), "p_partkey")


@query("""WITH m AS (SELECT p_partkey, list_distinct([CASE WHEN p_size % 2 = 0 THEN 'court' ELSE 'generic' END, CASE WHEN p_partkey % 3 = 0 THEN 'court' ELSE 'medical' END]) AS d FROM part)
SELECT array_to_string(list_sort(d), ',') AS doctypes, count(*) AS n FROM m GROUP BY 1""")
def doctype_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doctype lists translated into the closed vocabulary, distinct and sorted."""
    names = {".legal": "court", ".generic": "generic", ".medical": "medical"}
    raw = F.array(F.when(F.col("p_size") % 2 == 0, ".legal").otherwise(".generic"), F.when(F.col("p_partkey") % 3 == 0, ".legal").otherwise(".medical"))
    rows = table(spark, sf_dir, "part").select(G.translated(raw, names).alias("d"))
    return rows.groupBy(F.array_join("d", ",").alias("doctypes")).agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT p_partkey, lower(p_name) AS name, p_brand AS b FROM part),
t AS (SELECT p_partkey, unnest([{'ord': 0, 'w': split_part(name, ' ', 1)}, {'ord': 1, 'w': split_part(name, ' ', 2)}]) AS kw, b FROM k),
u AS (SELECT p_partkey, kw.ord AS word_ord, kw.w AS keyword, unnest([{'o': 0, 's': 'phone'}, {'o': 1, 's': 'account'}]) AS sc, b FROM t),
f AS (SELECT keyword, sc.s AS category, arg_min(b, p_partkey * 100 + word_ord * 10 + sc.o) AS source FROM u GROUP BY 1, 2) SELECT * FROM f""")
def keyword_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keyword + alias) x category rows; of equal ones the first proposed."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    scopes = F.array(F.lit("phone"), F.lit("account"))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), word(1).alias("keyword"), F.array(word(2)).alias("aliases"), scopes.alias("scopes"), F.lit(None).cast("string").alias("source"), F.col("p_brand").alias("bucket"))
    return G.fanned_out(rows)
