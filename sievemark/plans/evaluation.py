"""Queries: metric tables, calibration and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import ratio, wilson
from ..operators import calibration as C
from ..operators import evaluation as E
from ..operators import gazetteer as G
from .registry import query, table

_DOCTYPES, _BUCKETS = ("court", "medical", "financial", "foia", "generic"), ("white", "black", "hispanic", "asian", "ai_an")
_LABEL_SQL = """l AS (SELECT d.doc_id, coalesce(lang, 'none') AS lang, ['court', 'medical', 'financial', 'foia', 'generic'][(d.doc_id % 4 + 1)] AS doctype, quality = 1 AS truth, n_chars > 1200 AND toxic = 0 AS predicted FROM documents d JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL)"""


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"), "n_chars")
    labels = table(spark, sf_dir, "labels").where("quality IS NOT NULL AND toxic IS NOT NULL")
    doctype = F.element_at(F.array(*map(F.lit, _DOCTYPES)), (F.col("doc_id") % 4 + 1).cast("int"))
    return docs.join(labels, "doc_id").select("doc_id", "lang", doctype.alias("doctype"), (F.col("quality") == 1).alias("truth"), ((F.col("n_chars") > 1200) & (F.col("toxic") == 0)).alias("predicted"))


_Z = 1.959963984540054
_WILSON_SQL = lambda k, n: (f"CASE WHEN {n} > 0 THEN greatest(0.0::DOUBLE, ({k}::DOUBLE / {n} + {_Z * _Z}::DOUBLE / (2.0::DOUBLE * {n})) / (1.0::DOUBLE + {_Z * _Z}::DOUBLE / {n}) - {_Z}::DOUBLE * sqrt({k}::DOUBLE / {n} * (1.0::DOUBLE - {k}::DOUBLE / {n}) / {n} + {_Z * _Z}::DOUBLE / (4.0::DOUBLE * {n} * {n})) / (1.0::DOUBLE + {_Z * _Z}::DOUBLE / {n})) END", f"CASE WHEN {n} > 0 THEN least(1.0::DOUBLE, ({k}::DOUBLE / {n} + {_Z * _Z}::DOUBLE / (2.0::DOUBLE * {n})) / (1.0::DOUBLE + {_Z * _Z}::DOUBLE / {n}) + {_Z}::DOUBLE * sqrt({k}::DOUBLE / {n} * (1.0::DOUBLE - {k}::DOUBLE / {n}) / {n} + {_Z * _Z}::DOUBLE / (4.0::DOUBLE * {n} * {n})) / (1.0::DOUBLE + {_Z * _Z}::DOUBLE / {n})) END")


@query(f"""WITH {_LABEL_SQL}, g AS (SELECT lang, count(*) FILTER (WHERE truth AND predicted) AS k, count(*) FILTER (WHERE truth) AS n FROM l GROUP BY 1)
SELECT lang, k, n, round({_WILSON_SQL('k', 'n')[0]}, 6) AS low, round({_WILSON_SQL('k', 'n')[1]}, 6) AS high FROM g""")
def wilson_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall by language with its 95 % interval."""
    g = _labelled(spark, sf_dir).groupBy("lang").agg(F.count_if(F.col("truth") & F.col("predicted")).alias("k"), F.count_if("truth").alias("n"))
    low, high = wilson(F.col("k"), F.col("n"))
    return g.select("lang", "k", "n", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


_METRIC_SQL = f"""m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS r FROM c),
x AS (SELECT * EXCLUDE (p, r), round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2.0::DOUBLE * p * r / (p + r) END, 6) AS f1, round(CASE WHEN 4 * p + r = 0 THEN 0 ELSE 5.0::DOUBLE * p * r / (4.0::DOUBLE * p + r) END, 6) AS f2,
 round(CASE WHEN fp + tn = 0 THEN 0 ELSE fp::DOUBLE / (fp + tn) END, 6) AS fpr, round({_WILSON_SQL('tp', '(tp + fn)')[0]}, 6) AS recall_low, round({_WILSON_SQL('tp', '(tp + fn)')[1]}, 6) AS recall_high, tp + fn < 30 AS low_confidence FROM m)"""
_ROLL_SQL = """c AS (SELECT CASE grouping(lang, doctype) WHEN 0 THEN 'cell' WHEN 1 THEN 'lang' WHEN 2 THEN 'doctype' ELSE 'total' END AS level, CASE WHEN grouping(lang) = 0 THEN lang ELSE '*' END AS lang, CASE WHEN grouping(doctype) = 0 THEN doctype ELSE '*' END AS doctype,
 count(*) FILTER (WHERE truth AND predicted) AS tp, count(*) FILTER (WHERE NOT truth AND predicted) AS fp, count(*) FILTER (WHERE truth AND NOT predicted) AS fn, count(*) FILTER (WHERE NOT truth AND NOT predicted) AS tn FROM l GROUP BY GROUPING SETS ((lang, doctype), (lang), (doctype), ()))"""


@query(f"WITH {_LABEL_SQL}, {_ROLL_SQL}, {_METRIC_SQL} SELECT * FROM x")
def baseline_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric block of every cell, every axis value and the whole."""
    rows = E.outcomes(_labelled(spark, sf_dir), "truth", "predicted")
    return E.metrics(E.roll_up(rows, ["lang", "doctype"], ["tp", "fp", "fn", "tn"]))


@query(f"""WITH {_LABEL_SQL}, g AS (SELECT doctype, count(*) FILTER (WHERE truth AND predicted) AS tp, count(*) FILTER (WHERE truth) AS n FROM l GROUP BY 1)
SELECT d.doctype, coalesce(tp, 0) AS tp, coalesce(n, 0) AS n, round(CASE WHEN coalesce(n, 0) = 0 THEN 0 ELSE tp::DOUBLE / n END, 6) AS recall FROM (VALUES ('court'), ('medical'), ('financial'), ('foia'), ('generic')) d(doctype) LEFT JOIN g USING (doctype)""")
def zero_filled_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall by document class, the classes without support included."""
    g = _labelled(spark, sf_dir).groupBy("doctype").agg(F.count_if(F.col("truth") & F.col("predicted")).alias("tp"), F.count_if("truth").alias("n"))
    dim = spark.createDataFrame([(d,) for d in _DOCTYPES], "doctype string")
    filled = dim.join(g, "doctype", "left").select("doctype", F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("n", F.lit(0)).alias("n"))
    return filled.withColumn("recall", F.round(ratio(F.col("tp"), F.col("n")), 6))


_SCORE_SQL = "s AS (SELECT event_type AS family, round(least(greatest(value / 500, 0), 1), 4) AS raw, user_id % 3 = 0 AS hit, event_id, user_id FROM events WHERE value IS NOT NULL)"


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.round(F.least(F.greatest(F.col("value") / 500, F.lit(0.0)), F.lit(1.0)), 4)
    return table(spark, sf_dir, "events").where("value IS NOT NULL").select(F.col("event_type").alias("family"), raw.alias("raw"), (F.col("user_id") % 3 == 0).alias("hit"), "event_id", "user_id")


@query(f"""WITH {_SCORE_SQL}, q AS (SELECT *, CASE family WHEN 'click' THEN 0.3 WHEN 'view' THEN 0.2 WHEN 'purchase' THEN 0.4 END AS cutoff FROM s)
SELECT *, round(min(CASE WHEN hit THEN least END) OVER (PARTITION BY family) - max(CASE WHEN NOT hit THEN most END) OVER (PARTITION BY family), 6) AS score_gap FROM (SELECT family, hit, count(*) AS n, count(*) FILTER (WHERE raw >= cutoff) AS above, count(*) FILTER (WHERE raw < cutoff) AS below, min(raw) AS least, max(raw) AS most, round(sum((raw * 10000)::BIGINT)::DOUBLE / 10000 / count(*), 6) AS mean,
 {", ".join(f"quantile_disc(raw, {p / 100}) AS p{p}" for p in (5, 25, 50, 75, 95))} FROM q GROUP BY 1, 2)""")
def headroom_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score summaries, nearest-rank percentiles and gaps; families without a cut-off have
    nothing above or below."""
    cutoffs = F.when(F.col("family") == "click", 0.3).when(F.col("family") == "view", 0.2).when(F.col("family") == "purchase", 0.4)
    return E.score_summary(_scores(spark, sf_dir).withColumn("cutoff", cutoffs), ["family"], "raw", "hit", "cutoff")


@query(f"""WITH {_SCORE_SQL}, c AS (SELECT *, least(greatest(raw, 1e-6::DOUBLE), 1.0::DOUBLE - 1e-6::DOUBLE) AS p, CASE family WHEN 'click' THEN 0.3::DOUBLE WHEN 'view' THEN 0.6::DOUBLE ELSE 0.5::DOUBLE END AS prior FROM s),
l AS (SELECT *, ln(p / (1.0::DOUBLE - p)) + ln(prior / (1.0::DOUBLE - prior)) AS x FROM c), v AS (SELECT *, CASE WHEN x >= 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + exp(-x)) ELSE exp(x) / (1.0::DOUBLE + exp(x)) END AS posterior FROM l)
SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'applied' WHEN 1 THEN 'fresh' WHEN 2 THEN 'mixed' ELSE 'corpus' END AS mode, round(CASE event_id % 10 WHEN 0 THEN raw WHEN 1 THEN p WHEN 2 THEN (p + posterior) / 2 ELSE posterior END, 6) AS posterior FROM v""")
def posterior_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors of raw scores in each prior mode; where the prior was applied before, the
    score itself."""
    k, raw = F.col("event_id") % 10, F.col("raw")
    prior = F.when(F.col("family") == "click", 0.3).when(F.col("family") == "view", 0.6).otherwise(0.5)
    out = F.when(k == 1, C.composed(raw, prior, "fresh")).when(k == 2, C.composed(raw, prior, "mixed")).otherwise(C.composed(raw, prior, "corpus", k == 0))
    mode = F.when(k == 0, "applied").when(k == 1, "fresh").when(k == 2, "mixed").otherwise("corpus")
    return _scores(spark, sf_dir).select("event_id", mode.alias("mode"), F.round(out, 6).alias("posterior"))


_TRUTH_SQL = "truth AS (SELECT family, count(*) FILTER (WHERE hit) + 5 AS total FROM s GROUP BY 1)"
_AT_SQL = """g AS (SELECT family, t, count(*) FILTER (WHERE hit AND raw >= t) AS tp, count(*) FILTER (WHERE NOT hit AND raw >= t) AS fp FROM s JOIN {grid} USING (family) GROUP BY 1, 2),
a AS (SELECT family, t, tp, fp, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + greatest(total - tp, 0) = 0 THEN 0 ELSE tp::DOUBLE / (tp + greatest(total - tp, 0)) END AS recall FROM g JOIN truth USING (family)),
m AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2.0::DOUBLE * precision * recall / (precision + recall) END AS f1 FROM a)"""
_COARSE_SQL = "coarse AS (SELECT DISTINCT family, round(i * 0.02::DOUBLE, 6) AS t FROM s, range(51) r(i))"


def _swept(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    found = C.score_histogram(_scores(spark, sf_dir).withColumnRenamed("raw", "score"), "family")
    return found, found.groupBy("family").agg((F.sum("hits") + 5).alias("total"))


@query(f"WITH {_SCORE_SQL}, {_TRUTH_SQL}, {_COARSE_SQL}, {_AT_SQL.format(grid='coarse')} SELECT family, t, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m")
def threshold_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 of every family at 51 thresholds."""
    scores, truth = _swept(spark, sf_dir)
    found = C.grid_metrics(scores, truth, "family", C.coarse_grid())
    return found.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(f"""WITH {_SCORE_SQL}, {_TRUTH_SQL}, {_COARSE_SQL}, {_AT_SQL.format(grid='coarse')}, centre AS (SELECT family, t AS c FROM m QUALIFY row_number() OVER (PARTITION BY family ORDER BY f1 DESC, t) = 1),
fine AS (SELECT family, t FROM coarse UNION SELECT family, round(least(greatest(c + (i - 9) * 0.002::DOUBLE, 0), 1), 6) FROM centre, range(19) r(i)),
{_AT_SQL.format(grid='fine').replace('g AS', 'g2 AS').replace('a AS (', 'a2 AS (').replace('m AS', 'm2 AS').replace('FROM g ', 'FROM g2 ').replace('FROM a)', 'FROM a2)')},
a1 AS (SELECT family, t FROM m2 WHERE recall >= 0.95 QUALIFY row_number() OVER (PARTITION BY family ORDER BY f1 DESC, t) = 1), af AS (SELECT family, t FROM m2 QUALIFY row_number() OVER (PARTITION BY family ORDER BY recall DESC, t) = 1),
b1 AS (SELECT family, t FROM m2 WHERE recall >= 0.70 QUALIFY row_number() OVER (PARTITION BY family ORDER BY f1 DESC, t DESC) = 1), c1 AS (SELECT family, t FROM m2 WHERE precision >= 0.95 QUALIFY row_number() OVER (PARTITION BY family ORDER BY f1 DESC, t DESC) = 1), cf AS (SELECT family, t FROM m2 QUALIFY row_number() OVER (PARTITION BY family ORDER BY precision DESC, t DESC) = 1)
SELECT family, CASE WHEN family <> 'signup' THEN least(coalesce(c1.t, cf.t), 0.80::DOUBLE - 0.05::DOUBLE) ELSE coalesce(c1.t, cf.t) END AS conservative, CASE WHEN family <> 'signup' THEN least(coalesce(b1.t, a1.t, af.t), 0.80::DOUBLE - 0.05::DOUBLE) ELSE coalesce(b1.t, a1.t, af.t) END AS balanced, CASE WHEN family <> 'signup' THEN least(coalesce(a1.t, af.t), 0.80::DOUBLE - 0.05::DOUBLE) ELSE coalesce(a1.t, af.t) END AS aggressive FROM af LEFT JOIN a1 USING (family) LEFT JOIN b1 USING (family) LEFT JOIN c1 USING (family) LEFT JOIN cf USING (family)
UNION ALL SELECT 'carried', 0.9, 0.8, 0.7""")
def preset_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse then refined sweep, three presets, feasibility clamp, carry-forward."""
    scores, truth = _swept(spark, sf_dir)
    coarse = C.grid_metrics(scores, truth, "family", C.coarse_grid())
    centre = C.centres(coarse, "family")
    fine = C.grid_metrics(scores.join(centre, "family"), truth, "family", C.refined_grid(F.col("centre")))
    swept = C.presets(fine, "family")
    ceilings = spark.createDataFrame([(f, 0.80) for f in ("click", "view", "error", "purchase")], "family string, most double")
    clamped = C.feasible(swept, ceilings, "family", ("conservative", "balanced", "aggressive")).drop("clamped")
    shipping = spark.createDataFrame([("carried", 0.9, 0.8, 0.7), ("click", 0.1, 0.1, 0.1)], "family string, conservative double, balanced double, aggressive double")
    return C.carry_forward(shipping, clamped, "family")


@query("""WITH d AS (SELECT doc_id, coalesce(lang, 'none') AS doctype, text FROM documents), c(category, needle) AS (VALUES ('email', '@'), ('token', 'token'), ('license', 'License'), ('absent', 'qqqqqq')),
k AS (SELECT doctype, category, count(DISTINCT doc_id) AS k FROM d JOIN c ON contains(text, needle) GROUP BY 1, 2), n AS (SELECT doctype, count(DISTINCT doc_id) AS n FROM d GROUP BY 1)
SELECT doctype, category, (coalesce(k, 0) + 1.0::DOUBLE) / (n + 2.0::DOUBLE) AS prior FROM n CROSS JOIN c LEFT JOIN k USING (doctype, category)""")
def smoothed_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothed share of documents with a hit, for every language and category."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("doctype"), "text")
    needles = {"email": "@", "token": "token", "license": "License", "absent": "qqqqqq"}
    found = F.array_compact(F.array(*(F.when(F.contains("text", F.lit(n)), c) for c, n in needles.items())))
    hits = docs.select("doc_id", "doctype", F.explode(found).alias("category"))
    categories = spark.createDataFrame([(c,) for c in needles], "category string")
    return C.smoothed_priors(docs, hits, docs.select("doctype").distinct(), categories)


@query("""WITH d AS (SELECT doc_id, lang, source, sha256('20260416:' || lang || ':' || source || ':' || doc_id)[1:16] AS k FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY k) AS rn, count(*) OVER (PARTITION BY lang, source) AS n FROM d)
SELECT doc_id, rn <= greatest(floor(n * 0.3::DOUBLE), CASE WHEN n >= 2 THEN 1 ELSE 0 END) AS calibration FROM r""")
def hash_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibration part of each (language, source), by hash rank."""
    docs = table(spark, sf_dir, "documents").where("lang IS NOT NULL AND source IS NOT NULL").select("doc_id", "lang", "source")
    return C.stratified_split(docs, ["lang", "source"], C.rank_key(F.col("lang"), F.col("source"), F.col("doc_id"))).select("doc_id", "calibration")


@query("""WITH h AS (SELECT doc_id, (('0x' || sha256('20260416:court:' || doc_id)[1:16])::UBIGINT::HUGEINT % 9223372036854775808)::BIGINT AS seed FROM documents)
SELECT doc_id, seed, CASE WHEN doc_id % 5 = 2 THEN CASE WHEN seed % 10 < 3 THEN 'es_MX' WHEN seed % 10 < 6 THEN 'es_ES' ELSE 'en_US' END ELSE 'en_US' END AS locale, ['white', 'black', 'hispanic', 'asian', 'ai_an'][doc_id % 5 + 1] AS bucket, (doc_id * 2654435761 + 7) % 5 AS fold FROM h""")
def sub_seed_locale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-document seeds, locales, buckets and folds."""
    k, seed = F.col("doc_id"), F.col("seed")
    docs = table(spark, sf_dir, "documents").select(k, C.sub_seed(F.lit("court"), k).alias("seed"))
    bucket = F.element_at(F.array(*map(F.lit, _BUCKETS)), (k % 5 + 1).cast("int"))
    return docs.select(k, seed, C.locale_of(bucket, seed).alias("locale"), bucket.alias("bucket"), C.fold_of(k, 7).alias("fold"))


_HALVES_SQL = f"""WITH {_LABEL_SQL}, h AS (SELECT doc_id % 2 = 0 AS before, CASE lang WHEN 'de' THEN 'mrn' WHEN 'en' THEN 'account' WHEN 'fr' THEN 'phone' ELSE lang END AS family, * FROM l), c AS (SELECT before, family, count(*) FILTER (WHERE truth AND predicted) AS tp, count(*) FILTER (WHERE NOT truth AND predicted) AS fp, count(*) FILTER (WHERE truth AND NOT predicted) AS fn FROM h GROUP BY 1, 2),
m AS (SELECT before, family, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall FROM c),
j AS (SELECT a.family, a.precision AS bp, b.precision AS ap, 1.0::DOUBLE - a.precision AS bf, 1.0::DOUBLE - b.precision AS af, a.recall AS br, b.recall AS ar FROM m a JOIN m b ON a.family = b.family AND a.before AND NOT b.before)"""


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    family = F.when(F.col("lang") == "de", "mrn").when(F.col("lang") == "en", "account").when(F.col("lang") == "fr", "phone").otherwise(F.col("lang"))
    rows = E.outcomes(_labelled(spark, sf_dir).withColumn("family", family), "truth", "predicted")

    def of(part: DataFrame) -> DataFrame:
        g = part.groupBy("family").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
        g = g.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
        return g.withColumn("fpr", 1.0 - F.col("precision"))

    return of(rows.where("doc_id % 2 = 0")), of(rows.where("doc_id % 2 != 0"))


@query(_HALVES_SQL + """, k AS (SELECT *, ap - bp >= 0.05 AS w1, ap - bp < -1e-12 AND family NOT IN ('mrn', 'ein') AS r1, af <= bf * 0.7::DOUBLE AS w2, af > bf + 1e-12 AS r2, ar >= br - 0.01::DOUBLE AS w3, ar < br - 0.01::DOUBLE AS r3 FROM j)
SELECT family, round(ap - bp, 9) AS d_precision, r1 OR r2 OR r3 AS regression, CASE WHEN family IN ('mrn', 'ein') THEN NOT (r1 OR r2 OR r3) ELSE w1 AND w2 AND w3 END AS win, concat_ws(',', CASE WHEN r1 THEN 'C1' END, CASE WHEN r2 THEN 'C2' END, CASE WHEN r3 THEN 'C3' END) AS failed FROM k""")
def compare_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clauses of each family between the two halves of the labels."""
    before, after = _halves(spark, sf_dir)
    judged = E.verdict(E.clauses(E.side_by_side(before, after, ["family"], ["precision", "fpr", "recall"])), "family")
    return judged.select("family", F.round(F.col("after_precision") - F.col("before_precision"), 9).alias("d_precision"), "regression", "win", "failed")


@query(f"""WITH {_LABEL_SQL}, c AS (SELECT doc_id % 2 = 0 AS before, lang, doctype, count(*) FILTER (WHERE truth AND predicted) AS tp, count(*) FILTER (WHERE truth) AS n FROM l GROUP BY 1, 2, 3),
b AS (SELECT lang, doctype, round_even(tp::DOUBLE / n * n, 0)::BIGINT AS tp, n FROM c WHERE before AND n > 0), a AS (SELECT lang, doctype, tp, n FROM c WHERE NOT before AND n > 0)
SELECT coalesce(a.lang, b.lang) AS lang, coalesce(a.doctype, b.doctype) AS leg, a.lang IS NOT NULL AND b.lang IS NOT NULL AS shared, round(a.tp::DOUBLE / a.n - b.tp::DOUBLE / b.n, 9) AS d_recall FROM a FULL JOIN b ON a.lang = b.lang AND a.doctype = b.doctype""")
def compare_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document class, leg) rows of two runs: shared ones with their change, skipped ones without."""
    rows = _labelled(spark, sf_dir)
    g = rows.groupBy((F.col("doc_id") % 2 == 0).alias("before"), "lang", F.col("doctype").alias("leg")).agg(F.count_if(F.col("truth") & F.col("predicted")).alias("tp"), F.count_if("truth").alias("n")).where("n > 0")
    rebuilt = F.bround(F.col("tp") / F.col("n") * F.col("n"), 0).cast("long")
    values = g.withColumn("recall", rebuilt / F.col("n"))
    both = E.side_by_side(values.where("before"), values.where("NOT before"), ["lang", "leg"], ["recall"], "full_outer")
    return both.select("lang", "leg", (F.col("before_recall").isNotNull() & F.col("after_recall").isNotNull()).alias("shared"), F.round(F.col("after_recall") - F.col("before_recall"), 9).alias("d_recall"))


@query(_HALVES_SQL.replace("JOIN m b ON a.family = b.family AND a.before AND NOT b.before", "JOIN m b ON a.family = b.family AND a.before AND NOT b.before WHERE a.family <> 'phone'") + """, s AS (SELECT family, br, NULL::DOUBLE AS ar FROM j WHERE family = 'mrn' UNION ALL SELECT family, br, ar FROM j WHERE family <> 'mrn')
SELECT family, CASE WHEN ar IS NULL THEN 'detector' ELSE 'both' END AS present, round(ar - br, 9) AS gap, coalesce(abs(ar - br) > 1e-12, false) AS has_gap FROM s""")
def site_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full outer join of two sites' recall: which has the family, and the gap."""
    before, after = _halves(spark, sf_dir)
    both = E.side_by_side(before.where("family != 'phone'"), after.where("family NOT IN ('phone', 'mrn')"), ["family"], ["recall"], "full_outer")
    gap = F.col("after_recall") - F.col("before_recall")
    present = F.when(F.col("after_recall").isNull(), "detector").when(F.col("before_recall").isNull(), "site").otherwise("both")
    return both.select("family", present.alias("present"), F.round(gap, 9).alias("gap"), F.coalesce(F.abs(gap) > 1e-12, F.lit(False)).alias("has_gap"))


@query(f"""WITH {_LABEL_SQL}, c AS (SELECT lang, doctype, count(*) FILTER (WHERE truth AND predicted) AS tp, count(*) FILTER (WHERE truth AND NOT predicted) AS fn FROM l GROUP BY 1, 2),
a AS (SELECT lang, doctype, unnest([{{'counter': 'tp', 'n': tp}}, {{'counter': 'fn', 'n': fn}}], recursive := true) FROM c), b AS (SELECT lang, doctype, counter, n + CASE WHEN counter = 'tp' AND lang = 'de' THEN 1 ELSE 0 END AS n FROM a WHERE lang <> 'es')
SELECT coalesce(a.lang, b.lang) AS lang, coalesce(a.doctype, b.doctype) AS doctype, coalesce(a.counter, b.counter) AS counter, coalesce(a.n, 0) AS left_n, coalesce(b.n, 0) AS right_n FROM a FULL JOIN b ON a.lang = b.lang AND a.doctype = b.doctype AND a.counter = b.counter WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def crosscheck_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that differ between two tallies, with planted differences."""
    rows = E.outcomes(_labelled(spark, sf_dir), "truth", "predicted")
    a = rows.groupBy("lang", "doctype").agg(F.sum("tp").alias("tp"), F.sum("fn").alias("fn"))
    b = a.where("lang != 'es'").withColumn("tp", F.col("tp") + (F.col("lang") == "de").cast("long"))
    return E.cell_mismatches(a, b, ["lang", "doctype"], ["tp", "fn"])


@query("""WITH c AS (SELECT n_name AS filter, c_mktsegment AS bucket, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), s AS (SELECT filter, n::DOUBLE / (sum(n) OVER (PARTITION BY filter))::DOUBLE AS share FROM c)
SELECT filter, round((max(share) - min(share)) * 100, 6) AS gap FROM s GROUP BY 1""")
def parity_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spread of segment shares in each nation, in points."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    counts = rows.groupBy(F.col("n_name").alias("filter"), F.col("c_mktsegment").alias("bucket")).agg(F.count("*").alias("n"))
    return G.parity_gaps(counts, "filter", "bucket", "n")


def _logit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an embedding table as logits: the first ten components, sharpened."""
    rows = table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL AND label IS NOT NULL")
    z = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double") * 4)
    right = F.transform(z, lambda x, i: x + F.when(i == F.col("label"), 1.5).otherwise(0.0))
    return rows.select("vec_id", right.alias("logits"), "label", F.lit("all").alias("part"))


@query()
def temperature_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temperature of least loss over all vectors taken as logits."""
    return C.fit_temperature(_logit_rows(spark, sf_dir), "logits", "label", "part")


@query()
def logistic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A penalised logistic scorer for each event type."""
    rows = _scores(spark, sf_dir).select("family", "event_id", F.array("raw", (F.col("event_id") % 7).cast("double"), (F.col("user_id") % 5).cast("double")).alias("features"), F.col("hit").cast("int").alias("label"))
    return C.fit_scorers(rows, "family", "features", "label", "event_id")


@query(f"WITH {_SCORE_SQL}, c AS (SELECT *, CASE WHEN hit THEN 1.0::DOUBLE ELSE 0 END AS y, least(greatest(raw, 1e-12::DOUBLE), 1.0::DOUBLE - 1e-12::DOUBLE) AS p FROM s), b AS (SELECT family, count(*) AS n, sum(y) / count(*) AS q, avg(-(y * ln(p) + (1.0::DOUBLE - y) * ln(1.0::DOUBLE - p))) AS nll FROM c GROUP BY 1) SELECT family, n, round(nll, 6) AS nll, round(-(q * ln(q) + (1.0::DOUBLE - q) * ln(1.0::DOUBLE - q)), 6) AS base_nll FROM b")
def scorer_nll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean loss of the raw scores, and of the base rate."""
    y, p = F.col("hit").cast("double"), F.least(F.greatest(F.col("raw"), F.lit(C.PROB_CLAMP)), F.lit(1 - C.PROB_CLAMP))
    loss = -(y * F.ln(p) + (1.0 - y) * F.ln(1.0 - p))
    g = _scores(spark, sf_dir).groupBy("family").agg(F.count("*").alias("n"), (F.sum(y) / F.count("*")).alias("q"), F.avg(loss).alias("nll"))
    q = F.col("q")
    return g.select("family", "n", F.round("nll", 6).alias("nll"), F.round(-(q * F.ln(q) + (1.0 - q) * F.ln(1.0 - q)), 6).alias("base_nll"))

