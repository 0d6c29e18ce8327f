"""Queries: ground-truth joins, cell tallies, baselines, verdicts by slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..operators import tally as T
from .evaluation import _WILSON_SQL
from .registry import query, table

_DOCTYPE_SQL = "['court', 'medical', 'financial', 'foia', 'generic']"
_BUCKET_SQL = "['white', 'black', 'hispanic', 'asian', 'ai_an']"

#: A made corpus and its sidecar: every event is a row, three in four name a span.
_ROWS_SQL = f"""e AS (SELECT event_id AS k, user_id, event_type AS family, user_id + CASE WHEN event_id % 97 = 0 THEN 1000000 ELSE 0 END AS doc_id, event_id * 10 AS s, event_id * 10 + event_id % 9 + 1 AS t, CASE WHEN event_id % 4 <> 3 THEN ['must', 'should', 'watch', 'must_not'][event_id % 7 % 4 + 1] END AS tier FROM events),
d AS (SELECT DISTINCT user_id AS doc_id, {_DOCTYPE_SQL}[(user_id % 5 + 1)] AS doctype, {_BUCKET_SQL}[(user_id % 7 % 5 + 1)] AS bucket FROM events),
sp AS (SELECT user_id AS doc_id, s, t, CASE WHEN k % 61 = 0 THEN 'other' ELSE family END AS sf, CASE WHEN k % 53 = 0 THEN 'watch' ELSE tier END AS st, CASE WHEN t - s > 4 THEN 2 ELSE 1 END AS n_tok, k % 11 <> 0 AS classed FROM e WHERE tier IS NOT NULL AND k % 101 <> 0),
r AS (SELECT k, doc_id, s, t, family, tier, CASE WHEN tier IS NULL THEN 'fp' WHEN tier = 'must_not' THEN CASE WHEN k % 3 = 0 THEN 'fp' ELSE 'tn' END WHEN k % 5 = 0 THEN 'fn' ELSE 'tp' END AS outcome FROM e UNION ALL SELECT k, doc_id, s, t, family, tier, 'fn' FROM e WHERE tier IS NOT NULL AND k % 211 = 0),
j AS (SELECT r.*, d.doctype, d.bucket, sp.sf, sp.st, sp.n_tok, sp.classed, CASE WHEN d.doc_id IS NULL THEN 'unknown_document' WHEN r.tier IS NULL THEN NULL WHEN sp.doc_id IS NULL THEN 'no_span' WHEN sf <> family THEN 'family' WHEN st IS DISTINCT FROM r.tier THEN 'tier' END AS rule FROM r LEFT JOIN d USING (doc_id) LEFT JOIN sp ON sp.doc_id = r.doc_id AND sp.s = r.s AND sp.t = r.t AND r.tier IS NOT NULL)"""


def _pick(names: tuple[str, ...], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))


def _sidecar(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, docs, spans) of the made corpus; detections cover a span's first token, or all."""
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select(
        k, "user_id", F.col("event_type").alias("family"), (F.col("user_id") + F.when(k % 97 == 0, 1000000).otherwise(0)).alias("doc_id"), (k * 10).alias("start"), (k * 10 + k % 9 + 1).alias("end"), F.when(k % 4 != 3, _pick(("must", "should", "watch", "must_not"), k % 7 % 4)).alias("tier")
    )
    tier = F.col("tier")
    outcome = F.when(tier.isNull(), "fp").when(tier == "must_not", F.when(k % 3 == 0, "fp").otherwise("tn")).when(k % 5 == 0, "fn").otherwise("tp")
    span = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    s, t = F.col("start"), F.col("end")
    det = F.when(k % 2 == 0, F.array(span(s, s + 1))).otherwise(F.array(span(s, s + 1), span(t - 1, t)))
    names = ("event_id", "doc_id", "start", "end", "family", "tier")
    rows = e.select(*names, outcome.alias("outcome"), det.alias("det_spans"))
    rows = rows.unionByName(e.where("tier IS NOT NULL AND event_id % 211 = 0").select(*names, F.lit("fn").alias("outcome"), det.alias("det_spans")))
    docs = e.select(F.col("user_id").alias("doc_id")).distinct().select("doc_id", _pick(E.DOCTYPES, F.col("doc_id") % 5).alias("doctype"), _pick(E.BUCKETS, F.col("doc_id") % 7 % 5).alias("bucket"))
    tokens = F.when(t - s > 4, F.array(span(s, s + 2), span(s + 3, t))).otherwise(F.array(span(s, t)))
    spans = e.where("tier IS NOT NULL AND event_id % 101 != 0").select(F.col("user_id").alias("doc_id"), "start", "end", F.when(k % 61 == 0, "other").otherwise(F.col("family")).alias("family"), F.when(k % 53 == 0, "watch").otherwise(tier).alias("tier"), tokens.alias("tokens"), F.when(k % 11 != 0, "in_body").alias("context_class"))
    return rows, docs, spans


@query(f"""WITH {_ROWS_SQL}, v AS (SELECT rule FROM j WHERE rule IS NOT NULL UNION ALL SELECT 'duplicate' FROM (SELECT doc_id, s, t FROM j WHERE tier IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
 UNION ALL SELECT 'partial_annotation' FROM (SELECT count(*) FILTER (WHERE classed) AS k, count(*) AS n FROM j WHERE sf IS NOT NULL) WHERE k > 0 AND k < n) SELECT rule, count(*) AS n FROM v GROUP BY 1""")
def truth_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of a made sidecar does not agree with its corpus."""
    return T.truth_violations(T.join_truth(*_sidecar(spark, sf_dir))).groupBy("rule").agg(F.count("*").alias("n"))


_SOUND_SQL = f"{_ROWS_SQL}, g AS (SELECT *, CASE WHEN k % 2 = 0 THEN 1 ELSE n_tok END AS hit FROM j WHERE rule IS NULL AND k % 211 <> 0)"


def _sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that agree with the corpus, those without a second verdict."""
    return T.join_truth(*_sidecar(spark, sf_dir)).where("rule IS NULL AND event_id % 211 != 0")


_TALLY_SQL = """y AS (SELECT family, doctype, bucket, count(*) FILTER (WHERE outcome = 'tp') AS tp, count(*) FILTER (WHERE outcome = 'fn') AS fn, count(*) FILTER (WHERE outcome = 'fp' AND tier IS NULL) AS fp, count(*) FILTER (WHERE outcome = 'tn' OR outcome = 'fp' AND tier IS NOT NULL) AS must_not_total, count(*) FILTER (WHERE outcome = 'fp' AND tier IS NOT NULL) AS must_not_fired, count(*) FILTER (WHERE outcome = 'tp' AND hit < n_tok) AS one_token_tp,
""" + ", ".join(f"count(*) FILTER (WHERE outcome IN ('tp', 'fn') AND tier = '{t}') AS {t}_total, count(*) FILTER (WHERE outcome = 'tp' AND tier = '{t}') AS {t}_covered" for t in T.POSITIVE_TIERS) + " FROM g GROUP BY 1, 2, 3)"


@query(f"""WITH {_SOUND_SQL}, {_TALLY_SQL}, w AS (SELECT *, tp - one_token_tp AS whole, tp + fn AS n FROM y)
SELECT * EXCLUDE (whole, n), round(CASE WHEN n = 0 THEN 0 ELSE tp::DOUBLE / n END, 6) AS recall, round(CASE WHEN n = 0 THEN 0 ELSE whole::DOUBLE / n END, 6) AS recall_all_tokens, round({_WILSON_SQL('tp', 'n')[0]}, 6) AS recall_low, round({_WILSON_SQL('tp', 'n')[1]}, 6) AS recall_high, round({_WILSON_SQL('whole', 'n')[0]}, 6) AS all_tokens_low, round({_WILSON_SQL('whole', 'n')[1]}, 6) AS all_tokens_high FROM w""")
def cell_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tally of every cell, with recall by overlap and by all tokens."""
    return T.tally_view(T.cell_tallies(_sound(spark, sf_dir)))


@query(f"""WITH {_SOUND_SQL}, b AS (SELECT family, doctype, bucket, 'token_coverage' AS kind, hit || '/' || n_tok AS bin FROM g WHERE outcome = 'tp' UNION ALL SELECT family, doctype, bucket, 'detections_per_tp', (CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END)::VARCHAR FROM g WHERE outcome = 'tp')
SELECT family, doctype, bucket, kind, bin, count(*) AS n FROM b GROUP BY ALL""")
def tally_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered tokens and detections of each true positive, by cell."""
    return T.tally_histograms(_sound(spark, sf_dir))


@query(f"""WITH {_SOUND_SQL}, f AS (SELECT user_id AS doc_id, k * 10 + 3 AS s, k * 10 + 8 AS t, CASE WHEN k % 2 = 0 THEN 'header' ELSE 'footer' END AS kind FROM e WHERE k % 3 = 0),
m AS (SELECT DISTINCT g.k, g.family, g.doctype, f.kind FROM g JOIN f ON f.doc_id = g.doc_id AND f.s < g.t AND g.s < f.t WHERE outcome = 'fp' AND tier IS NULL),
u AS (SELECT family, doctype, kind FROM m UNION ALL SELECT family, doctype, 'unattributed' FROM g WHERE outcome = 'fp' AND tier IS NULL AND k NOT IN (SELECT k FROM m))
SELECT family, doctype, kind, count(*) AS n FROM u GROUP BY 1, 2, 3""")
def furniture_false_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spurious detections by the page furniture that they touch."""
    k = F.col("event_id")
    regions = table(spark, sf_dir, "events").where(k % 3 == 0).select(F.col("user_id").alias("doc_id"), (k * 10 + 3).alias("start"), (k * 10 + 8).alias("end"), F.when(k % 2 == 0, "header").otherwise("footer").alias("kind"))
    return T.furniture_counts(_sound(spark, sf_dir), regions)


_CELLS_SQL = """cl AS (SELECT event_type AS family, doctype, bucket, count(*) FILTER (WHERE h = 0) AS true_positives, count(*) FILTER (WHERE h = 1) AS false_positives, count(*) FILTER (WHERE h = 2) AS false_negatives, count(*) FILTER (WHERE h >= 3) AS adversarial_suppress_total, count(*) FILTER (WHERE h = 3) AS adversarial_suppress_fired, count(*) FILTER (WHERE h = 5) AS suppressed_by_negative_context,
count(*) FILTER (WHERE h % 3 = 0) AS tier_must_total, count(*) FILTER (WHERE h = 0) AS tier_must_covered, count(*) FILTER (WHERE h % 3 = 1) AS tier_should_total, count(*) FILTER (WHERE h = 1) AS tier_should_covered, count(*) FILTER (WHERE h % 3 = 2) AS tier_watch_total, count(*) FILTER (WHERE h = 2) AS tier_watch_covered, count(*) FILTER (WHERE h >= 4) AS tier_must_not_total, count(*) FILTER (WHERE h = 4) AS tier_must_not_fired
FROM (SELECT event_type, ['court', 'medical', 'financial', 'foia', 'generic'][(user_id % 4 + 1)] AS doctype, ['white', 'black', 'hispanic', 'asian', 'ai_an'][(user_id % 7 % 4 + 1)] AS bucket, (event_id * 7) % 6 AS h FROM events {where}) GROUP BY 1, 2, 3)"""
_AXIS_SQL = ", ".join(f"sum({c})::BIGINT AS {c}" for c in E.COUNTERS)
_BLOCK_SQL = f"""lv AS (SELECT CASE grouping(family, doctype, bucket) WHEN 0 THEN 'cell' WHEN 3 THEN 'family' WHEN 5 THEN 'doctype' WHEN 6 THEN 'bucket' ELSE 'total' END AS level, CASE WHEN grouping(family) = 0 THEN family ELSE '*' END AS family, CASE WHEN grouping(doctype) = 0 THEN doctype ELSE '*' END AS doctype, CASE WHEN grouping(bucket) = 0 THEN bucket ELSE '*' END AS bucket, {_AXIS_SQL} FROM cl GROUP BY GROUPING SETS ((family, doctype, bucket), (family), (doctype), (bucket), ())),
dm AS (SELECT 'doctype' AS level, '*' AS family, unnest({_DOCTYPE_SQL}) AS doctype, '*' AS bucket UNION ALL SELECT 'bucket', '*', '*', unnest({_BUCKET_SQL})),
al AS (SELECT coalesce(lv.level, dm.level) AS level, coalesce(lv.family, dm.family) AS family, coalesce(lv.doctype, dm.doctype) AS doctype, coalesce(lv.bucket, dm.bucket) AS bucket, {", ".join(f"coalesce({c}, 0) AS {c}" for c in E.COUNTERS)} FROM lv FULL JOIN dm ON lv.level = dm.level AND lv.family = dm.family AND lv.doctype = dm.doctype AND lv.bucket = dm.bucket)"""


def _ratio_sql(n: str, d: str, empty: str = "0") -> str:
    return f"CASE WHEN {d} = 0 THEN {empty}::DOUBLE ELSE ({n})::DOUBLE / ({d}) END"


def _fbeta_sql(p: str, r: str, b2: str) -> str:
    return f"CASE WHEN {b2} * {p} + {r} = 0 THEN 0::DOUBLE ELSE (1.0::DOUBLE + {b2}) * {p} * {r} / ({b2} * {p} + {r}) END"


def _metrics_sql() -> str:
    tp, fp, fn, fired = "true_positives", "false_positives", "false_negatives", "adversarial_suppress_fired"
    base = {"p": _ratio_sql(tp, f"({tp} + {fp})"), "r": _ratio_sql(tp, f"({tp} + {fn})")}
    for t in ("must", "should"):
        k = f"tier_{t}_covered"
        base |= {f"{t}_p": _ratio_sql(k, f"({k} + tier_must_not_fired)", "1"), f"{t}_r": _ratio_sql(k, f"tier_{t}_total")}
    one, four = "1.0::DOUBLE", "4.0::DOUBLE"
    out = {"precision": "p", "recall": "r", "f1": _fbeta_sql("p", "r", one), "f2": _fbeta_sql("p", "r", four), "decoy_fp_rate": _ratio_sql(fired, "adversarial_suppress_total"), "precision_with_decoys": _ratio_sql(tp, f"({tp} + {fp} + {fired})")}
    bands = {"precision": (tp, f"({tp} + {fp})"), "recall": (tp, f"({tp} + {fn})"), "must_recall": ("tier_must_covered", "tier_must_total"), "should_recall": ("tier_should_covered", "tier_should_total"), "must_not": ("tier_must_not_fired", "tier_must_not_total")}
    for name, (k, n) in bands.items():
        out[f"{name}_low"], out[f"{name}_high"] = _WILSON_SQL(k, n)
    for t in ("must", "should"):
        out |= {f"{t}_recall": f"{t}_r", f"{t}_precision": f"{t}_p", f"{t}_f1": _fbeta_sql(f"{t}_p", f"{t}_r", one), f"{t}_f2": _fbeta_sql(f"{t}_p", f"{t}_r", four)}
    out |= {"watch_covered_rate": _ratio_sql("tier_watch_covered", "tier_watch_total"), "must_not_fire_rate": _ratio_sql("tier_must_not_fired", "tier_must_not_total")}
    named = ", ".join(f"{v} AS {k}" for k, v in base.items())
    rounded = ", ".join(f"round({v}, 6) AS {k}" for k, v in out.items())
    return f"mb AS (SELECT *, {named} FROM al), mv AS (SELECT * EXCLUDE ({', '.join(base)}), {rounded}, {tp} + {fn} AS support_n, {tp} + {fp} AS detections_n, {fp} + {fired} AS family_false_positives, {tp} + {fn} < 30 AS low_confidence FROM mb)"


def _cells(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    h = F.col("h")
    rows = table(spark, sf_dir, "events").where(where).select(F.col("event_type").alias("family"), _pick(E.DOCTYPES, F.col("user_id") % 4).alias("doctype"), _pick(E.BUCKETS, F.col("user_id") % 7 % 4).alias("bucket"), ((F.col("event_id") * 7) % 6).alias("h"))
    flags = (h == 0, h == 1, h == 2, h >= 3, h == 3, h == 5, h % 3 == 0, h == 0, h % 3 == 1, h == 1, h % 3 == 2, h == 2, h >= 4, h == 4)
    return rows.groupBy("family", "doctype", "bucket").agg(*(F.count_if(f).alias(c) for f, c in zip(flags, E.COUNTERS, strict=True)))


@query(f"WITH {_CELLS_SQL.format(where='')}, {_BLOCK_SQL}, {_metrics_sql()} SELECT * FROM mv")
def baseline_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole metric block of every cell, axis value and of the total, from 14 counters;
    the doctype and the bucket that no event has are there."""
    return E.baseline(_cells(spark, sf_dir))


_FAMILIES = ("mrn", "click", "view", "purchase", "itin")
_SIDE_SQL = lambda side: f"{side} AS (SELECT family, doctype, bucket, level, precision, precision_with_decoys AS pd, recall FROM (WITH {_CELLS_SQL.format(where='WHERE event_id % 2 = ' + ('0' if side == 'be' else '1'))}, {_BLOCK_SQL}, {_metrics_sql()} SELECT * FROM mv))"
_CLAUSE_SQL = """cs AS (SELECT *, ap - bp >= 0.05 AS w1, ap - bp < -1e-12 AND name NOT IN ('mrn', 'ein') AS r1, 1.0::DOUBLE - apd <= (1.0::DOUBLE - bpd) * (1 - 0.3::DOUBLE) AS w2, 1.0::DOUBLE - apd > (1.0::DOUBLE - bpd) + 1e-12 AS r2, ar >= br - 0.01::DOUBLE AS w3, ar < br - 0.01::DOUBLE AS r3 FROM ps),
vs AS (SELECT name, coalesce(r1 OR r2 OR r3, false) AS regression, CASE WHEN name IN ('mrn', 'ein') THEN NOT (r1 OR r2 OR r3) ELSE w1 AND w2 AND w3 END AS win, concat_ws(',', CASE WHEN r1 THEN 'C1' END, CASE WHEN r2 THEN 'C2' END, CASE WHEN r3 THEN 'C3' END) AS failed FROM cs)"""


@query(f"""WITH {_SIDE_SQL('be')}, {_SIDE_SQL('af')}, nm AS (SELECT unnest({list(_FAMILIES)}) AS name), ps AS (SELECT name, be.precision AS bp, af.precision AS ap, be.pd AS bpd, af.pd AS apd, be.recall AS br, af.recall AS ar FROM nm LEFT JOIN be ON be.family = name AND be.level = 'family' LEFT JOIN af ON af.family = name AND af.level = 'family'
 UNION ALL SELECT 'aggregate', be.precision, af.precision, be.pd, af.pd, be.recall, af.recall FROM be JOIN af ON be.level = 'total' AND af.level = 'total'), {_CLAUSE_SQL},
sl AS (SELECT coalesce(bool_or(af.precision - be.precision < -0.03::DOUBLE), false) AS bad FROM be JOIN af USING (level, doctype, bucket) WHERE level IN ('doctype', 'bucket'))
SELECT name, CASE WHEN name = 'aggregate' THEN regression OR bad ELSE regression END AS regression, CASE WHEN name = 'aggregate' THEN win AND NOT bad ELSE win END AS win, CASE WHEN name = 'aggregate' AND bad THEN concat_ws(',', nullif(failed, ''), 'C4') ELSE failed END AS failed FROM vs, sl""")
def slice_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the families and of the aggregate between two halves of the events; the
    aggregate also answers for its doctype and bucket slices."""
    before, after = (E.baseline(_cells(spark, sf_dir, f"event_id % 2 = {side}")).cache() for side in (0, 1))
    families = E.family_verdicts(before.where("level = 'family'"), after.where("level = 'family'"), _FAMILIES)
    total = [b.where("level = 'total'").withColumn("family", F.lit("aggregate")) for b in (before, after)]
    slices = E.slice_verdicts(*(b.where("level IN ('doctype', 'bucket')") for b in (before, after)), ["level", "doctype", "bucket"])
    aggregate = E.with_slices(E.family_verdicts(*total, ("aggregate",)), slices)
    names = (F.col("family").alias("name"), "regression", "win", "failed")
    return families.select(*names).unionByName(aggregate.select(*names))


@query("""WITH r AS (SELECT event_type || '_' || ['court', 'medical', 'financial', 'foia', 'generic', 'memo'][(user_id % 6 + 1)] || '_' || ['white', 'black', 'hispanic', 'asian', 'ai_an'][(event_id % 5 + 1)] AS key FROM events)
SELECT DISTINCT key, regexp_extract(key, '^(.+)_(court|medical|financial|foia|generic)_(white|black|hispanic|asian|ai_an)$', ['family', 'doctype', 'bucket']) AS parts FROM r""".replace("SELECT DISTINCT key, regexp", "SELECT DISTINCT key, parts.family AS family, parts.doctype AS doctype, parts.bucket AS bucket FROM (SELECT key, CASE WHEN regexp_matches(key, '^(.+)_(court|medical|financial|foia|generic)_(white|black|hispanic|asian|ai_an)$') THEN regexp").replace(" AS parts FROM r", " END AS parts FROM r)"))
def cell_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell keys taken apart, null where they end in no known pair."""
    key = F.concat_ws("_", F.col("event_type"), _pick((*E.DOCTYPES, "memo"), F.col("user_id") % 6), _pick(E.BUCKETS, F.col("event_id") % 5))
    return table(spark, sf_dir, "events").select(key.alias("key"), E.cell_key(key).alias("p")).distinct().select("key", "p.family", "p.doctype", "p.bucket")


@query("""WITH s AS (SELECT DISTINCT event_type AS category, CASE event_id % 3 WHEN 0 THEN 'redact' WHEN 1 THEN 'suppress' ELSE 'flag' END AS outcome, user_id AS doc_id, event_id FROM events), k AS (SELECT category, count(*) AS total FROM s WHERE outcome = 'redact' AND doc_id % 3 = 0 GROUP BY 1)
SELECT category, coalesce(total, 0) AS total FROM (VALUES ('click'), ('view'), ('purchase'), ('none')) d(category) LEFT JOIN k USING (category)""")
def truth_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans to redact in a split's documents, by category."""
    k = F.col("event_id")
    spans = table(spark, sf_dir, "events").select(F.col("event_type").alias("category"), _pick(("redact", "suppress", "flag"), k % 3).alias("expected_outcome"), F.col("user_id").alias("doc_id"))
    return T.truth_totals(spans, spans.where("doc_id % 3 = 0"), ("click", "view", "purchase", "none"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS doc_id FROM orders), b AS (SELECT c_custkey AS doc_id FROM customer) SELECT doc_id, 'unknown' AS status FROM a WHERE doc_id NOT IN (SELECT doc_id FROM b) UNION ALL SELECT doc_id, 'missing' FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a)""")
def id_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without orders, and orders without a customer."""
    return T.id_coverage(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id")))
