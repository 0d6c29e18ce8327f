"""Queries: evaluation of whole documents, leg by leg."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import ratio
from ..operators import documents as D
from ..operators import evaluation as E
from .evaluation import _WILSON_SQL
from .registry import query, table
from .reports import _CLAUSE_SQL, _fbeta_sql, _pick, _ratio_sql

_STATUS_SQL = "CASE l_orderkey % 4 WHEN 0 THEN ['rich', 'rich'] WHEN 1 THEN ['rich', 'poor'] WHEN 2 THEN ['poor'] ELSE NULL::VARCHAR[] END"
_ITEM_SQL = f"""it AS (SELECT l_orderkey AS doc_id, l_linenumber AS occ_id, min(l_partkey) AS p, min(l_suppkey) AS s, {_STATUS_SQL} AS statuses, CASE WHEN l_orderkey % 3 = 0 THEN 'ocr-forced' ELSE 'natural' END AS run_leg FROM lineitem GROUP BY ALL),
oc AS (SELECT *, p % 2 AS page, CASE s % 3 WHEN 0 THEN 'dob' WHEN 1 THEN 'phone' ELSE 'account' END AS category, ['must_fire', 'must_not_fire', 'should_fire', 'must_fire'][(p % 4 + 1)] AS expectation, 'No ' || s || '-' || (p % 10) AS value, CASE WHEN p % 7 = 0 THEN ['ocr'] ELSE ['text', 'ocr'] END AS legs, CASE WHEN p % 5 = 0 THEN 'label' END AS context_class,
  (p % 40)::DOUBLE AS gx, (s % 30)::DOUBLE AS gy, (10 + p % 5)::DOUBLE AS gw, (6 + s % 3)::DOUBLE AS gh FROM it WHERE occ_id % 2 = 1),
hi AS (SELECT doc_id, occ_id AS hit_id, p % 2 AS page, CASE s % 3 WHEN 0 THEN 'dateOfBirth' WHEN 1 THEN 'phone' ELSE 'account' END AS category, CASE p % 3 WHEN 0 THEN 'NO  ' || s || '-' || (p % 10) ELSE 'no ' || s || '-' || (p % 10) || '..' END AS text, (p % 38)::DOUBLE AS hx, (s % 29)::DOUBLE AS hy, (8 + p % 9)::DOUBLE AS hw, (4 + s % 6)::DOUBLE AS hh FROM it),
lg AS (SELECT *, CASE WHEN run_leg = 'ocr-forced' THEN 'ocr' WHEN coalesce(CASE WHEN page < len(statuses) THEN statuses[page + 1] END, 'rich') = 'rich' THEN 'text' ELSE 'ocr' END AS m FROM oc), ap AS (SELECT *, CASE WHEN list_contains(legs, m) THEN m END AS leg FROM lg)"""

#: Cover of boxes (table bx: doc_id, page, id and box) by hits: the best one, and unions by merged intervals in slabs.
_COVER_SQL = """pr AS (SELECT *, greatest(gx, hx) AS x0, greatest(gy, hy) AS y0, least(gx + gw, hx + hw) AS x1, least(gy + gh, hy + hh) AS y1 FROM bx JOIN hi USING (doc_id, page)),
pq AS (SELECT *, (x1 - x0) * (y1 - y0) / (gw * gh) AS cover, (x1 - x0) * (y1 - y0) / (gw * gh + hw * hh - (x1 - x0) * (y1 - y0)) AS iou FROM pr WHERE x1 > x0 AND y1 > y0),
xs AS (SELECT id, category, x, lead(x) OVER (PARTITION BY id, category ORDER BY x) AS nx FROM (SELECT id, category, x0 AS x FROM pq UNION SELECT id, category, x1 FROM pq)),
ac AS (SELECT xs.id, xs.category, x, nx, y0, y1, max(y1) OVER (PARTITION BY xs.id, xs.category, x ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM xs JOIN pq ON pq.id = xs.id AND pq.category = xs.category AND x0 <= x AND x1 >= nx WHERE nx IS NOT NULL),
ua AS (SELECT id, category, sum((nx - x) * greatest(0, y1 - greatest(y0, coalesce(top, y0)))) AS area FROM ac GROUP BY 1, 2),
ct AS (SELECT id, category, count(*) AS n, min(hit_id) AS first_hit, any_value(gw * gh) AS whole, arg_max(text, cover * 1000000 - hit_id) AS text FROM pq GROUP BY 1, 2),
un AS (SELECT id, category, n, first_hit, text, least(area / whole, 1.0) AS u FROM ct JOIN ua USING (id, category) WHERE n >= 2 QUALIFY row_number() OVER (PARTITION BY id ORDER BY least(area / whole, 1.0) DESC, first_hit) = 1),
sg AS (SELECT id, category, text, cover, max(iou) OVER (PARTITION BY id) AS iou FROM pq QUALIFY row_number() OVER (PARTITION BY id ORDER BY cover DESC, hit_id) = 1),
cr AS (SELECT bx.id, coalesce(CASE WHEN u > cover THEN u ELSE cover END, 0) AS cover, CASE WHEN u > cover THEN un.category ELSE sg.category END AS cat, CASE WHEN u > cover THEN un.text ELSE sg.text END AS txt, CASE WHEN u > cover THEN n WHEN cover IS NULL THEN 0 ELSE 1 END AS n_hits, coalesce(iou, 0) AS iou FROM bx LEFT JOIN sg USING (id) LEFT JOIN un USING (id))"""
#: Boxes as a whole have part -1; every occurrence with an even supplier is drawn as two spans.
_VERDICT_SQL = f"""{_ITEM_SQL}, bx AS (SELECT {{'d': doc_id, 'o': occ_id, 'k': -1}} AS id, doc_id, page, gx, gy, gw, gh FROM ap UNION ALL SELECT {{'d': doc_id, 'o': occ_id, 'k': 0}}, doc_id, page, gx, gy, 4, gh FROM ap WHERE s % 2 = 0 UNION ALL SELECT {{'d': doc_id, 'o': occ_id, 'k': 1}}, doc_id, page, gx + 5, gy, 3, gh FROM ap WHERE s % 2 = 0), {_COVER_SQL},
mg AS (SELECT id.d AS doc_id, id.o AS occ_id, bool_and(cover >= 0.5) AS all_covered, bool_and(iou >= 0.5) AS all_iou, arg_min(cat, CASE WHEN cover >= 0.5 AND cat IS NOT NULL THEN id.k END) AS cat2, arg_min(txt, CASE WHEN cover >= 0.5 AND txt IS NOT NULL THEN id.k END) AS txt2 FROM cr WHERE id.k >= 0 GROUP BY 1, 2),
vb AS (SELECT ap.*, CASE WHEN all_covered THEN greatest(cover, 1) ELSE cover END AS c, CASE WHEN all_iou THEN greatest(iou, 0.5) ELSE iou END AS i, coalesce(cat, CASE WHEN all_covered THEN cat2 END) AS cover_category, coalesce(txt, CASE WHEN all_covered THEN txt2 END) AS cover_text, n_hits AS cover_detections, CASE category WHEN 'dob' THEN 'dateOfBirth' ELSE category END AS want FROM ap JOIN cr ON cr.id.d = ap.doc_id AND cr.id.o = ap.occ_id AND cr.id.k = -1 LEFT JOIN mg ON mg.doc_id = ap.doc_id AND mg.occ_id = ap.occ_id),
vd AS (SELECT *, c >= 0.5 AS covered, i >= 0.5 AS iou_matched, i >= 0.7 AS iou_tight, round(least(c, 1), 6) AS cover_fraction, c >= 0.5 AND coalesce(cover_category = want, false) AS strict FROM vb)"""
_KIND_SQL = "CASE WHEN run_leg = 'ocr-forced' THEN 'ocr-forced' WHEN len(statuses) > 0 AND len(list_filter(statuses, lambda x: x = 'rich')) = len(statuses) THEN 'text' WHEN coalesce(len(list_filter(statuses, lambda x: x = 'rich')), 0) = 0 THEN 'ocr' ELSE 'mixed' END"


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of made occurrences (the odd lines of orders) against made hits (all lines)."""
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("occ_id")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    p, s, doc = F.col("p"), F.col("s"), F.col("doc_id")
    d = lambda c: c.cast("double")
    words = lambda *xs: F.array(*map(F.lit, xs))
    number = F.concat_ws("-", s.cast("string"), (p % 10).cast("string"))
    statuses = F.when(doc % 4 == 0, words("rich", "rich")).when(doc % 4 == 1, words("rich", "poor")).when(doc % 4 == 2, words("poor"))
    box = lambda x, y, w, h: F.struct(d(x).alias("x"), d(y).alias("y"), d(w).alias("w"), d(h).alias("h"))
    spans = F.when(s % 2 == 0, F.array(box(p % 40, s % 30, F.lit(4), 6 + s % 3), box(p % 40 + 5, s % 30, F.lit(3), 6 + s % 3)))
    occurrences = items.where("occ_id % 2 = 1").select(
        "doc_id", "occ_id", "p", (p % 2).cast("int").alias("page"), statuses.alias("statuses"), F.when(doc % 3 == 0, "ocr-forced").otherwise("natural").alias("run_leg"),
        _pick(("dob", "phone", "account"), s % 3).alias("category"), _pick(("must_fire", "must_not_fire", "should_fire", "must_fire"), p % 4).alias("expectation"), F.concat(F.lit("No "), number).alias("value"),
        F.when(p % 7 == 0, words("ocr")).otherwise(words("text", "ocr")).alias("legs"), F.when(p % 5 == 0, "label").alias("context_class"), box(p % 40, s % 30, 10 + p % 5, 6 + s % 3).alias("box"), spans.alias("spans"),
    )
    text = F.when(p % 3 == 0, F.concat(F.lit("NO  "), number)).otherwise(F.concat(F.lit("no "), number, F.lit("..")))
    hits = items.select("doc_id", F.col("occ_id").alias("hit_id"), (p % 2).cast("int").alias("page"), _pick(("dateOfBirth", "phone", "account"), s % 3).alias("category"), text.alias("text"), d(p % 38).alias("hx"), d(s % 29).alias("hy"), d(8 + p % 9).alias("hw"), d(4 + s % 6).alias("hh"))
    judged = D.verdicts(occurrences, hits, ["doc_id", "page"], 64.0)
    return judged.withColumns({"leg": D.measured_leg(F.col("run_leg"), F.col("statuses"), F.col("page"), F.col("legs")), "kind": D.leg_kind(F.col("run_leg"), F.col("statuses"))})


@query(f"WITH {_VERDICT_SQL} SELECT doc_id, occ_id, leg, {_KIND_SQL} AS kind, covered, strict, iou_matched, iou_tight, cover_category, cover_text, cover_fraction, cover_detections FROM vd")
def occurrence_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each labelled box got: by one hit, by a union, or by its spans."""
    return _judged(spark, sf_dir).select("doc_id", "occ_id", "leg", "kind", "covered", "strict", "iou_matched", "iou_tight", "cover_category", "cover_text", "cover_fraction", "cover_detections")


@query(f"WITH {_VERDICT_SQL} SELECT leg, want || '->' || cover_category AS confusion, count(*) AS n FROM vd WHERE leg IS NOT NULL AND covered AND NOT strict AND cover_category IS NOT NULL GROUP BY 1, 2")
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was found in place of what was expected, by leg."""
    return D.confusion(_judged(spark, sf_dir).where("leg IS NOT NULL"), ["leg"])


_SAID = "lower(regexp_replace(trim(cover_text), '\\s+', ' ', 'g'))"
_COUNT_SQL = """must AS (SELECT *, expectation = 'must_fire' AND strict AND cover_text IS NOT NULL AS worded, {said} AS said, lower(value) AS wanted FROM vd WHERE leg IS NOT NULL),
tc AS (SELECT leg, want AS category, count(*) FILTER (WHERE expectation = 'must_fire') AS mf_total, count(*) FILTER (WHERE expectation = 'must_fire' AND covered) AS mf_region, count(*) FILTER (WHERE expectation = 'must_fire' AND strict) AS mf_strict, count(*) FILTER (WHERE expectation = 'must_not_fire') AS mnf_total, count(*) FILTER (WHERE expectation = 'must_not_fire' AND covered) AS mnf_fire_region, count(*) FILTER (WHERE expectation = 'must_not_fire' AND strict) AS mnf_fire_strict,
 count(*) FILTER (WHERE expectation = 'should_fire') AS sf_total, count(*) FILTER (WHERE expectation = 'should_fire' AND covered) AS sf_region, count(*) FILTER (WHERE expectation = 'must_fire') AS iou_denom, count(*) FILTER (WHERE expectation = 'must_fire' AND iou_matched) AS iou_head, count(*) FILTER (WHERE expectation = 'must_fire' AND iou_tight) AS iou_tight,
 count(*) FILTER (WHERE worded) AS text_denom, count(*) FILTER (WHERE worded AND said = wanted) AS text_strict, count(*) FILTER (WHERE worded AND (said = wanted OR contains(said, wanted) AND strpos(said, wanted) <= 3 AND length(said) - length(wanted) - strpos(said, wanted) + 1 <= 2 OR contains(wanted, said) AND strpos(wanted, said) <= 3 AND length(wanted) - length(said) - strpos(wanted, said) + 1 <= 2)) AS text_relaxed FROM must GROUP BY 1, 2)""".replace("{said}", _SAID)


def _view_sql() -> str:
    out, base = {}, {}
    for kind in ("region", "strict"):
        k, n = f"mf_{kind}", "mf_total"
        base |= {f"{kind}_r": _ratio_sql(k, n), f"{kind}_p": _ratio_sql(k, f"({k} + mnf_fire_{kind})", "1")}
        p, r = f"{kind}_p", f"{kind}_r"
        out |= {f"{kind}_recall": r, f"{kind}_precision": p, f"{kind}_f1": _fbeta_sql(p, r, "1.0::DOUBLE"), f"{kind}_f2": _fbeta_sql(p, r, "4.0::DOUBLE")}
        out[f"{kind}_low"], out[f"{kind}_high"] = _WILSON_SQL(k, n)
    out |= {"iou_rate": _ratio_sql("iou_head", "iou_denom"), "iou_tight_rate": _ratio_sql("iou_tight", "iou_denom")}
    out |= {f"text_{k}_rate": f"CASE WHEN text_denom > 0 THEN text_{k}::DOUBLE / text_denom END" for k in ("strict", "relaxed")}
    named, rounded = (", ".join(f"{f(v)} AS {k}" for k, v in x.items()) for x, f in ((base, str), (out, "round({}, 6)".format)))
    return f"tb AS (SELECT *, {named} FROM tc), tv AS (SELECT * EXCLUDE ({', '.join(base)}), {rounded}, mf_total < 30 AS low_support FROM tb)"


@query(f"WITH {_VERDICT_SQL}, {_COUNT_SQL}, {_view_sql()} SELECT * FROM tv")
def document_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and metrics of each leg and category."""
    judged = _judged(spark, sf_dir).where("leg IS NOT NULL").withColumn("category", D.canonical(F.col("category")))
    return D.metric_view(D.tier_counts(judged, ["leg", "category"]))


@query(f"""WITH {_VERDICT_SQL}, ms AS (SELECT *, regexp_extract_all(value, '[0-9]+') AS d FROM vd WHERE expectation = 'must_fire' AND leg IS NOT NULL), st AS (SELECT 'digit_ambiguity' AS kind, CASE WHEN len(d) = 0 THEN 'no_digits' WHEN len(list_filter(d, lambda x: regexp_full_match(x, '[0158]+'))) = len(d) THEN 'all' WHEN len(list_filter(d, lambda x: regexp_full_match(x, '[0158]+'))) > 0 THEN 'some' ELSE 'none' END AS stratum, covered, strict FROM ms UNION ALL SELECT 'context_class', coalesce(context_class, 'none'), covered, strict FROM ms),
sc AS (SELECT kind, stratum, count(*) AS support, count(*) FILTER (WHERE covered) AS region, count(*) FILTER (WHERE strict) AS k FROM st GROUP BY 1, 2), sf AS (SELECT coalesce(sc.kind, 'digit_ambiguity') AS kind, coalesce(sc.stratum, d.stratum) AS stratum, coalesce(support, 0) AS support, coalesce(region, 0) AS region, coalesce(k, 0) AS k FROM sc FULL JOIN (VALUES ('none'), ('some'), ('all'), ('no_digits')) d(stratum) ON sc.kind = 'digit_ambiguity' AND sc.stratum = d.stratum)
SELECT kind, stratum, support, round({_ratio_sql('region', 'support')}, 6) AS region_recall, round({_ratio_sql('k', 'support')}, 6) AS strict_recall, round({_WILSON_SQL('k', 'support')[0]}, 6) AS low, round({_WILSON_SQL('k', 'support')[1]}, 6) AS high FROM sf""")
def document_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall by digits that look like letters and by context class."""
    return D.strata(_judged(spark, sf_dir).where("leg IS NOT NULL"))


_LINES_SQL = "ln AS (SELECT DISTINCT l_orderkey AS doc_id, l_partkey % 2 AS page, 'caption of line No ' || l_suppkey || ' ' || (l_partkey % 10) AS raw, CASE WHEN l_partkey % 2 = 0 THEN 'caption of line' ELSE 'caption of line No ' || l_suppkey || ' ' || (l_partkey % 10) END AS normalized FROM lineitem WHERE l_orderkey % 5 <> 0)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    raw = F.concat(F.lit("caption of line No "), s.cast("string"), F.lit(" "), (p % 10).cast("string"))
    rows = table(spark, sf_dir, "lineitem").where("l_orderkey % 5 != 0")
    return rows.select(F.col("l_orderkey").alias("doc_id"), F.lit("ocr").alias("leg"), (p % 2).cast("int").alias("page"), raw.alias("raw"), F.when(p % 2 == 0, "caption of line").otherwise(raw).alias("normalized")).distinct()


@query(f"""WITH {_VERDICT_SQL}, {_LINES_SQL}, tw AS (SELECT doc_id, occ_id AS occ, bool_or(strict) AS strict FROM vd WHERE leg = 'text' GROUP BY 1, 2), fi AS (SELECT occ, min(doc_id) AS doc, arg_min(strict, doc_id) AS strict FROM tw GROUP BY 1),
mi AS (SELECT doc_id, occ_id, page, value, occ_id AS occ, s, p FROM vd WHERE leg = 'ocr' AND expectation = 'must_fire' AND NOT strict), lo AS (SELECT DISTINCT mi.doc_id, mi.occ_id FROM mi JOIN ln USING (doc_id, page) WHERE regexp_matches(raw, s || '[^0-9]{{0,3}}' || (p % 10)) AND NOT regexp_matches(normalized, s || '[^0-9]{{0,3}}' || (p % 10)))
SELECT mi.doc_id, mi.occ_id, coalesce(tw.doc_id, fi.doc) AS twin, CASE WHEN coalesce(tw.strict, fi.strict) IS NULL THEN 'unattributed' WHEN NOT coalesce(tw.strict, fi.strict) THEN 'detector_induced' WHEN lo.doc_id IS NOT NULL THEN 'normalizer_destroyed' ELSE 'ocr_induced' END AS cause FROM mi LEFT JOIN tw ON tw.doc_id = mi.doc_id AND tw.occ = mi.occ LEFT JOIN fi ON fi.occ = mi.occ LEFT JOIN lo ON lo.doc_id = mi.doc_id AND lo.occ_id = mi.occ_id""")
def twin_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cause of each miss of recognition, by the clean twin of its occurrence."""
    judged = _judged(spark, sf_dir)
    twins = judged.where("leg = 'text'").select("doc_id", "occ_id", "strict")
    misses = judged.where("leg = 'ocr' AND expectation = 'must_fire' AND NOT strict").select("doc_id", "leg", "occ_id", "page", "value")
    return D.attributed(misses, twins, _lines(spark, sf_dir)).select("doc_id", "occ_id", "twin", "cause")


@query(f"""WITH {_VERDICT_SQL}, {_LINES_SQL}, cp AS (SELECT doc_id, occ_id, page, s, p, CASE WHEN p % 3 = 0 THEN 'Caption  of line' WHEN p % 3 = 1 THEN 'caption of line that goes on' ELSE 'other' END AS caption, (p % 20 - 3)::DOUBLE AS clearance FROM vd WHERE leg = 'ocr'),
me AS (SELECT doc_id, occ_id, bool_or(p % 3 <> 2) AS merged FROM cp JOIN ln USING (doc_id, page) WHERE regexp_matches(raw, s || '[^0-9]{{0,3}}' || (p % 10)) GROUP BY 1, 2),
bk AS (SELECT CASE WHEN clearance < 0 THEN 'overprint' WHEN clearance < 3 THEN 'under_3pt' WHEN clearance < 12 THEN '3_to_12pt' ELSE 'over_12pt' END AS bucket, merged FROM cp LEFT JOIN me USING (doc_id, occ_id)), ag AS (SELECT bucket, count(*) AS rows, count(merged) AS decided, count(*) FILTER (WHERE merged) AS n_merged FROM bk GROUP BY 1)
SELECT bucket, coalesce(rows, 0) AS rows, coalesce(decided, 0) AS decided, coalesce(n_merged, 0) AS n_merged, CASE WHEN decided > 0 THEN round(n_merged::DOUBLE / decided, 6) END AS rate FROM (VALUES ('overprint'), ('under_3pt'), ('3_to_12pt'), ('over_12pt')) d(bucket) LEFT JOIN ag USING (bucket)""")
def caption_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a value's line holds its caption, by clearance."""
    p = F.col("p")
    caption = F.when(p % 3 == 0, "Caption  of line").when(p % 3 == 1, "caption of line that goes on").otherwise("other")
    rows = _judged(spark, sf_dir).where("leg = 'ocr'").select("doc_id", "leg", "occ_id", "page", "value", caption.alias("caption"), (p % 20 - 3).cast("double").alias("clearance"), F.lit(False).alias("multiline"))
    # Values read "No 12-3"; their lines are found by the digits, as values with digits are.
    return D.merge_rates(D.caption_merges(rows, _lines(spark, sf_dir)), ["leg"]).drop("leg")


_DOC_SIDE = lambda name, odd: f"{name} AS (SELECT source AS document, leg, support, round(hits::DOUBLE / support, 6) AS recall, fired, CASE WHEN hits + fired > 0 THEN hits::DOUBLE / (hits + fired) ELSE 1 END AS precision FROM (SELECT p_brand AS source, CASE WHEN p_size % 2 = 0 THEN 'text' ELSE 'ocr' END AS leg, count(*) AS support, count(*) FILTER (WHERE p_partkey % {5 + odd} <> 0) AS hits, count(*) FILTER (WHERE p_partkey % 11 = {odd}) AS fired FROM part WHERE p_size % 7 <> {odd + 1} OR p_brand <> 'Brand#11' GROUP BY 1, 2))"


@query(f"""WITH {_DOC_SIDE('b', 0)}, {_DOC_SIDE('a', 1)}, bo AS (SELECT b.document, b.leg, b.support AS bs, a.support AS as_, round_even(b.recall * b.support, 0) AS bh, round_even(a.recall * a.support, 0) AS ah, b.fired AS bfi, a.fired AS afi FROM b JOIN a USING (document, leg)),
po AS (SELECT coalesce(leg, '*') AS leg, sum(bs) AS bs, sum(as_) AS as_, sum(bh) AS bh, sum(ah) AS ah, sum(bfi) AS bfi, sum(afi) AS afi, count(*) AS pooled FROM bo GROUP BY GROUPING SETS ((leg), ())),
pz AS (SELECT leg, pooled, CASE WHEN bh + bfi = 0 THEN 1 ELSE bh::DOUBLE / (bh + bfi) END AS bp, CASE WHEN ah + afi = 0 THEN 1 ELSE ah::DOUBLE / (ah + afi) END AS ap, bh::DOUBLE / bs AS br, ah::DOUBLE / as_ AS ar FROM po),
ps AS (SELECT 'aggregate' AS name, bp, ap, bp AS bpd, ap AS apd, br, ar FROM pz WHERE leg = '*'), {_CLAUSE_SQL}, sl AS (SELECT bool_or(ap - bp < -0.03::DOUBLE) AS bad FROM pz WHERE leg <> '*')
SELECT name, (SELECT pooled FROM pz WHERE leg = '*') AS rows_pooled, (SELECT count(*) FROM b FULL JOIN a USING (document, leg) WHERE b.support IS NULL OR a.support IS NULL) AS rows_skipped, regression OR bad AS regression, win AND NOT bad AS win, CASE WHEN bad THEN concat_ws(',', nullif(failed, ''), 'C4') ELSE failed END AS failed FROM vs, sl""")
def documents_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pooled verdict over (document, leg) rows of two runs, its legs as slices."""
    def side(odd: int) -> DataFrame:
        rows = table(spark, sf_dir, "part").where(f"p_size % 7 != {odd + 1} OR p_brand != 'Brand#11'")
        k = F.col("p_partkey")
        g = rows.groupBy(F.col("p_brand").alias("document"), F.when(F.col("p_size") % 2 == 0, "text").otherwise("ocr").alias("leg")).agg(F.count("*").alias("support"), F.count_if(k % (5 + odd) != 0).alias("hits"), F.count_if(k % 11 == odd).alias("fired"))
        return g.select("document", "leg", "support", F.round(ratio(F.col("hits"), F.col("support")), 6).alias("recall"), "fired")

    before, after = side(0), side(1)
    shared = before.join(after, ["document", "leg"], "left_semi"), after.join(before, ["document", "leg"], "left_semi")
    skipped = before.join(after, ["document", "leg"], "left_anti").unionByName(after.join(before, ["document", "leg"], "left_anti")).agg(F.count("*").alias("rows_skipped"))
    total = [E.pooled(x.withColumn("family", F.lit("aggregate")), ["family"]) for x in shared]
    slices = E.slice_verdicts(*(E.pooled(x, ["leg"]) for x in shared), ["leg"])
    verdict = E.with_slices(E.family_verdicts(*total, ("aggregate",)), slices)
    counted = shared[0].agg(F.count("*").alias("rows_pooled"), F.lit("aggregate").alias("family"))
    named = verdict.join(counted, "family").join(skipped.withColumn("family", F.lit("aggregate")), "family")
    return named.select(F.col("family").alias("name"), "rows_pooled", "rows_skipped", "regression", "win", "failed")
