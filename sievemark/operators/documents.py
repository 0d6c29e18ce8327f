"""Evaluation of whole documents: labelled boxes against detections, leg by leg.

A run measures one leg of each page (the text layer or recognition). Occurrences are
joined to the hits of their page, credited by the best single hit, by the union of a
category's hits, or by their lines one by one, and tallied by what was expected of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import union_area
from ..functions.metrics import fbeta, ratio, wilson
from ..functions.text import digit_stratum, end_slack_match, norm_text
from .spans import box_pairs, clipped_box

#: The aliases of categories, the bounds of cover and IoU, leg kinds in
#: reporting order, strata of digits, clearance buckets by their upper end in points.
ALIASES = {"dob": "dateOfBirth"}
COVERED, IOU_HEAD, IOU_TIGHT, LOW_SUPPORT = 0.5, 0.5, 0.7, 30
LEGS = ("text", "ocr", "ocr-forced", "mixed")
DIGIT_STRATA = ("none", "some", "all", "no_digits")
CLEARANCE = (("overprint", 0.0), ("under_3pt", 3.0), ("3_to_12pt", 12.0), ("over_12pt", None))
TIER_COUNTERS = ("mf_total", "mf_region", "mf_strict", "mnf_total", "mnf_fire_region", "mnf_fire_strict", "sf_total", "sf_region", "iou_denom", "iou_head", "iou_tight", "text_denom", "text_strict", "text_relaxed")


def canonical(category: Column, aliases: dict[str, str] | None = None) -> Column:
    """A category under its one name."""
    out = category
    for alias, name in (aliases or ALIASES).items():
        out = F.when(category == alias, name).otherwise(out)
    return out


def measured_leg(run_leg: Column, statuses: Column, page: Column, applicable: Column) -> Column:
    """The leg that a run measures on a page: recognition if it is forced, else the text
    layer where its status is rich (or not given); null where the occurrence does not
    apply to that leg, or has no page."""
    status = F.coalesce(F.when((page >= 0) & (page < F.size(statuses)), F.get(statuses, page)), F.lit("rich"))
    leg = F.when(run_leg == "ocr-forced", "ocr").when(status == "rich", "text").otherwise("ocr")
    return F.when(page.isNotNull() & F.array_contains(applicable, leg), leg)


def leg_kind(run_leg: Column, statuses: Column) -> Column:
    """ocr-forced, text (all pages rich), ocr (none), or mixed."""
    rich = F.filter(statuses, lambda s: s == "rich")
    pages = F.coalesce(F.size(statuses), F.lit(0))
    return F.when(run_leg == "ocr-forced", "ocr-forced").when((pages > 0) & (F.size(rich) == pages), "text").when(F.coalesce(F.size(rich), F.lit(0)) == 0, "ocr").otherwise("mixed")


def leg_rank(leg: Column) -> Column:
    """Place of a leg kind in reports; unknown ones last."""
    return F.when(leg.isin(*LEGS), F.array_position(F.array(*map(F.lit, LEGS)), leg) - 1).otherwise(len(LEGS)).cast("int")


def cover_credits(boxes: DataFrame, hits: DataFrame, key: list[str], cell: float, rule: str = "union") -> DataFrame:
    """(key, occ_id, cover, category, text, n_hits, iou) of each box (key, occ_id, gx, gy,
    gw, gh) against hits (key, hit_id, category, text, hx, hy, hw, hh).

    ``single`` credits the best hit, equal ones the earlier. ``union`` lets the union of
    two or more hits of a category replace it if strictly larger; of equal unions the
    category whose hit comes first. The text is the best single hit's of the credited
    category. ``iou`` is the greatest of any hit.
    """
    if rule not in ("single", "union"):
        raise ValueError(f"unknown join rule {rule}")
    own = [*key, "occ_id"]
    pairs = box_pairs(boxes, hits.withColumn("category", canonical(F.col("category"))), key, cell)
    best = F.max_by(F.struct("cover", "category", "text", "hit_id"), F.struct(F.col("cover"), -F.col("hit_id"))).alias("best")
    grouped = [best, F.max("iou").alias("iou"), F.count("*").alias("n"), F.min("hit_id").alias("first_hit")]
    if rule == "union":
        pairs = pairs.withColumns({"box": clipped_box(), "area": F.col("gw") * F.col("gh")})
        grouped += [F.collect_list("box").alias("boxes"), F.first("area").alias("area")]
    each = pairs.groupBy(*own, "category").agg(*grouped)
    if rule == "union":
        each = each.withColumn("together", F.when(F.col("n") >= 2, F.least(union_area(F.col("boxes")) / F.col("area"), F.lit(1.0))))
    else:
        each = each.withColumn("together", F.lit(None).cast("double"))
    order = F.struct(F.col("best.cover"), -F.col("best.hit_id"))
    both = each.groupBy(*own).agg(
        F.max_by("best", order).alias("single"),
        F.max("iou").alias("iou"),
        F.max_by(F.struct("together", "category", F.col("best.text").alias("text"), "n"), F.when(F.col("together").isNotNull(), F.struct(F.col("together"), -F.col("first_hit")))).alias("u"),
    )
    take = F.coalesce(F.col("u.together") > F.col("single.cover"), F.lit(False))
    pick = lambda a, b: F.when(take, F.col(a)).otherwise(F.col(b))
    found = both.select(*own, pick("u.together", "single.cover").alias("cover"), pick("u.category", "single.category").alias("category"), pick("u.text", "single.text").alias("text"), F.when(take, F.col("u.n")).otherwise(1).alias("n_hits"), "iou")
    left = boxes.select(*own).join(found, own, "left")
    return left.select(*own, F.coalesce("cover", F.lit(0.0)).alias("cover"), "category", "text", F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"), F.coalesce("iou", F.lit(0.0)).alias("iou"))


def verdicts(occurrences: DataFrame, hits: DataFrame, key: list[str], cell: float, rule: str = "union") -> DataFrame:
    """``occurrences`` with covered, strict, iou_matched, iou_tight, cover_category,
    cover_text, cover_fraction, cover_detections.

    occurrences: key, occ_id, category, box struct<x,y,w,h> (or null), spans array of
    boxes (or null). One of several spans counts as covered or matched as a whole if each
    of its spans does; its category and text are then those of the whole, or else of the
    first span that has any.
    """
    own = [*key, "occ_id"]
    flat = lambda df, b: df.select(*own, *(F.col(f"{b}.{c}").alias(f"g{c}") for c in "xywh"))
    boxed = occurrences.where("box IS NOT NULL")
    whole = cover_credits(flat(boxed, "box"), hits, key, cell, rule)
    parts = boxed.where(F.size("spans") > 1).select(*own, F.posexplode("spans").alias("part", "span"))
    one = parts.select(*own, "part", F.struct(F.col("occ_id"), F.col("part")).alias("_id"), "span")
    each = cover_credits(one.where("span IS NOT NULL").select(*key, F.col("_id").alias("occ_id"), *(F.col(f"span.{c}").alias(f"g{c}") for c in "xywh")), hits, key, cell, rule)
    each = one.join(each.withColumnRenamed("occ_id", "_id").withColumnRenamed("category", "cat").withColumnRenamed("text", "txt"), [*key, "_id"], "left")
    covered = F.coalesce(F.col("cover") >= COVERED, F.lit(False))
    ordered = lambda c: F.min_by(c, F.when(covered & F.col(c).isNotNull(), F.col("part")))
    merged = each.groupBy(*own).agg(F.bool_and(covered).alias("all_covered"), F.bool_and(F.coalesce(F.col("iou") >= IOU_HEAD, F.lit(False))).alias("all_iou"), ordered("cat").alias("cat"), ordered("txt").alias("txt"))
    joined = whole.join(merged, own, "left")
    every, ious = F.coalesce("all_covered", F.lit(False)), F.coalesce("all_iou", F.lit(False))
    cover = F.when(every, F.greatest("cover", F.lit(1.0))).otherwise(F.col("cover"))
    iou = F.when(ious, F.greatest("iou", F.lit(IOU_HEAD))).otherwise(F.col("iou"))
    named = lambda a, b: F.coalesce(F.col(a), F.when(every, F.col(b)))
    got = joined.select(*own, cover.alias("_cover"), iou.alias("_iou"), named("category", "cat").alias("cover_category"), named("text", "txt").alias("cover_text"), F.col("n_hits").alias("_n"))
    out = occurrences.join(got, own, "left")
    c, i = F.coalesce("_cover", F.lit(0.0)), F.coalesce("_iou", F.lit(0.0))
    out = out.withColumns({"covered": c >= COVERED, "iou_matched": i >= IOU_HEAD, "iou_tight": i >= IOU_TIGHT, "cover_fraction": F.round(F.least(c, F.lit(1.0)), 6), "cover_detections": F.coalesce("_n", F.lit(0)).cast("long")})
    strict = F.col("covered") & F.coalesce(F.col("cover_category") == canonical(F.col("category")), F.lit(False))
    return out.withColumn("strict", strict).drop("_cover", "_iou", "_n")


def confusion(judged: DataFrame, group: list[str]) -> DataFrame:
    """(group, confusion, n): what was expected and what was found in its place."""
    wrong = judged.where(F.col("covered") & ~F.col("strict") & F.col("cover_category").isNotNull())
    return wrong.groupBy(*group, F.concat_ws("->", canonical(F.col("category")), "cover_category").alias("confusion")).agg(F.count("*").alias("n"))


def tier_counts(judged: DataFrame, group: list[str]) -> DataFrame:
    """The counters of each group, by what was expected of an occurrence. judged: expectation,
    value, and the columns of ``verdicts``."""
    e = F.col("expectation")
    must, must_not, should = e == "must_fire", e == "must_not_fire", e == "should_fire"
    covered, strict = F.col("covered"), F.col("strict")
    worded = must & strict & F.col("cover_text").isNotNull()
    said, want = norm_text(F.col("cover_text")), norm_text(F.coalesce("value", F.lit("")))
    rows = judged.withColumns({"_said": F.when(worded, said), "_want": F.when(worded, want)})
    flags = {
        "mf_total": must, "mf_region": must & covered, "mf_strict": must & strict,
        "mnf_total": must_not, "mnf_fire_region": must_not & covered, "mnf_fire_strict": must_not & strict,
        "sf_total": should, "sf_region": should & covered,
        "iou_denom": must, "iou_head": must & F.col("iou_matched"), "iou_tight": must & F.col("iou_tight"),
        "text_denom": worded, "text_strict": worded & (F.col("_said") == F.col("_want")), "text_relaxed": worded & end_slack_match(F.col("_said"), F.col("_want")),
    }
    return rows.groupBy(*group).agg(*(F.count_if(flags[c]).alias(c) for c in TIER_COUNTERS))


def metric_view(counts: DataFrame, digits: int = 6) -> DataFrame:
    """Metrics of the counters: recall and precision by region and strict (precision is 1
    if nothing fired), IoU rates, and the rates of equal texts, null without any."""
    c = {n: F.col(n) for n in TIER_COUNTERS}
    out = {}
    for kind in ("region", "strict"):
        r, p = ratio(c[f"mf_{kind}"], c["mf_total"]), ratio(c[f"mf_{kind}"], c[f"mf_{kind}"] + c[f"mnf_fire_{kind}"], 1.0)
        out |= {f"{kind}_recall": r, f"{kind}_precision": p, f"{kind}_f1": fbeta(p, r), f"{kind}_f2": fbeta(p, r, 2.0)}
        out[f"{kind}_low"], out[f"{kind}_high"] = wilson(c[f"mf_{kind}"], c["mf_total"])
    out |= {"iou_rate": ratio(c["iou_head"], c["iou_denom"]), "iou_tight_rate": ratio(c["iou_tight"], c["iou_denom"])}
    out |= {f"text_{k}_rate": F.when(c["text_denom"] > 0, ratio(c[f"text_{k}"], c["text_denom"])) for k in ("strict", "relaxed")}
    return counts.withColumns({k: F.round(v, digits) for k, v in out.items()} | {"low_support": c["mf_total"] < LOW_SUPPORT})


def strata(judged: DataFrame, digits: int = 6) -> DataFrame:
    """(kind, stratum, support, region_recall, strict_recall, low, high) of the occurrences
    that must fire, by digits that look like letters and by context class. All strata of
    digits are present."""
    must = judged.where("expectation = 'must_fire'")
    keys = F.array(F.struct(F.lit("digit_ambiguity").alias("kind"), digit_stratum(F.coalesce("value", F.lit(""))).alias("stratum")), F.struct(F.lit("context_class").alias("kind"), F.coalesce("context_class", F.lit("none")).alias("stratum")))
    each = must.select("covered", "strict", F.explode(keys).alias("k")).select("k.*", "covered", "strict")
    counts = each.groupBy("kind", "stratum").agg(F.count("*").alias("support"), F.count_if("covered").alias("region"), F.count_if("strict").alias("k"))
    dim = judged.sparkSession.createDataFrame([("digit_ambiguity", s) for s in DIGIT_STRATA], "kind string, stratum string")
    filled = counts.join(dim, ["kind", "stratum"], "full_outer").fillna(0, ["support", "region", "k"])
    low, high = wilson(F.col("k"), F.col("support"))
    n = F.col("support")
    return filled.select("kind", "stratum", "support", F.round(ratio(F.col("region"), n), digits).alias("region_recall"), F.round(ratio(F.col("k"), n), digits).alias("strict_recall"), F.round(low, digits).alias("low"), F.round(high, digits).alias("high"))


def digits_pattern(value: Column) -> Column:
    """A pattern of the value's digit groups in order, with up to three other characters
    between; null for a value without digits."""
    groups = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    return F.when(F.size(groups) > 0, F.array_join(groups, "[^0-9]{0,3}"))


def attributed(misses: DataFrame, twins: DataFrame, lines: DataFrame) -> DataFrame:
    """``misses`` (doc_id, leg, occ_id, page, value) with their ``twin`` document and cause.

    The twin is the same occurrence in the document's own text leg, else in that of the
    first other document that has it. What the twin misses too is detector_induced; else,
    if the digits of the value are in some raw line of the page but not in its normalised
    form, normalizer_destroyed; else ocr_induced. Without a twin a miss is unattributed.

    twins: doc_id, occ_id, strict (the verdicts of text legs); lines: doc_id, leg, page,
    raw, normalized.
    """
    own = twins.select("doc_id", "occ_id", F.struct(F.col("doc_id").alias("doc"), "strict").alias("own"))
    first = twins.groupBy("occ_id").agg(F.min_by(F.struct(F.col("doc_id").alias("doc"), "strict"), "doc_id").alias("other"))
    keyed = misses.withColumn("_digits", digits_pattern(F.coalesce("value", F.lit(""))))
    gone = F.rlike("raw", F.col("_digits")) & ~F.rlike("normalized", F.col("_digits"))
    lost = keyed.where("_digits IS NOT NULL").join(lines, ["doc_id", "leg", "page"]).where(gone).select("doc_id", "leg", "occ_id", F.lit(True).alias("lost")).distinct()
    joined = keyed.join(own, ["doc_id", "occ_id"], "left").join(first, "occ_id", "left").join(lost, ["doc_id", "leg", "occ_id"], "left")
    twin = F.coalesce("own", "other")
    cause = F.when(twin.isNull(), "unattributed").when(~twin["strict"], "detector_induced").when(F.coalesce("lost", F.lit(False)), "normalizer_destroyed").otherwise("ocr_induced")
    return joined.select(*misses.columns, twin["doc"].alias("twin"), cause.alias("cause"))


def clearance_bucket(points: Column) -> Column:
    """overprint below 0, then under 3, 3 to 12, and over 12 points."""
    out = None
    for name, end in CLEARANCE[:-1]:
        out = F.when(points < end, name) if out is None else out.when(points < end, name)
    return out.when(points.isNotNull(), CLEARANCE[-1][0])


def caption_merges(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """``rows`` (doc_id, leg, occ_id, page, value, caption, clearance, multiline) with their
    bucket and ``merged``: whether some line that carries the value carries the caption (or
    its first three words), null if no line carries the value. A value of several lines
    that no line carries whole is stood for by its first two words."""
    head = lambda c, n: F.array_join(F.slice(F.split(c, " "), 1, n), " ")
    keyed = rows.withColumns({"_digits": digits_pattern(F.col("value")), "_value": norm_text(F.col("value")), "_caption": norm_text(F.col("caption"))})
    met = keyed.join(lines.select("doc_id", "leg", "page", "raw", norm_text(F.col("raw")).alias("_line")), ["doc_id", "leg", "page"])
    whole = F.when(F.col("_digits").isNotNull(), F.rlike("raw", F.col("_digits"))).otherwise((F.col("_value") != "") & F.contains("_line", "_value"))
    part = F.col("multiline") & (F.col("_value") != "") & F.contains("_line", head(F.col("_value"), 2))
    said = F.contains("_line", "_caption") | F.contains("_line", head(F.col("_caption"), 3))
    own = ("doc_id", "leg", "occ_id")
    found = met.groupBy(*own).agg(F.bool_or(whole).alias("_any"), F.bool_or(F.when(whole, said)).alias("_whole"), F.bool_or(F.when(part, said)).alias("_part"))
    merged = F.when(F.col("_any"), F.col("_whole")).otherwise(F.col("_part"))
    return rows.join(found, list(own), "left").select(*rows.columns, clearance_bucket(F.col("clearance")).alias("bucket"), merged.alias("merged"))


def merge_rates(merges: DataFrame, group: list[str], digits: int = 6) -> DataFrame:
    """(group, bucket, rows, decided, merged, rate) for every bucket of every group."""
    names = F.array(*(F.lit(n) for n, _ in CLEARANCE))
    counts = merges.groupBy(*group, "bucket").agg(F.count("*").alias("rows"), F.count("merged").alias("decided"), F.count_if("merged").alias("n_merged"))
    every = merges.select(*group).distinct().withColumn("bucket", F.explode(names))
    filled = every.join(counts, [*group, "bucket"], "left").fillna(0, ["rows", "decided", "n_merged"])
    return filled.withColumn("rate", F.when(F.col("decided") > 0, F.round(F.col("n_merged") / F.col("decided"), digits)))


def text_twins(judged: DataFrame) -> DataFrame:
    """(doc_id, occ_id, strict) of the occurrences that a text leg measured."""
    return judged.where("leg = 'text'").select("doc_id", "occ_id", "strict")


def report_order(rows: DataFrame) -> DataFrame:
    """Rows (document, leg) in the order of reports, for a sink."""
    return rows.orderBy("document", leg_rank(F.col("leg")), "leg")
