"""Joins of spans and boxes, and the tallies made from them.

Every overlap join has an equality key (document, page, category). Intervals that
may be many in one document also get a bin as a key, so no document's spans meet
in one task only.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import box_iou, cover, intersection, interval_iou, overlap, union_area

_TOKEN = re.compile(r"[^ \t\n\r\x0b\x0c]+")


def overlap_join(left: DataFrame, right: DataFrame, key: str, bin_width: int, how: str = "inner") -> DataFrame:
    """Pairs of ``left`` (key, l_id, l0, l1) and ``right`` (key, r_id, r0, r1) whose
    intervals meet. Both are put into the bins that they touch; a pair counts in
    the bin in which its common part begins."""
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / bin_width), F.floor((F.col(b) - 1) / bin_width)))
    a, b = left.where("l1 > l0").withColumn("_bin", bins("l0", "l1")), right.where("r1 > r0").withColumn("_bin", bins("r0", "r1"))
    first = F.floor(F.greatest("l0", "r0") / bin_width) == F.col("_bin")
    met = a.join(b, [key, "_bin"]).where(overlap(F.col("l0"), F.col("l1"), F.col("r0"), F.col("r1")) & first).drop("_bin")
    if how == "inner":
        return met
    return left.join(met.drop("l0", "l1"), [key, "l_id"], "left")


def iou_matches(candidates: DataFrame, truth: DataFrame, key: str, bin_width: int, least: float = 0.5) -> DataFrame:
    """Each candidate with whether some true span overlaps it by ``least``."""
    met = overlap_join(candidates, truth, key, bin_width)
    iou = interval_iou(F.col("l0"), F.col("l1"), F.col("r0"), F.col("r1"))
    hit = met.where(iou >= least).select(key, "l_id").distinct().withColumn("hit", F.lit(True))
    return candidates.join(hit, [key, "l_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


@lru_cache(1)
def _token_spans():
    """Made on first use: a worker that imports this module has no session."""

    def run(texts: pa.Array) -> pa.Array:
        found, ends = [], [0]
        for text in texts.to_pylist():
            found += _TOKEN.finditer(text or "")
            ends.append(len(found))
        at = [pa.array([f(m) for m in found], kind) for f, kind in ((re.Match.group, pa.string()), (re.Match.start, pa.int32()), (re.Match.end, pa.int32()))]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(at, ["token", "start", "end"]), mask=texts.is_null())

    return F.arrow_udf(run, "array<struct<token:string,start:int,end:int>>")


def token_spans(text: Column) -> Column:
    """White-space tokens of a text with their offsets: array<struct<token,start,end>>.
    One Arrow pass, in time linear in the text: no built-in function gives the places of
    all matches of a pattern, and running sums over an array copy it at every step."""
    return _token_spans()(text)


def covered_tokens(tokens: Column, detections: Column) -> Column:
    """How many tokens some detection (struct with start, end) touches."""
    return F.size(F.filter(tokens, lambda t: F.exists(detections, lambda d: (t["start"] < d["end"]) & (d["start"] < t["end"]))))


def box_pairs(occurrences: DataFrame, hits: DataFrame, key: list[str], cell: float) -> DataFrame:
    """Pairs of occurrences (key, occ_id, gx, gy, gw, gh) and hits (key, hit_id, hx, hy,
    hw, hh) with a common area, with ``cover`` and ``iou``. Both are put into the grid
    cells that they touch; a pair counts in the cell in which its common part begins,
    so that a crowded page is not one group. ``cell``: about the size of a box."""

    def gridded(df: DataFrame, c: str) -> DataFrame:
        at = lambda a, n: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor((F.col(a) + F.col(n)) / cell)))
        return df.where(f"{c}w > 0 AND {c}h > 0").withColumn("_cx", at(f"{c}x", f"{c}w")).withColumn("_cy", at(f"{c}y", f"{c}h"))

    gt, det = tuple(F.col(f"g{c}") for c in "xywh"), tuple(F.col(f"h{c}") for c in "xywh")
    met = gridded(occurrences, "g").join(gridded(hits, "h"), [*key, "_cx", "_cy"])
    begins = (F.floor(F.greatest("gx", "hx") / cell) == F.col("_cx")) & (F.floor(F.greatest("gy", "hy") / cell) == F.col("_cy"))
    return met.where(begins & (intersection(gt, det) > 0)).withColumns({"cover": cover(gt, det), "iou": box_iou(gt, det)}).drop("_cx", "_cy")


def best_cover(occurrences: DataFrame, hits: DataFrame, key: tuple[str, ...] = ("page",), cell: float = 64.0) -> DataFrame:
    """(key, occ_id, cover, category, hit_id, iou) of the hit that covers most of each
    occurrence; equal ones go to the earlier hit, none gives nulls.

    ``occurrences``: key, occ_id, gx, gy, gw, gh; ``hits``: key, hit_id, category, hx,
    hy, hw, hh.
    """
    own = [*key, "occ_id"]
    best = box_pairs(occurrences, hits, list(key), cell).groupBy(*own).agg(F.max_by(F.struct("cover", "category", "hit_id", "iou"), F.struct(F.col("cover"), -F.col("hit_id"))).alias("b"))
    return occurrences.select(*own).join(best, own, "left").select(*own, F.coalesce("b.cover", F.lit(0.0)).alias("cover"), "b.category", "b.hit_id", "b.iou")


def union_cover(occurrences: DataFrame, hits: DataFrame, key: tuple[str, ...] = ("page",), cell: float = 64.0) -> DataFrame:
    """(key, occ_id, category, n_hits, first_hit, cover): the share of each occurrence
    under the union of a category's hits. Of each occurrence and category only the hits
    that touch it are gathered."""
    clipped = box_pairs(occurrences, hits, list(key), cell).select(*key, "occ_id", "category", "hit_id", (F.col("gw") * F.col("gh")).alias("area"), clipped_box().alias("box"))
    boxes = clipped.groupBy(*key, "occ_id", "category").agg(F.first("area").alias("area"), F.min("hit_id").alias("first_hit"), F.collect_list("box").alias("boxes"))
    return boxes.select(*key, "occ_id", "category", F.size("boxes").alias("n_hits"), "first_hit", F.least(union_area(F.col("boxes")) / F.col("area"), F.lit(1.0)).alias("cover"))


def clipped_box() -> Column:
    """The common part of a pair's boxes."""
    y0, x0 = F.greatest("gy", "hy"), F.greatest("gx", "hx")
    y1, x1 = F.least(F.col("gy") + F.col("gh"), F.col("hy") + F.col("hh")), F.least(F.col("gx") + F.col("gw"), F.col("hx") + F.col("hw"))
    return F.struct(y0.alias("y0"), y1.alias("y1"), x0.alias("x0"), x1.alias("x1"))


def credited(single: DataFrame, unions: DataFrame, key: tuple[str, ...] = ("page",)) -> DataFrame:
    """The union's credit where it is of two hits or more and strictly larger; of equal
    unions the category whose hit comes first."""
    own = [*key, "occ_id"]
    better = unions.where("n_hits >= 2").groupBy(*own).agg(F.max_by(F.struct("cover", "category"), F.struct(F.col("cover"), -F.col("first_hit"))).alias("u"))
    joined = single.join(better, own, "left")
    take = F.coalesce(F.col("u.cover") > F.col("cover"), F.lit(False))
    return joined.select(*own, F.when(take, F.col("u.cover")).otherwise(F.col("cover")).alias("cover"), F.when(take, F.col("u.category")).otherwise(F.col("category")).alias("category"), take.alias("by_union"))


def surplus_hits(hits: DataFrame, occurrences: DataFrame, least: float = 0.5, key: tuple[str, ...] = ("page",), cell: float = 64.0) -> DataFrame:
    """Hits that neither cover, nor are covered by, half of any occurrence."""
    gt, det = tuple(F.col(f"g{c}") for c in "xywh"), tuple(F.col(f"h{c}") for c in "xywh")
    held = box_pairs(occurrences, hits, list(key), cell).where((F.col("cover") >= least) | (cover(det, gt) >= least)).select(*key, "hit_id").distinct()
    return hits.join(held, [*key, "hit_id"], "left_anti")


def median_run(runs: DataFrame, group: list[str], score: str, index: str) -> DataFrame:
    """The middle run (n // 2) of each group by (score, index), with the least and greatest score."""
    own = Window.partitionBy(*group)
    ranked = runs.withColumns({"_rn": F.row_number().over(own.orderBy(score, index)), "n_runs": F.count("*").over(own), "least": F.min(score).over(own), "most": F.max(score).over(own)})
    return ranked.where(F.col("_rn") == F.floor(F.col("n_runs") / 2) + 1).drop("_rn")


#: The keys of a sidecar row, those that may be absent last.
SIDECAR_KEYS, SIDECAR_MORE = ("doc_id", "family", "start", "end", "outcome"), ("tier", "det_start", "det_end", "det_spans")


def sidecar_violations(rows: DataFrame, families: tuple[str, ...] | None = None) -> DataFrame:
    """Rows (doc_id, family, start, end, tier, outcome, det_start, det_end[, det_spans]) that
    break a rule, with the first rule broken. ``det_spans``, ordered (start, end) pairs that
    each meet the span, have [det_start, det_end) as their hull."""
    tier, outcome = F.col("tier"), F.col("outcome")
    fired = F.col("det_start").isNotNull()
    rule = F.when(~((F.col("start") >= 0) & (F.col("start") < F.col("end"))), "bounds")
    if families:
        rule = rule.when(~F.col("family").isin(*families), "family")
    rule = (
        rule.when(~outcome.isin("tp", "fp", "fn", "tn"), "outcome")
        .when(fired != F.col("det_end").isNotNull(), "half_detection")
        .when(outcome.isin("tp", "fn") & ~F.coalesce(tier.isin("must", "should", "watch"), F.lit(False)), "tier")
        .when((outcome == "tn") & ~F.coalesce(tier == "must_not", F.lit(False)), "tier")
        .when((outcome == "tp") != (fired & outcome.isin("tp")), "detection")
        .when(outcome.isin("fn", "tn") & fired, "detection")
        .when((outcome == "fp") & (tier.isNull() == fired), "detection")
        .when(fired & ~overlap(F.col("start"), F.col("end"), F.col("det_start"), F.col("det_end")), "no_overlap")
    )
    if "det_spans" in rows.columns:
        pairs = F.coalesce("det_spans", F.array().cast(rows.schema["det_spans"].dataType))
        outside = F.exists(pairs, lambda p: ~((p["start"] < p["end"]) & overlap(F.col("start"), F.col("end"), p["start"], p["end"])))
        hull = (F.array_min(F.transform(pairs, lambda p: p["start"])) != F.col("det_start")) | (F.array_max(F.transform(pairs, lambda p: p["end"])) != F.col("det_end"))
        rule = (
            rule.when(F.coalesce(fired & tier.isNotNull() & (F.size(pairs) == 0), F.lit(False)), "no_spans")
            .when(outside, "span_outside")
            .when(F.size(pairs) != F.size(F.array_distinct(pairs)), "span_order")
            .when(F.array_sort(pairs) != pairs, "span_order")
            .when((F.size(pairs) > 0) & F.coalesce(hull, F.lit(True)), "hull")
        )
    return rows.withColumn("rule", rule).where(F.col("rule").isNotNull())


def repeated(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def tier_of(tier: Column, expected: Column) -> Column:
    """An explicit tier, else by the expected outcome."""
    return F.coalesce(F.nullif(tier, F.lit("")), F.when(expected == "suppress", "must_not").when(expected == "flag", "watch").otherwise("must"))
