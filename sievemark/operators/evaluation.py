"""Roll-ups of detection counts into metric tables, and verdicts between two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import LOW_SUPPORT, fbeta, ratio, wilson

#: The clauses' bounds and the tolerance under which nothing has moved.
DELTA_P, DELTA_F, EPS, DELTA_SLICE, TOLERANCE = 0.05, 0.30, 0.01, 0.03, 1e-12
NON_REGRESSION_ONLY = ("mrn", "ein")
PERCENTILES = (5, 25, 50, 75, 95)
#: The closed axes and the counters of a cell.
DOCTYPES, BUCKETS = ("court", "medical", "financial", "foia", "generic"), ("white", "black", "hispanic", "asian", "ai_an")
COUNTERS = (
    "true_positives", "false_positives", "false_negatives", "adversarial_suppress_total", "adversarial_suppress_fired", "suppressed_by_negative_context",
    "tier_must_total", "tier_must_covered", "tier_should_total", "tier_should_covered", "tier_watch_total", "tier_watch_covered", "tier_must_not_total", "tier_must_not_fired",
)


def outcomes(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Boolean truth and prediction as tp, fp, fn, tn flags."""
    t, p = F.col(truth), F.col(predicted)
    flags = {"tp": t & p, "fp": ~t & p, "fn": t & ~p, "tn": ~t & ~p}
    return rows.withColumns({k: v.cast("long") for k, v in flags.items()})


def roll_up(rows: DataFrame, axes: list[str], counters: list[str]) -> DataFrame:
    """Sums by all axes together, by each axis, and in total, in one pass;
    ``level`` names which, and the other axes are ``*``."""
    sets = [[F.col(a) for a in axes], *([F.col(a)] for a in axes), []]
    summed = rows.groupingSets(sets, *axes).agg(F.grouping_id().alias("gid"), *(F.sum(c).alias(c) for c in counters))
    full = (1 << len(axes)) - 1
    level = F.when(F.col("gid") == 0, "cell")
    for i, a in enumerate(axes):
        level = level.when(F.col("gid") == full - (1 << (len(axes) - 1 - i)), a)
    level = level.otherwise("total")
    named = [F.when(F.col("level").isin("cell", a), F.col(a)).otherwise("*").alias(a) for a in axes]
    return summed.withColumn("level", level).select("level", *named, *counters)


def metrics(counts: DataFrame, digits: int = 6) -> DataFrame:
    """Precision, recall, F1, F2, false-positive rate, recall's interval, and a
    flag for low support; 0 where a denominator is."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    low, high = wilson(tp, tp + fn)
    out = {"precision": p, "recall": r, "f1": fbeta(p, r), "f2": fbeta(p, r, 2.0), "fpr": ratio(fp, fp + tn), "recall_low": low, "recall_high": high}
    return counts.withColumns({k: F.round(v, digits) for k, v in out.items()} | {"low_confidence": tp + fn < LOW_SUPPORT})


def cell_key(key: Column) -> Column:
    """struct<family, doctype, bucket> of ``<family>_<doctype>_<bucket>``, whose family
    and bucket may hold underscores; null where it does not end in a known pair."""
    pattern = rf"^(.+)_({'|'.join(DOCTYPES)})_({'|'.join(BUCKETS)})$"
    parts = [F.regexp_extract(key, pattern, i + 1) for i in range(3)]
    return F.when(key.rlike(pattern), F.struct(*(p.alias(n) for p, n in zip(parts, ("family", "doctype", "bucket"), strict=True))))


def baseline(cells: DataFrame) -> DataFrame:
    """The metric block of every cell, family, doctype, bucket and of the whole, from
    (family, doctype, bucket, COUNTERS). Doctypes and buckets without support are there."""
    rolled = roll_up(cells, ["family", "doctype", "bucket"], list(COUNTERS))
    spark = cells.sparkSession
    dims = [("doctype", "*", d, "*") for d in DOCTYPES] + [("bucket", "*", "*", b) for b in BUCKETS]
    every = spark.createDataFrame(dims, "level string, family string, doctype string, bucket string")
    filled = rolled.join(every, ["level", "family", "doctype", "bucket"], "full_outer")
    whole = filled.select("level", "family", "doctype", "bucket", *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTERS))
    return metric_block(whole)


def metric_block(counts: DataFrame, digits: int = 6) -> DataFrame:
    """All metrics of COUNTERS; 0 where a denominator is, but a tier's precision, which is 1."""
    c = {n: F.col(n) for n in COUNTERS}
    tp, fp, fn, fired, total = c["true_positives"], c["false_positives"], c["false_negatives"], c["adversarial_suppress_fired"], c["adversarial_suppress_total"]
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    p_low, p_high = wilson(tp, tp + fp)
    r_low, r_high = wilson(tp, tp + fn)
    out = {"precision": p, "precision_low": p_low, "precision_high": p_high, "recall": r, "recall_low": r_low, "recall_high": r_high, "f1": fbeta(p, r), "f2": fbeta(p, r, 2.0)}
    out |= {"decoy_fp_rate": ratio(fired, total), "precision_with_decoys": ratio(tp, tp + fp + fired)}
    must_not = c["tier_must_not_fired"]
    for tier in ("must", "should"):
        n, k = c[f"tier_{tier}_total"], c[f"tier_{tier}_covered"]
        tier_p, tier_r = ratio(k, k + must_not, 1.0), ratio(k, n)
        out |= {f"{tier}_recall": tier_r, f"{tier}_precision": tier_p, f"{tier}_f1": fbeta(tier_p, tier_r), f"{tier}_f2": fbeta(tier_p, tier_r, 2.0)}
        out[f"{tier}_recall_low"], out[f"{tier}_recall_high"] = wilson(k, n)
    out["watch_covered_rate"] = ratio(c["tier_watch_covered"], c["tier_watch_total"])
    out["must_not_fire_rate"] = ratio(must_not, c["tier_must_not_total"])
    out["must_not_low"], out["must_not_high"] = wilson(must_not, c["tier_must_not_total"])
    whole = {"support_n": tp + fn, "detections_n": tp + fp, "family_false_positives": fp + fired, "low_confidence": tp + fn < LOW_SUPPORT}
    return counts.withColumns({k: F.round(v, digits) for k, v in out.items()} | whole)


def score_summary(scores: DataFrame, group: list[str], raw: str, hit: str, cutoff: str, digits: int = 6) -> DataFrame:
    """Per group and side (``hit``): count, extremes, exact mean, what lies on each side of
    the cut-off (nothing where it is null), and percentiles; with the score gap, the least
    score of a hit less the greatest of any other, for groups that have both."""
    value = F.col(raw)
    # Sums of decimals do not depend on the order of rows.
    mean = F.round((F.sum(value.cast("decimal(28,12)")) / F.count(value)).cast("double"), digits)
    sides = scores.groupBy(*group, hit).agg(F.count("*").alias("n"), F.min(raw).alias("least"), F.max(raw).alias("most"), mean.alias("mean"), F.count_if(value >= F.col(cutoff)).alias("above"), F.count_if(value < F.col(cutoff)).alias("below"), *percentiles(raw))
    own = Window.partitionBy(*group)
    gap = F.min(F.when(F.col(hit), F.col("least"))).over(own) - F.max(F.when(~F.col(hit), F.col("most"))).over(own)
    return sides.withColumn("score_gap", F.round(gap, digits))


def percentiles(value: str) -> list[Column]:
    """Nearest-rank percentiles (rank = ceil(p * n)) of a column, by its name."""
    return [F.expr(f"percentile_disc({p / 100}) WITHIN GROUP (ORDER BY {value})").alias(f"p{p}") for p in PERCENTILES]


def clauses(joined: DataFrame) -> DataFrame:
    """Win and regression of each clause from columns ``before_x`` and ``after_x``
    for x in precision, fpr, recall."""
    d = F.col("after_precision") - F.col("before_precision")
    before, after = F.col("before_fpr"), F.col("after_fpr")
    return joined.withColumns(
        {
            "c1_win": d >= DELTA_P,
            "c1_regressed": d < -TOLERANCE,
            "c2_win": after <= before * (1 - DELTA_F),
            "c2_regressed": after > before + TOLERANCE,
            "c3_win": F.col("after_recall") >= F.col("before_recall") - EPS,
            "c3_regressed": F.col("after_recall") < F.col("before_recall") - EPS,
        }
    )


def verdict(checked: DataFrame, name: str) -> DataFrame:
    """Regression, win and the names of the clauses that failed. Families of the
    non-regression bar are not asked for precision."""
    only = F.col(name).isin(*NON_REGRESSION_ONLY)
    c1 = F.col("c1_regressed") & ~only
    regressed = c1 | F.col("c2_regressed") | F.col("c3_regressed")
    failed = F.concat_ws(",", F.when(c1, "C1"), F.when(F.col("c2_regressed"), "C2"), F.when(F.col("c3_regressed"), "C3"))
    win = F.when(only, ~regressed).otherwise(F.col("c1_win") & F.col("c2_win") & F.col("c3_win"))
    return checked.withColumns({"regression": regressed, "win": win, "failed": failed})


def side_by_side(before: DataFrame, after: DataFrame, key: list[str], values: list[str], how: str = "inner") -> DataFrame:
    """Two metric tables joined on their key, values prefixed."""
    a = before.select(*key, *(F.col(v).alias(f"before_{v}") for v in values))
    b = after.select(*key, *(F.col(v).alias(f"after_{v}") for v in values))
    return a.join(b, key, how)


def family_verdicts(before: DataFrame, after: DataFrame, families: tuple[str, ...]) -> DataFrame:
    """A verdict for each family of the list: clauses, regression, win, and ``absent`` for
    those that either table (family, precision, precision_with_decoys, recall,
    low_confidence) lacks; these are not judged."""
    spark = before.sparkSession
    values = ["precision", "precision_with_decoys", "recall", "low_confidence"]
    named = spark.createDataFrame([(f, i) for i, f in enumerate(families)], "family string, place int")
    both = named.join(side_by_side(before, after, ["family"], values), "family", "left")
    both = both.withColumns({f"{s}_fpr": 1.0 - F.col(f"{s}_precision_with_decoys") for s in ("before", "after")})
    judged = verdict(clauses(both), "family")
    absent = F.col("before_precision").isNull()
    judged = judged.withColumns({"absent": absent, "low_confidence": F.col("before_low_confidence") | F.col("after_low_confidence")})
    return judged.withColumns({"regression": F.col("regression") & ~absent, "win": F.when(~absent, F.col("win")), "failed": F.when(absent, "").otherwise(F.col("failed"))})


def slice_verdicts(before: DataFrame, after: DataFrame, key: list[str], value: str = "precision", delta: float = DELTA_SLICE) -> DataFrame:
    """(key, before, after, delta, regressed): a slice regresses if its value falls by more
    than ``delta``. Slices of one side only are left out."""
    both = side_by_side(before, after, key, [value])
    moved = F.col(f"after_{value}") - F.col(f"before_{value}")
    return both.select(*key, F.col(f"before_{value}").alias("before"), F.col(f"after_{value}").alias("after"), moved.alias("delta"), (moved < -delta).alias("regressed"))


def with_slices(judged: DataFrame, slices: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Verdicts with the slice clause folded in: a slice that regressed makes the verdict
    of its ``key`` (or the only one) regress and no longer win."""
    key = key or []
    worst = slices.groupBy(*key).agg(F.coalesce(F.bool_or("regressed"), F.lit(False)).alias("c4_regressed"))
    one = [] if key else [F.lit(1).alias("_one")]
    both = judged.select("*", *one).join(worst.select("*", *one), key or ["_one"], "left").drop("_one")
    bad = F.coalesce("c4_regressed", F.lit(False))
    failed = F.concat_ws(",", F.when(F.col("failed") != "", F.col("failed")), F.when(bad, "C4"))
    return both.withColumns({"c4_regressed": bad, "regression": F.col("regression") | bad, "win": F.col("win") & ~bad, "failed": failed})


def overall(*judged: DataFrame) -> DataFrame:
    """One row: whether any verdict regressed. A good aggregate excuses no family."""
    rows = judged[0].select("regression")
    for more in judged[1:]:
        rows = rows.unionByName(more.select("regression"))
    return rows.agg(F.coalesce(F.bool_or("regression"), F.lit(False)).alias("regression"))


def pooled(rows: DataFrame, group: list[str]) -> DataFrame:
    """Strict precision and recall of pooled document rows (recall, support, fired): hits
    are rebuilt from recall * support, rounded half to even; precision is 1 if nothing fired."""
    hits = F.bround(F.col("recall") * F.col("support"), 0).cast("long")
    g = rows.groupBy(*group).agg(F.sum("support").alias("support"), F.sum(hits).alias("hits"), F.sum("fired").alias("fired"))
    p, r = ratio(F.col("hits"), F.col("hits") + F.col("fired"), 1.0), ratio(F.col("hits"), F.col("support"))
    return g.withColumns({"precision": p, "precision_with_decoys": p, "recall": r, "low_confidence": F.col("support") < LOW_SUPPORT})


def cell_mismatches(a: DataFrame, b: DataFrame, key: list[str], counters: list[str]) -> DataFrame:
    """(key, counter, a, b) where two tallies differ; an absent cell counts 0."""
    long = lambda df, n: df.unpivot(key, counters, "counter", n)
    both = long(a, "left_n").join(long(b, "right_n"), [*key, "counter"], "full_outer")
    both = both.select(*key, "counter", F.coalesce("left_n", F.lit(0)).alias("left_n"), F.coalesce("right_n", F.lit(0)).alias("right_n"))
    return both.where("left_n != right_n")


def site_summary(block: DataFrame, key: list[str]) -> DataFrame:
    """The scalars of a metric block that two sites are compared by, and its tiers as structs."""
    scalars = ("support_n", "detections_n", "precision", "recall", "f1", "f2", "decoy_fp_rate", "precision_with_decoys", "low_confidence")
    scored = [F.struct(*(F.col(f"tier_{t}_{c}").alias(c) for c in ("total", "covered")), *(F.col(f"{t}_{c}").alias(c) for c in ("recall", "precision", "f1", "f2"))).alias(t) for t in ("must", "should")]
    watch = F.struct(F.col("tier_watch_total").alias("total"), F.col("tier_watch_covered").alias("covered"), F.col("watch_covered_rate").alias("covered_rate")).alias("watch")
    must_not = F.struct(F.col("tier_must_not_total").alias("total"), F.col("tier_must_not_fired").alias("fired"), F.col("must_not_fire_rate").alias("fire_rate")).alias("must_not")
    return block.select(*key, *scalars, F.struct(*scored, watch, must_not).alias("per_tier"))
