"""Detections joined to the ground truth they are judged by, and the tallies of cells.

A sidecar row says what became of one labelled span (or of a detection without one);
it is looked up in the corpus by (document, start, end). What does not agree is never
dropped: it becomes a violation, and ``fail_on`` makes violations fail the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import ratio, wilson
from .spans import covered_tokens, overlap_join

#: The tiers that ask for a detection, the cell axes, and a cell's counters.
POSITIVE_TIERS = ("must", "should", "watch")
AXES = ("family", "doctype", "bucket")
UNATTRIBUTED = "unattributed"
SHOWN = 20


def join_truth(rows: DataFrame, docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with their document's class and bucket, their span, and ``rule``: the
    first thing that does not agree, or null.

    rows: doc_id, start, end, family, tier, outcome, det_spans; docs: doc_id, doctype,
    bucket; spans: doc_id, start, end, family, tier, tokens, context_class. A row with a
    tier names a span; one without is a detection that no span accounts for.
    """
    truth = spans.select("doc_id", "start", "end", F.struct(F.col("family").alias("family"), F.col("tier").alias("tier"), "tokens", "context_class").alias("span"))
    known = rows.join(docs.select("doc_id", "doctype", "bucket", F.lit(True).alias("_known")), "doc_id", "left")
    joined = known.join(truth, ["doc_id", "start", "end"], "left")
    named = F.col("tier").isNotNull()
    rule = (
        F.when(F.col("_known").isNull(), "unknown_document")
        .when(named & F.col("span").isNull(), "no_span")
        .when(named & (F.col("span.family") != F.col("family")), "family")
        .when(named & ~F.col("span.tier").eqNullSafe(F.col("tier")), "tier")
    )
    return joined.withColumn("span", F.when(named, F.col("span"))).withColumn("rule", rule).drop("_known")


def truth_violations(joined: DataFrame) -> DataFrame:
    """(rule, doc_id, start, end): rows that do not agree with the corpus, ground-truth
    rows that repeat, and one row if only some spans carry a context class."""
    place = ("doc_id", "start", "end")
    wrong = joined.where("rule IS NOT NULL").select("rule", *place)
    named = joined.where("tier IS NOT NULL")
    twice = named.groupBy(*place).count().where("count > 1").select(F.lit("duplicate").alias("rule"), *place)
    classed = F.count_if(F.col("span.context_class").isNotNull())
    partial = named.where("span IS NOT NULL").agg(classed.alias("k"), F.count("*").alias("n")).where("k > 0 AND k < n")
    whole = partial.select(F.lit("partial_annotation").alias("rule"), *(F.lit(None).cast(joined.schema[c].dataType).alias(c) for c in place))
    return wrong.unionByName(twice).unionByName(whole)


def fail_on(violations: DataFrame, what: str) -> None:
    """Raise with the first few violations, if there are any."""
    first = violations.limit(SHOWN).collect()
    if first:
        raise ValueError(f"{what}: " + "; ".join(str(tuple(r)) for r in first))


def _coverage(joined: DataFrame) -> DataFrame:
    tokens = F.coalesce(F.col("span.tokens"), F.array().cast("array<struct<start:int,end:int>>"))
    hit = F.when(F.col("outcome") == "tp", covered_tokens(tokens, F.col("det_spans")))
    return joined.withColumns({"_hit": hit, "_tokens": F.size(tokens)})


def cell_tallies(joined: DataFrame, axes: tuple[str, ...] = AXES) -> DataFrame:
    """Counts of each cell: tp, fn, fp, must_not_total, must_not_fired, one_token_tp (a
    span that is found, but not with all its tokens), and total and covered by tier."""
    rows = _coverage(joined)
    o, t = F.col("outcome"), F.col("tier")
    spurious = (o == "fp") & t.isNull()
    fired = (o == "fp") & t.isNotNull()
    flags = {
        "tp": o == "tp",
        "fn": o == "fn",
        "fp": spurious,
        "must_not_total": (o == "tn") | fired,
        "must_not_fired": fired,
        "one_token_tp": (o == "tp") & F.col("span").isNotNull() & (F.col("_hit") < F.col("_tokens")),
    }
    for tier in POSITIVE_TIERS:
        flags[f"{tier}_total"] = o.isin("tp", "fn") & (t == tier)
        flags[f"{tier}_covered"] = (o == "tp") & (t == tier)
    return rows.groupBy(*axes).agg(*(F.count_if(flag).alias(name) for name, flag in flags.items()))


def tally_view(tallies: DataFrame, digits: int = 6) -> DataFrame:
    """Recall by any overlap and by all tokens, each with its interval."""
    n, tp = F.col("tp") + F.col("fn"), F.col("tp")
    whole = tp - F.col("one_token_tp")
    out = {"recall": ratio(tp, n), "recall_all_tokens": ratio(whole, n)}
    out["recall_low"], out["recall_high"] = wilson(tp, n)
    out["all_tokens_low"], out["all_tokens_high"] = wilson(whole, n)
    return tallies.withColumns({k: F.round(v, digits) for k, v in out.items()})


def tally_histograms(joined: DataFrame, axes: tuple[str, ...] = AXES) -> DataFrame:
    """(axes, kind, bin, n): for true positives the covered tokens as "k/n" and the
    number of detections."""
    found = _coverage(joined).where("outcome = 'tp'")
    covered = F.when(F.col("span").isNotNull(), F.concat_ws("/", "_hit", "_tokens"))
    bins = F.array(F.struct(F.lit("token_coverage").alias("kind"), covered.alias("bin")), F.struct(F.lit("detections_per_tp").alias("kind"), F.size("det_spans").cast("string").alias("bin")))
    each = found.select(*axes, F.explode(bins).alias("b")).select(*axes, "b.kind", "b.bin").where("bin IS NOT NULL")
    return each.groupBy(*axes, "kind", "bin").agg(F.count("*").alias("n"))


def furniture_counts(joined: DataFrame, furniture: DataFrame, bin_width: int = 256) -> DataFrame:
    """(family, doctype, kind, n): detections without a span, by the kinds of page
    furniture that they touch, each kind once. No rows if no region is known.

    furniture: doc_id, start, end, kind.
    """
    spurious = joined.where("outcome = 'fp' AND tier IS NULL").select("doc_id", "family", "doctype", F.monotonically_increasing_id().alias("l_id"), F.col("start").alias("l0"), F.col("end").alias("l1"))
    regions = furniture.select("doc_id", F.col("kind").alias("r_id"), F.col("start").alias("r0"), F.col("end").alias("r1"))
    met = overlap_join(spurious.select("doc_id", "l_id", "family", "doctype", "l0", "l1"), regions, "doc_id", bin_width)
    kinds = met.select("doc_id", "l_id", "family", "doctype", F.col("r_id").alias("kind")).distinct()
    free = spurious.join(kinds, ["doc_id", "l_id"], "left_anti").select("family", "doctype", F.lit(UNATTRIBUTED).alias("kind"))
    counts = kinds.select("family", "doctype", "kind").unionByName(free).groupBy("family", "doctype", "kind").agg(F.count("*").alias("n"))
    known = furniture.limit(1).select(F.lit(1).alias("_one"))
    return counts.withColumn("_one", F.lit(1)).join(known, "_one", "left_semi").drop("_one")


def truth_totals(spans: DataFrame, split: DataFrame, categories: tuple[str, ...], outcome: str = "redact") -> DataFrame:
    """(category, total) of the spans to redact in the documents of ``split`` (doc_id),
    every category of the closed list present."""
    kept = spans.where((F.col("expected_outcome") == outcome) & F.col("category").isin(*categories)).join(split.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = kept.groupBy("category").agg(F.count("*").alias("total"))
    dim = spans.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    return dim.join(counts, "category", "left").select("category", F.coalesce("total", F.lit(0)).alias("total"))


def id_coverage(dumped: DataFrame, corpus: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, status): ids of only one of two tables."""
    a, b = dumped.select(key).distinct(), corpus.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("status", F.lit("unknown")).unionByName(b.join(a, key, "left_anti").withColumn("status", F.lit("missing")))
