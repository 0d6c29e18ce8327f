"""What needs the order of all rows, without sorting them all in one task.

Keys are cut into ranges at the quantiles of a bounded sample; a range is ordered on
its own, and what goes over range ends is one row a range.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows aimed at in a range, ranges at most, and rows sampled for each bound.
RANGE_ROWS, RANGES, SAMPLED = 100_000, 4_096, 16


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the folder of ``spark.checkpoint.dir``
    (a temporary one only on one machine)."""
    context = df.sparkSession.sparkContext
    if not (context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()):
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        import tempfile

        context.setCheckpointDir(tempfile.mkdtemp(prefix="sievemark-"))
    return df.checkpoint()


def in_ranges(rows: DataFrame, order: list[str], range_rows: int | None = None) -> DataFrame:
    """``rows`` with ``_range``, which grows with ``order``; equal keys share one. The bounds
    are quantiles of a sample by hash, so they are the same whenever the plan runs; a key is
    looked up among every so many bounds first, then among those between."""
    n = rows.count()
    ranges = min(RANGES, n // (range_rows or RANGE_ROWS))
    if ranges < 2:
        return rows.withColumn("_range", F.lit(0))
    asked = SAMPLED * ranges
    sampled = rows.where(F.pmod(F.xxhash64(*order), F.lit(max(1, n // asked))) == 0).select(*order).distinct().limit(4 * asked)
    some = sampled.orderBy(*order).collect()
    bounds = some[len(some) // ranges :: max(1, len(some) // ranges)]
    if not bounds:
        return rows.withColumn("_range", F.lit(0))
    kinds = [rows.schema[c].dataType for c in order]
    one = len(order) == 1
    key = F.col(order[0]) if one else F.struct(*order)
    literal = lambda b: F.lit(b[0]).cast(kinds[0]) if one else F.struct(*(F.lit(v).cast(t).alias(c) for v, t, c in zip(b, kinds, order, strict=True)))
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= key))
    heads, inner = F.array(*(literal(g[0]) for g in groups)), F.array(*(F.array(*map(literal, g)) for g in groups))
    placed = rows.withColumn("_group", below(heads))
    within = (F.col("_group") - 1) * step + below(F.get(inner, F.col("_group") - 1))
    return placed.withColumn("_range", F.when(F.col("_group") > 0, within).otherwise(0).cast("int")).drop("_group")


def before_range(placed: DataFrame, value: Column, group: list[str] | None = None) -> DataFrame:
    """(group, _range, _before): the sum of ``value`` over the ranges before each. One
    number a range and group comes together."""
    group = group or []
    sums = placed.groupBy(*group, "_range").agg(value.alias("_sum"))
    each = F.sort_array(F.collect_list(F.struct("_range", "_sum")))
    runs = sums.groupBy(*group).agg(each.alias("r"))
    begun = F.transform("r", lambda x, i: F.struct(x["_range"].alias("_range"), F.aggregate(F.slice("r", 1, i), F.lit(0).cast("long"), lambda acc, y: acc + y["_sum"]).alias("_before")))
    return runs.select(*group, F.inline(begun))


def ordinals(rows: DataFrame, group: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    """``rows`` with their place (from 0) in their group by ``order``."""
    placed = in_ranges(rows, [*group, *order])
    starts = before_range(placed, F.count("*"), group)
    own = Window.partitionBy(*group, "_range").orderBy(*order)
    return placed.withColumn("_own", F.row_number().over(own) - 1).join(starts, [*group, "_range"]).withColumn(name, F.col("_before") + F.col("_own")).drop("_range", "_own", "_before")


def streamed_digest(keys: DataFrame, key: str) -> tuple[str, int]:
    """(SHA-256, count) of the sorted distinct keys joined by line feeds. A SHA-256 is taken in
    order, so the ranges come to the driver one after another, and one is held at a time."""
    placed = in_ranges(keys.select(F.col(key).cast("string").alias("k")).where("k IS NOT NULL").distinct(), ["k"])
    joined = placed.groupBy("_range").agg(F.array_join(F.array_sort(F.collect_list("k")), "\n").alias("t"), F.count("*").alias("n"))
    digest, total = hashlib.sha256(), 0
    for r in joined.orderBy("_range").toLocalIterator():
        digest.update(("\n" if total else "").encode() + r["t"].encode())
        total += r["n"]
    return digest.hexdigest(), total


def sorted_digest(keys: DataFrame, key: str) -> DataFrame:
    """(digest, n_keys): SHA-256 over the digests of the ranges of the sorted distinct keys,
    each of its keys joined by line feeds. One range is in one row, of bounded share."""
    placed = in_ranges(keys.select(F.col(key).cast("string").alias("k")).where("k IS NOT NULL").distinct(), ["k"])
    leaves = placed.groupBy("_range").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("k")), "\n").cast("binary"), 256).alias("d"), F.count("*").alias("n"))
    return leaves.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_range", "d"))), lambda x: x["d"]), "\n").cast("binary"), 256).alias("digest"), F.sum("n").alias("n_keys"))
