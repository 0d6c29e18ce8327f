"""First-wins merging of ordered sources, and what is counted after it.

The order of specs and rows is carried as columns; nothing relies on the order of
rows in a frame. ``min_by`` combines on the map side, so what is shuffled is one
row a key and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import in_ranges, sorted_digest, streamed_digest

#: The demographic labels, in the order that breaks ties, and the plurality bound.
DEMOGRAPHICS = ("white", "black", "asian", "ai_an", "hispanic", "unlabeled")
PLURALITY = 40.0


def concat_specs(specs: list[DataFrame]) -> DataFrame:
    """Union in the given order, with the spec's number as ``spec_ord``."""
    out = specs[0].withColumn("spec_ord", F.lit(0))
    for i, spec in enumerate(specs[1:], 1):
        out = out.unionByName(spec.withColumn("spec_ord", F.lit(i)))
    return out


def first_wins(rows: DataFrame, key: str, keep: list[str], order: list[str]) -> DataFrame:
    """Per ``key`` the ``keep`` columns of its first row by ``order``."""
    kept = F.min_by(F.struct(*keep), F.struct(*order)).alias("_kept")
    return rows.groupBy(key).agg(kept).select(key, *(f"_kept.{c}" for c in keep))


def last_wins(rows: DataFrame, key: str, keep: list[str], order: list[str]) -> DataFrame:
    """Per ``key`` the ``keep`` columns of its last row by ``order``."""
    kept = F.max_by(F.struct(*keep), F.struct(*order)).alias("_kept")
    return rows.groupBy(key).agg(kept).select(key, *(f"_kept.{c}" for c in keep))


def zero_filled(counts: DataFrame, axis: str, labels: tuple[str, ...], value: str = "n") -> DataFrame:
    """One row for each label of a closed axis, 0 where nothing was counted."""
    dim = counts.sparkSession.createDataFrame([(x,) for x in labels], f"{axis} string")
    return dim.join(counts, axis, "left").select(axis, F.coalesce(value, F.lit(0)).alias(value))


def keys_digest(keys: DataFrame, key: str) -> DataFrame:
    """(digest, n_keys): SHA-256 of the sorted distinct keys joined by line feeds. The bytes
    pass through the driver in order, range after range; ``tree_digest`` needs none of it."""
    return keys.sparkSession.createDataFrame([streamed_digest(keys, key)], "digest string, n_keys long")


def tree_digest(keys: DataFrame, key: str) -> DataFrame:
    """A digest for key sets of any size: over the digests of ranges of the sorted keys."""
    return sorted_digest(keys, key).select("digest")


def plurality(shares: dict[str, Column], bound: float = PLURALITY) -> Column:
    """The label of the largest share; ties to the earlier one; below the bound, unlabeled."""
    top = F.greatest(*shares.values())
    out = F.when(top < bound, "unlabeled")
    for label, share in shares.items():
        out = out.when(share == top, label)
    return out


def keep_entities(rows: DataFrame, entity: str, language: str, label: Column, least: int = 5, languages: list[str] | None = None) -> DataFrame:
    """Labels of the entities that have at least ``least`` distinct non-empty languages."""
    known = rows.where(F.col(language) != "")
    known = known.where(F.col(language).isin(languages)) if languages else known
    grouped = known.groupBy(entity).agg(F.countDistinct(language).alias("n_languages"), F.array_sort(F.collect_set(label)).alias("labels"))
    return grouped.where(F.col("n_languages") >= least).select(entity, "n_languages", F.explode("labels").alias("label"))


def broken_runs(rows: DataFrame, key: str, order: str) -> DataFrame:
    """(key, runs) of keys whose rows are not contiguous in ``order``. Neighbours are compared
    inside ranges; of each range its first and last key are compared with its neighbours'."""
    placed = in_ranges(rows.select(key, order), [order])
    before = F.lag(F.struct(key)).over(Window.partitionBy("_range").orderBy(order))
    inside = placed.withColumn("_start", before.isNotNull() & ~F.struct(key).eqNullSafe(before)).groupBy(key).agg(F.count_if("_start").alias("n"))
    ends = placed.groupBy("_range").agg(F.min_by(F.struct(key), order).alias("first"), F.max_by(F.struct(key), order).alias("last"))
    listed = ends.agg(F.sort_array(F.collect_list(F.struct("_range", "first", "last"))).alias("r"))
    new = F.filter(F.transform("r", lambda x, i: F.when((i == 0) | ~F.get("r", i - 1)["last"].eqNullSafe(x["first"]), x["first"])), lambda f: f.isNotNull())
    edges = listed.select(F.explode(new).alias("f")).select(f"f.{key}").groupBy(key).agg(F.count("*").alias("n"))
    return inside.unionByName(edges).groupBy(key).agg(F.sum("n").alias("runs")).where("runs > 1")
