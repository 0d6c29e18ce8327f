"""Connected components by alternating large-star and small-star steps.

Edges are rewritten until each vertex hangs on the smallest of its component
(Kiveris et al., "Connected Components in MapReduce and Beyond"). Every step's
edges are a written table; nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Workspace


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
    return row[0], row[1] or 0


def _smallest(edges: DataFrame, work: Workspace, rows: int) -> DataFrame:
    """Per ``u`` its smallest ``v``; written, so that the join back to a vertex
    with very many edges can be split."""
    return work.write(edges.groupBy("u").agg(F.min("v").alias("m")), "smallest", rows)


def connected_components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(id, component) of every vertex of ``edges`` (u long, v long); loops and
    repeated edges do no harm."""
    now = work.write(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        most = 2 * mark[0]  # no step makes more rows than an edge and its reverse
        least = _smallest(both, work, most)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = work.write(large.distinct(), "large", most)
        parent = _smallest(large, work, most)
        rest = large.join(parent, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = work.write(rest.unionByName(parent.select("u", F.col("m").alias("v"))).distinct(), "edges", most)
        work.drop(now, least, large, parent)
        now, before = small, mark
        mark = _mark(now)
        if mark == before:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return work.write(now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots), "components", 2 * mark[0])
