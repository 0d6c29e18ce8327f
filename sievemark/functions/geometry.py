"""Boxes (x, y, w, h) and half-open intervals as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Whether two half-open intervals meet."""
    return (a0 < b1) & (b0 < a1)


def interval_iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    inter = F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0))
    hull = F.greatest(a1, b1) - F.least(a0, b0)
    return F.when(hull > 0, inter.cast("double") / hull).otherwise(0.0)


def corner_box(x0: Column, y0: Column, x1: Column, y1: Column) -> tuple[Column, Column, Column, Column]:
    return x0, y0, x1 - x0, y1 - y0


def intersection(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    ix = F.greatest(F.lit(0.0), F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0]))
    iy = F.greatest(F.lit(0.0), F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1]))
    return ix * iy


def box_iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    inter = intersection(a, b)
    union = a[2] * a[3] + b[2] * b[3] - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def cover(gt: tuple[Column, ...], det: tuple[Column, ...]) -> Column:
    """Share of ``gt`` under ``det``, 0 for an empty box."""
    area = gt[2] * gt[3]
    return F.when(area > 0, intersection(gt, det) / area).otherwise(0.0)


def union_area(boxes: Column) -> Column:
    """Area under the union of array<struct<y0,y1,x0,x1>>: in each slab between two
    neighbouring x edges, the merged length of the y intervals that span it. Of n boxes
    it takes n * n steps, and stays in one row."""
    by_y = F.array_sort(boxes)
    edges = F.array_sort(F.array_distinct(F.concat(F.transform(boxes, lambda b: b["x0"]), F.transform(boxes, lambda b: b["x1"]))))
    slabs = F.zip_with(F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1), lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi")))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(float("-inf")).alias("top"))

    def merge(acc: Column, b: Column) -> Column:
        more = F.greatest(F.lit(0.0), b["y1"] - F.greatest(b["y0"], acc["top"]))
        return F.struct((acc["sum"] + more).alias("sum"), F.greatest(acc["top"], b["y1"]).alias("top"))

    def height(slab: Column) -> Column:
        spanning = F.filter(by_y, lambda b: (b["x0"] <= slab["lo"]) & (b["x1"] >= slab["hi"]))
        return F.aggregate(spanning, start, merge, lambda acc: acc["sum"])

    return F.aggregate(slabs, F.lit(0.0), lambda acc, slab: acc + (slab["hi"] - slab["lo"]) * height(slab))
