"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in halves, each with a codebook of its own; a pair of codes is
a cell of the product grid. A vector is filed in the cells nearest to it, which a
multi-sequence traversal visits in order of the summed distances of the two
halves. Two vectors meet if they are filed in a common cell, and a pair is counted
in the smallest of its common cells, so that every link found is found once and
from both sides. What meets is verified by cosine in double precision.

The codebooks are fitted on a bounded sample; every vector is indexed. How many
cells are visited follows from a target recall, measured on the sample against
pairs at the threshold.

Equal vectors are one vertex with a weight. A cell of very many vertices is dealt
into tiles; a tile yields one row a vertex (links counted, smallest id reachable
inside the tile), never its pairs.

Defined results: vectors that are null, zero, or hold null or non-finite
components link with nothing, nor do vectors of different lengths with one another
(each length has an index of its own, and one with few vectors is a single cell).
Rows that repeat an id count as one vector, the smallest; a row without id stands
for itself. An empty table gives an empty result. A target recall that ``MOST_CELLS``
cells a vector cannot reach is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import quoted
from .components import connected_components
from .storage import Workspace, among
from .topk import usable

#: Vectors that the codebooks are fitted on at most, vectors aimed at in a cell, side of a tile.
SAMPLE, CELL, TILE = 16_384, 32, 1_024
MOST_CODES, ROUNDS, MOST_CELLS = 1_024, 12, 64
#: Up to so many vectors of one length need no index: they are one cell.
FEW = 1_024
TARGET_RECALL = 0.995


def _nearest(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every code, but for the point's own norm."""
    return (codes**2).sum(1) - 2.0 * points @ codes.T


def codebook(points: np.ndarray, n: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's iterations from evenly spaced points; a code without points stays."""
    codes = points[np.linspace(0, len(points) - 1, n).astype(int)].copy()
    for _ in range(rounds):
        own = _nearest(points, codes).argmin(1)
        sums, counts = np.zeros_like(codes), np.bincount(own, minlength=n)
        np.add.at(sums, own, points)
        codes[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return codes


def traverse(d1: np.ndarray, d2: np.ndarray, cells: int) -> np.ndarray:
    """The ``cells`` nearest cells of each row, nearest first.

    With both halves' codes sorted by distance, the cell of ranks (i, j) comes
    after all of smaller ranks, so only ranks with (i + 1) * (j + 1) <= cells can
    be among the nearest: the frontier of the multi-sequence algorithm, for all
    rows at once.
    """
    n1, n2 = d1.shape[1], d2.shape[1]
    o1, o2 = (np.argsort(d, axis=1, kind="stable")[:, :cells] for d in (d1, d2))
    s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
    ranks = [(i, j) for i in range(min(cells, n1)) for j in range(min(cells // (i + 1), n2))]
    i, j = (np.array(x) for x in zip(*ranks, strict=True))
    nearest = np.argsort(s1[:, i] + s2[:, j], axis=1, kind="stable")[:, :cells]
    return (o1[:, i] * n2 + o2[:, j])[np.arange(len(d1))[:, None], nearest]


def cells_for_recall(units: np.ndarray, books: tuple[np.ndarray, np.ndarray], cosine: float, target: float, most: int = MOST_CELLS) -> int:
    """The fewest cells with which vectors and random partners at the threshold
    cosine have one in common in at least ``target`` of all cases; an error if more
    than ``most`` are needed."""
    rng = np.random.default_rng(1)
    some = units[rng.permutation(len(units))[:4_096]]
    other = rng.standard_normal(some.shape)
    other -= (other * some).sum(1, keepdims=True) * some
    other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-300)
    other = cosine * some + np.sqrt(1 - cosine**2) * other
    half = units.shape[1] // 2
    a, b = (traverse(_nearest(x[:, :half], books[0]), _nearest(x[:, half:], books[1]), most) for x in (some, other))
    same = a[:, :, None] == b[:, None, :]
    at = np.where(same, np.maximum(np.arange(a.shape[1])[:, None], np.arange(b.shape[1])[None, :]), most)
    needed = np.sort(at.reshape(len(some), -1).min(1)) + 1
    cells = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])
    if cells > most:
        raise ValueError(f"{most} cells a vector reach a recall of {(needed <= most).mean():.4f}, not {target}: raise ``most`` or lower ``target``")
    return cells


def _units(vectors: pa.Array) -> np.ndarray:
    width = len(vectors[0])
    x = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _meet(cell: int, i: int, j: int, rows: pa.Table, cosine: float) -> pa.Table:
    """Links inside a tile of one cell: (id, links, smallest id in reach)."""
    rows = rows.sort_by("id")
    ids, mine = rows["id"].to_numpy(), rows["mine"].to_numpy()
    x = np.frombuffer(b"".join(rows["unit"].to_pylist()), np.float64).reshape(len(rows), -1)
    filed = np.frombuffer(b"".join(rows["cells"].to_pylist()), np.int64).reshape(len(rows), -1)
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    if i != j:
        linked &= mine[:, None] != mine[None, :]
    some = np.flatnonzero(linked.any(1))
    if not len(some):
        return pa.table({"id": ids[:0], "links": ids[:0], "least": ids[:0]})
    linked, ids, filed = linked[np.ix_(some, some)], ids[some], filed[some]
    # A pair that has a smaller cell in common is counted there.
    smaller, at = np.unique(filed, return_inverse=True)
    at = at.reshape(filed.shape)
    earlier = np.zeros((len(ids), int((smaller < cell).sum())), np.float32)
    row, col = np.nonzero(filed < cell)
    earlier[row, at[row, col]] = 1
    linked &= (earlier @ earlier.T) == 0
    links = linked.astype(np.int64) @ rows["n"].to_numpy()[some]
    least = np.arange(len(ids))
    while True:
        near = np.where(linked, least[None, :], len(ids)).min(1)
        new = np.minimum(least, near)
        new = np.minimum(new, new[new])
        if (new == least).all():
            break
        least = new
    ok = links > 0
    return pa.table({"id": ids[ok], "links": links[ok], "least": ids[least[ok]]})


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, target: float = TARGET_RECALL) -> DataFrame:
    """(id, n_links, component_id, kept) of each vector of ``df``."""
    spark = df.sparkSession
    work = Workspace(spark, "embeddings")
    named = df.select(quoted(key).cast("long").alias("id"), quoted(vector).cast("array<double>").alias("v"))
    known = named.where("id IS NOT NULL").groupBy("id").agg(F.min("v").alias("v"))
    rows = work.write(known.unionByName(named.where("id IS NULL")).withColumn("h", F.xxhash64("v")), "vectors")
    good = rows.where(F.col("id").isNotNull() & usable(F.col("v")) & F.exists("v", lambda x: x != 0))
    # Equal vectors are one vertex of some weight: they link with one another, and alike with others.
    classes = work.write(good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", "n", "v", F.size("v").alias("width")), "classes")
    same = classes.where("n > 1").select("v", F.xxhash64("v").alias("h"), F.col("id").alias("rep"))
    copies = among(good, same.select("h"), "h").join(same, ["h", "v"]).select("id", "rep")
    widths = classes.groupBy("width").count()
    parts = [_meet_all(_one_cell(classes.join(widths.where(f"count BETWEEN 2 AND {FEW}"), "width")), cosine)]
    for r in widths.where(f"count > {FEW}").collect():
        filed = _filed(classes.where(F.col("width") == r["width"]), r["width"], r["count"], cosine, target, work)
        parts.append(_meet_all(filed, cosine))
    met = parts[0]
    for part in parts[1:]:
        met = met.unionByName(part)
    met = work.write(met, "met")
    found = connected_components(met.select(F.col("id").alias("u"), F.col("least").alias("v")), work).withColumnRenamed("id", "rep")
    counts = met.groupBy("id").agg(F.sum("links").alias("n_links")).withColumnRenamed("id", "rep")
    weights = classes.select(F.col("id").alias("rep"), "n")
    out = rows.select("id").join(copies, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
    out = out.join(counts, "rep", "left").join(found, "rep", "left").join(weights.where("n > 1"), "rep", "left")
    component = F.coalesce("component", "rep")
    n_links = F.coalesce("n_links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))
    return out.select("id", n_links.cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def _one_cell(rows: DataFrame) -> DataFrame:
    """Few vectors of a length, all filed in one cell."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = np.zeros(1, np.int64).tobytes()
        for batch in batches:
            units = [_units(batch.column(3).slice(i, 1))[0].tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(units, pa.binary()), pa.array([cell] * len(units), pa.binary()), pa.array([0] * len(units), pa.int64()), pa.array([1] * len(units), pa.int64())], names=["id", "n", "width", "unit", "cells", "cell", "count"])

    return rows.select("id", "n", "width", "v").mapInArrow(file, "id long, n long, width int, unit binary, cells binary, cell long, count long")


def _meet_all(each: DataFrame, cosine: float) -> DataFrame:
    """(id, links, least) rows of all tiles of (id, n, width, unit, cells, cell, count)."""
    each = each.withColumn("blocks", F.ceil(F.col("count") / TILE).cast("int"))
    each = each.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        return _meet(*(k.as_py() for k in key[1:]), rows, cosine)

    each = each.select("width", "cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "id", "n", "unit", "cells")
    return each.groupBy("width", "cell", "i", "j").applyInArrow(meet, "id long, links long, least long")


def _filed(rows: DataFrame, width: int, count: int, cosine: float, target: float, work: Workspace) -> DataFrame:
    """The vectors of one length, in each of their cells that is not theirs alone."""
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    units = _units(sample)
    half = max(1, width // 2)
    n = int(np.clip(np.sqrt(count / CELL), 1, min(MOST_CODES, len(units))))
    books = codebook(units[:, :half], n), codebook(units[:, half:], n if width > 1 else 1)
    cells = cells_for_recall(units, books, cosine, target) if width > 1 else 1
    shared = spark.sparkContext.broadcast((books, half, cells))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (first, second), cut, visits = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2_048):
                part = batch.slice(at, 2_048)
                x = _units(part.column(1))
                got = np.sort(traverse(_nearest(x[:, :cut], first), _nearest(x[:, cut:], second), visits), axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in got], pa.binary()), pa.array(list(got), pa.list_(pa.int64()))], names=["id", "n", "unit", "cells", "each"])

    filed = work.write(rows.select("id", "v", "n").mapInArrow(file, "id long, n long, unit binary, cells binary, each array<long>"), "filed")
    places = filed.select("id", F.explode("each").alias("cell"))
    large = work.write(places.groupBy("cell").count().where("count > 1"), "cells")
    return filed.select("id", "n", F.lit(width).alias("width"), "unit", "cells", F.explode("each").alias("cell")).join(large, "cell").select("id", "n", "width", "unit", "cells", "cell", "count")
