"""Exact top-k by integer inner product, term at a time.

A vector is a sparse row of integer weights; a term is a component. A block of
candidates is turned into postings (per term the rows that have it, and their
weights); for each term the queries that have it scatter query weight times
posting weight into dense arrays of scores. A partition selects its best by
partitioning those arrays, and the partitions' lists are merged.

Queries are broadcast in groups of about ``QUERIES`` rows (a few MB), with one
pass over the candidates for each group, one group after another, so memory stays
bounded however many queries there are. Nothing is approximate.

Defined results: rows with a null id, a null vector, or a null or non-finite
component take no part. Missing components of a shorter vector count as 0. All
rows of the query's own id are left out; repeated candidate rows each count, of
repeated query rows the smallest vector is asked; ties go to the smaller id. Scores beyond 64 bits are clipped to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import quoted
from .storage import Workspace

SCALE = 1024
#: Queries broadcast at once, candidates in a block, queries scored at once.
QUERIES, ROWS, TILE = 16_384, 4_096, 128
_FULL = np.iinfo(np.int64)


def usable(vector: Column) -> Column:
    """Not null, and only finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd)


def quantized(vectors: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, shorter vectors filled up with 0: int64,
    or Python integers where a component or an inner product may not fit."""
    values = np.floor(np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64) * scale)
    lengths = np.diff(np.asarray(vectors.offsets))
    width = int(lengths.max(initial=0))
    wide = len(values) and np.abs(values).max() * np.sqrt(max(width, 1)) >= 2.0**31
    out = np.zeros((len(lengths), width), object if wide else np.int64)
    at = np.arange(width) < lengths[:, None]
    out[at] = [int(v) for v in values] if wide else values.astype(np.int64)
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of all queries against all candidates, term by term over postings."""
    wide = object in (queries.dtype, candidates.dtype)
    scores = np.zeros((len(queries), len(candidates)), object if wide else np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        asking, posted = np.flatnonzero(queries[:, term]), np.flatnonzero(candidates[:, term])
        if not len(asking) or not len(posted):
            continue
        weights = candidates[posted, term]
        if len(posted) == len(candidates):
            for q in asking:
                scores[q] += queries[q, term] * weights
        else:
            for q in asking:
                scores[q, posted] += queries[q, term] * weights
    return np.clip(scores, _FULL.min, _FULL.max).astype(np.int64) if wide else scores


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of the k highest of each row without its own id."""
    for q, row in enumerate(scores):
        kept = np.flatnonzero(ids != own[q])
        s = row[kept]
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            few = np.flatnonzero(s >= least)
            kept, s = kept[few], s[few]
        order = np.lexsort((ids[kept], ~s))[:k]
        yield q, ids[kept][order], s[order]


def search(candidates: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each query."""
    spark = candidates.sparkSession
    plain = lambda df: df.select(quoted(key).cast("long").alias("id"), quoted(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    rows, asked = plain(candidates), plain(queries).groupBy("id").agg(F.min("v").alias("v"))
    groups = max(1, -(-asked.count() // QUERIES))
    schema = "query_id long, vec_id long, score long"

    def one(group: int):
        held = asked.where(F.pmod(F.xxhash64("id"), F.lit(groups)) == group).orderBy("id").toArrow() if groups > 1 else asked.orderBy("id").toArrow()
        ids = held["id"].to_numpy()
        shared = spark.sparkContext.broadcast((ids, quantized(held["v"].combine_chunks() if held.num_rows else pa.array([], pa.list_(pa.float64())), scale)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, matrix = shared.value
            top_ids: list[np.ndarray] = [np.empty(0, np.int64)] * len(own)
            top_scores = list(top_ids)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    block_ids, block = part.column(0).to_numpy(), quantized(part.column(1), scale)
                    for first in range(0, len(own), TILE):
                        tile = slice(first, first + TILE)
                        for q, got, s in best(accumulate(matrix[tile], block), block_ids, own[tile], k):
                            q += first
                            both, scores = np.concatenate([top_ids[q], got]), np.concatenate([top_scores[q], s])
                            order = np.lexsort((both, ~scores))[:k]
                            top_ids[q], top_scores[q] = both[order], scores[order]
            n = [len(x) for x in top_ids]
            if sum(n):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, n)), pa.array(np.concatenate(top_ids)), pa.array(np.concatenate(top_scores))], names=["query_id", "vec_id", "score"])

        return rows.mapInArrow(run, schema), shared

    # Group after group, so that the driver and the executors hold one group at a time.
    if groups == 1:
        parts = one(0)[0]
    else:
        work = Workspace(spark, "topk")
        path = work.fresh("best")
        for group in range(groups):
            part, shared = one(group)
            part.write.parquet(f"{path}/group={group}")
            shared.destroy()
        parts = spark.read.schema(schema).parquet(path).select("query_id", "vec_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
