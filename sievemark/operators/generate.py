"""Ladders of hostile inputs, and resampling."""

from __future__ import annotations

import random
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The resampling count and seed.
RESAMPLES, SEED = 2_000, 20260416
#: Draws handled at once.
CHUNK = 1 << 22


def redos_ladder(spark: SparkSession) -> DataFrame:
    """(class, length, text): inputs that would make a backtracking matcher slow."""
    lengths = F.explode(F.array(*(F.lit(1 << i) for i in range(3, 11))))
    n = F.col("length")
    shapes = {"same_letter": F.repeat(F.lit("a"), n), "letters_then_mark": F.concat(F.repeat(F.lit("a"), n - 1), F.lit("!")), "digits_and_dashes": F.substring(F.repeat(F.lit("0-"), n), 1, n), "dots": F.concat(F.repeat(F.lit("a."), F.floor(n / 2).cast("int")))}
    rows = spark.range(1).select(lengths.alias("length"))
    return rows.select(F.explode(F.array(*(F.struct(F.lit(k).alias("shape"), n.alias("length"), v.alias("text")) for k, v in shapes.items()))).alias("r")).select("r.*")


def draws(n: int, count: int, seed: int) -> Iterator[np.ndarray]:
    """What ``count`` calls of ``random.Random(seed).randrange(n)`` give, in blocks: the same
    words of the same generator, shifted and rejected alike, for all calls at once."""
    bits = n.bit_length()
    if not 0 < bits <= 32:
        raise ValueError("n is from 1 to 2**32 - 1")
    words = np.random.MT19937()
    key = random.Random(seed).getstate()[1]
    words.state = {"bit_generator": "MT19937", "state": {"key": np.array(key[:-1], np.uint32), "pos": key[-1]}}
    while count:
        got = words.random_raw(min(CHUNK, 2 * count + 64)).astype(np.uint32) >> np.uint32(32 - bits)
        got = got[got < n][:count]
        count -= len(got)
        yield got.astype(np.int64)


def resampled_sums(values: np.ndarray, resamples: int, seed: int) -> np.ndarray:
    """Column sums of ``resamples`` samples of the rows, with replacement."""
    n, out = len(values), np.zeros((resamples, values.shape[1]))
    done = 0
    for block in draws(n, n * resamples, seed):
        sample = (done + np.arange(len(block))) // n
        for c in range(values.shape[1]):
            out[:, c] += np.bincount(sample, values[block, c], resamples)
        done += len(block)
    return out


def f1_of_sums(sums: np.ndarray) -> np.ndarray:
    """F1 of rows of summed (tp, fp, fn); precision is 1 where nothing fired."""
    tp, fp, fn = sums.T
    with np.errstate(divide="ignore", invalid="ignore"):
        p, r = np.where(tp + fp > 0, tp / (tp + fp), 1.0), np.where(tp + fn > 0, tp / (tp + fn), 0.0)
        return np.where(p + r > 0, 2 * p * r / (p + r), 0.0)


def bca_interval(values: np.ndarray, stat=f1_of_sums, resamples: int = RESAMPLES, seed: int = SEED) -> tuple[float, float] | None:
    """Bias-corrected and accelerated bootstrap interval of 95 % of a statistic of column
    sums; none for fewer than two rows."""
    values = np.asarray(values, float)
    if len(values) < 2:
        return None
    total = values.sum(0)
    seen = float(stat(total[None, :])[0])
    drawn = np.sort(stat(resampled_sums(values, resamples, seed)))
    if drawn[0] == drawn[-1]:
        return seen, seen
    normal = NormalDist()
    share = (drawn < seen).sum() / resamples
    bias = normal.inv_cdf(min(max(share, 1.0 / (resamples + 1)), resamples / (resamples + 1)))
    apart = stat(total - values)
    apart = apart.mean() - apart
    spread = (apart**2).sum()
    skew = (apart**3).sum() / (6.0 * spread**1.5) if spread else 0.0

    def end(alpha: float) -> float:
        z = bias + normal.inv_cdf(alpha)
        p = normal.cdf(bias + z / (1 - skew * z))
        return float(drawn[min(max(int(p * resamples), 0), resamples - 1)])

    return end(0.025), end(0.975)


def bca_by_pool(rows: DataFrame, pool: str, order: str) -> DataFrame:
    """Interval of the pooled F1 over the documents (tp, fp, fn) of each pool. The seeded
    stream runs over a pool's documents in their order, so a pool is one task: 24 bytes a
    document, and its resamples in blocks."""

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by(order)
        docs = np.stack([part[c].to_numpy() for c in ("tp", "fp", "fn")], axis=1)
        found = bca_interval(docs) or (None, None)
        f1 = float(f1_of_sums(docs.sum(0, keepdims=True).astype(float))[0])
        return pa.table({pool: part[pool][:1], "n": pa.array([len(docs)], pa.int64()), "f1": [f1], "low": pa.array([found[0]], pa.float64()), "high": pa.array([found[1]], pa.float64())})

    return rows.select(pool, order, "tp", "fp", "fn").groupBy(pool).applyInArrow(run, f"{pool} string, n long, f1 double, low double, high double")
