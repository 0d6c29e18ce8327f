"""Tables written between the steps of an operator.

A long plan is cut by writing Parquet into the folder that the cluster shares
(``spark.checkpoint.dir``), so a lost executor costs only the step at hand.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import fresh, quoted

#: Bits of a lookup map for each id, and at most in a map (a million words of 64).
BITS_EACH, MOST_BITS = 64, 1 << 26
#: Rows of a few numbers in a file.
FILE_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; only where that is
    unset (tests, one machine) a temporary folder is made and set."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    if not base:
        base = tempfile.mkdtemp(prefix="sievemark-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def make_dir(spark: SparkSession, path: str) -> None:
    system, at = _system(spark, path)
    system.mkdirs(at)


def delete(spark: SparkSession, path: str) -> None:
    system, at = _system(spark, path)
    system.delete(at, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        with contextlib.suppress(Exception):  # the session may be gone already
            delete(spark, path)


class Workspace:
    """A folder of its own for one run of one operator.

    What an operator returns may read its tables at any later time, so what it does
    not drop itself is deleted when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/sievemark/{name}-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(_delete_at_exit, spark, self.path)

    def fresh(self, name: str) -> str:
        self._n += 1
        return f"{self.path}/{self._n:03d}-{name}"

    def write(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write ``df`` and return the written table. Where it is known that there are at
        most so many ``rows``, small ones go to as few files as they need."""
        path = self.fresh(name)
        if rows is not None:
            df = df.coalesce(1 + rows // FILE_ROWS)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._sievemark_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that no later step reads."""
        for table in tables:
            delete(self.spark, table._sievemark_path)


def _placed(df: DataFrame, ids: DataFrame, key: str, how: str) -> tuple[DataFrame, Column]:
    """``df`` joined to a map of bits of the ids, and whether a row's bit is set."""
    few = ids.toDF("k").distinct().where("k IS NOT NULL")
    bits, n = 1 << 10, few.count()
    while bits < min(MOST_BITS, BITS_EACH * n):
        bits *= 2
    place = lambda k: F.pmod(F.xxhash64(k), F.lit(bits))
    place_, word, set_ = fresh(df, "_place", "_word", "_bits")
    words = few.select(place(F.col("k")).alias("p")).groupBy(F.shiftright("p", 6).alias(word)).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias(set_))
    placed = df.withColumn(place_, place(quoted(key))).withColumn(word, F.shiftright(place_, 6))
    hit = F.expr(f"shiftrightunsigned({set_}, cast({place_} & 63 AS int)) & 1L") == 1
    return placed.join(F.broadcast(words), word, how), hit


def among(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The rows of ``df`` whose ``key`` may be one of ``ids`` (longs, one column), for a
    join that follows: all those that are, and a few others.

    The ids become a map of bits, which alone is broadcast: at most a million words,
    however many ids there are. So wide rows are left out where they are read and
    only the rest is moved. Beyond some 10 million ids the map fills up and more rows
    pass.
    """
    placed, hit = _placed(df, ids, key, "inner")
    return placed.where(hit).select(*map(quoted, df.columns))


def left_out(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is none of ``ids``, exactly. Rows whose bit is
    not set stay where they are; the others go through an anti-join."""
    placed, hit = _placed(df, ids, key, "left")
    mine = [quoted(c) for c in df.columns]
    sure = placed.where(~F.coalesce(hit, F.lit(False))).select(*mine)
    rest = placed.where(F.coalesce(hit, F.lit(False))).select(*mine).join(ids.toDF(key).distinct(), key, "left_anti")
    return sure.unionByName(rest)


def slices(values: list, weights: list[int], most: int):
    """Consecutive (start, end) ranges whose weights sum to at most ``most``;
    a single heavier value stands alone."""
    start = total = 0
    for i, w in enumerate(weights):
        if i > start and total + w > most:
            yield start, i
            start, total = i, 0
        total += w
    if start < len(values):
        yield start, len(values)
