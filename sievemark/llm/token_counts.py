"""Documents of flat token files, found by their separators.

A token file is nothing but ids, little-endian, one after another, each document
ended by the end-of-document id; there is no index. A file is read in blocks of
fixed size, in parallel. Each block is searched for separators at once; what it
has before its first and after its last one is stitched by a prefix scan over the
blocks of the file, so a document may span any number of blocks.

Files are reached through pyarrow's file systems (local, S3, GCS, HDFS ...), at
the address that Spark's own listing gives.

Defined results: two separators in a row end an empty document; tokens after a
file's last separator are a document that is not ended; an empty file has none; a
null text is written as an empty document, a repeated row once more; an empty table
makes an empty folder, which holds no documents; a file whose size is no multiple of
the id's width fails the scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .columns import give_back, quoted
from .storage import Workspace, make_dir
from .word_bpe import encoder

#: Ids in a block; blocks in a run of the prefix scan.
BLOCK, RUN = 1 << 20, 1 << 12


def _open(path: str):
    """(file system, path in it) of an address or a local path."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_token_files(df: DataFrame, path: str, vocabulary: str, end_id: int, dtype: str = "<u2", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write one token file for each partition of ``df`` into ``path``; gives
    (file, ordinal, doc_id) of every document, to be written by the caller.

    A task writes under a name of its own and renames at its end, so a repeated
    task leaves the same file.
    """
    make_dir(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.bin"
        encode, end, n, out = encoder(vocabulary, plain_specials=True).encode, np.array([end_id], dtype).tobytes(), 0, None
        for batch in batches:
            if out is None and batch.num_rows:
                store, folder = _open(path)
                store.create_dir(folder, recursive=True)
                temporary = f"{folder}/_{name}.{task.taskAttemptId()}"
                out = store.open_output_stream(temporary)
            for value in batch.column(1):
                ids = encode(value.as_py() or "")
                out.write(np.frombuffer(ids, "<u4").astype(dtype).tobytes() + end)
            yield pa.RecordBatch.from_arrays([pa.array([name] * batch.num_rows, pa.string()), pa.array(np.arange(n, n + batch.num_rows)), batch.column(0)], names=["file", "ordinal", "doc_id"])
            n += batch.num_rows
        if out is not None:
            out.close()
            store.move(temporary, f"{folder}/{name}")
        give_back()

    return df.select(quoted(key).cast("long").alias("doc_id"), quoted(text).alias("text")).mapInArrow(run, "file string, ordinal long, doc_id long")


def scan_block(ids: np.ndarray, end_id: int) -> tuple[int, int, list[int]]:
    """(ids before the first separator, ids after the last, lengths between); with
    no separator, all ids come before it and none after."""
    at = np.flatnonzero(ids == end_id)
    if not len(at):
        return len(ids), 0, []
    return int(at[0]), len(ids) - int(at[-1]) - 1, (np.diff(at) - 1).tolist()


def count_tokens(spark: SparkSession, path: str, end_id: int, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """(file, ordinal, n_tokens, ended) of each document in the token files of ``path``.

    What a block has inside is written beside its few summary numbers. The prefix
    scan reads the summaries alone, over runs of ``RUN`` blocks first and then inside
    each run, so that one endless file is neither one task nor one sort.
    """
    width = np.dtype(dtype).itemsize
    work = Workspace(spark, "blocks")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path).select("path", "length").where("length > 0")
    blocks = files.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / (block * width)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["length"] % width:
                    raise ValueError(f"{row['path']}: its size is no multiple of {width}")
                store, name = _open(row["path"])
                with store.open_input_file(name) as f:
                    data = f.read_at(min(block * width, row["length"] - row["block"] * block * width), row["block"] * block * width)
                ids = np.frombuffer(data, dtype)
                head, tail, inner = scan_block(ids, end_id)
                ends = len(inner) + 1 if head < len(ids) else 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]]), pa.array([row["block"]], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([head], pa.int64()), pa.array([tail], pa.int64()), pa.array([ends], pa.int64()), pa.array([inner], pa.list_(pa.int64())), pa.array([row["block"] == (row["length"] - 1) // (block * width)])],
                    names=["path", "block", "n", "head", "tail", "ends", "inner", "last"],
                )

    spread = blocks.repartition("path", "block")
    seen = work.write(spread.mapInArrow(run, "path string, block long, n long, head long, tail long, ends long, inner array<long>, last boolean"), "seen")
    light = seen.select("path", "block", F.floor(F.col("block") / RUN).alias("run"), "n", "ends", F.when(F.col("ends") > 0, F.col("block") * block + F.col("n") - F.col("tail")).alias("open_from"))
    before = Window.partitionBy("path").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("path", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"n": F.sum, "ends": F.sum, "open_from": F.max}
    runs = light.groupBy("path", "run").agg(*(f(c).alias(c) for c, f in sums.items())).select("path", "run", *(f(c).over(before).alias(f"run_{c}") for c, f in sums.items()))
    scanned = light.select("path", "run", "block", *(f(c).over(inside).alias(f"in_{c}") for c, f in sums.items())).join(runs, ["path", "run"])
    total = lambda c: F.coalesce(f"run_{c}", F.lit(0)) + F.coalesce(f"in_{c}", F.lit(0))
    placed = scanned.select("path", "block", total("ends").alias("ordinal"), (total("n") - F.coalesce("in_open_from", "run_open_from", F.lit(0))).alias("carried"))
    # A merge join by hint: the lists pack so well that their size on disk says little.
    both = seen.hint("merge").join(placed, ["path", "block"])
    lengths = F.when(F.col("ends") > 0, F.concat(F.array(F.col("carried") + F.col("head")), F.col("inner"))).otherwise(F.array().cast("array<long>"))
    rest = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("n"))
    left = F.when(F.col("last") & (rest > 0), F.array(rest)).otherwise(F.array().cast("array<long>"))
    found = both.select(F.element_at(F.split("path", "/"), -1).alias("file"), "ordinal", "ends", F.posexplode(F.concat(lengths, left)).alias("k", "n_tokens"))
    return found.select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "n_tokens", (F.col("k") < F.col("ends")).alias("ended"))
