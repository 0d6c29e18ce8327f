"""Sinks: canonical JSON, lock files, manifests, and single files replaced at once."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from pathlib import Path

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical_json(value) -> bytes:
    """Sorted keys, two spaces, no escapes beyond the needed, a line feed at the end."""
    return (json.dumps(value, sort_keys=True, indent=2, separators=(",", ": "), ensure_ascii=False) + "\n").encode()


def replace_file(path: str | Path, data: bytes) -> None:
    """Write a local file so that readers see the old or the new one, never a part."""
    path = Path(path)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def lock_text(rows: DataFrame) -> str:
    """Lines ``path  sha256`` in order of the path, of a table of artifacts."""
    return "".join(f"{r['rel_path']}  {r['sha256']}\n" for r in rows.select("rel_path", "sha256").orderBy("rel_path").toLocalIterator())


def manifest(assets: dict[str, bytes], version: str = "1.1.0") -> bytes:
    """Canonical JSON with each asset's digest and size."""
    listed = [{"path": p, "sha256": hashlib.sha256(d).hexdigest(), "bytes": len(d)} for p, d in sorted(assets.items())]
    return canonical_json({"version": version, "assets": listed})


def filter_manifest(filters: list[dict], seed: int, built_at: str, version: str = "1.0.0", algorithm: str = "murmur3_x64_128") -> dict:
    """What a set of Bloom filters is: each with name, type, n, m, k, fprTarget, sources."""
    names = ("name", "type", "n", "m", "k", "fprTarget", "sources")
    return {"version": version, "hashAlgorithm": algorithm, "seed": seed, "filters": [{k: f[k] for k in names} | {"builtAt": built_at} for f in filters]}


def shipped_manifest(base: dict, assets: DataFrame, version: str = "1.1.0") -> bytes:
    """``base`` with a version and the digests and sizes of assets (path, sha256, bytes), few
    by nature, in order of path."""
    rows = assets.select("path", "sha256", "bytes").orderBy("path").collect()
    return canonical_json(base | {"version": version, "assets": [r.asDict() for r in rows]})


def write_shards(rows: DataFrame, path: str, shard: str, line: str) -> None:
    """One folder of gzip text for each shard, written by one task each."""
    rows.select(shard, line).repartition(shard).sortWithinPartitions(shard, line).write.partitionBy(shard).option("compression", "gzip").mode("overwrite").text(path)


def shard_metadata(files: DataFrame, commit: str) -> DataFrame:
    """(shard, sha256, content_sha256, bytes, commit) of gzip shards (path, content)."""

    def run(batches):
        import gzip

        import pyarrow as pa

        for batch in batches:
            data = batch.column(1).to_pylist()
            digest = lambda f: pa.array([hashlib.sha256(f(d)).hexdigest() for d in data])
            yield pa.RecordBatch.from_arrays([batch.column(0), digest(lambda d: d), digest(gzip.decompress), pa.array([len(d) for d in data], pa.int64())], names=["shard", "sha256", "content_sha256", "bytes"])

    return files.select("path", "content").mapInArrow(run, "shard string, sha256 string, content_sha256 string, bytes long").withColumn("commit", F.lit(commit))


def cached(spark: SparkSession, folder: str, fingerprint: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``build`` gives, kept as Parquet under the fingerprint of its sources and
    read again while that does not change. A folder without Spark's mark of success counts as
    none; the columns and rows that are read are those that were written."""
    path = f"{folder.rstrip('/')}/_ingest_cache/{fingerprint}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_sorted(rows: DataFrame, path: str, keys: list[str], form: str = "parquet") -> None:
    """Write rows in global order of ``keys``: files in order of name hold rising ranges."""
    rows.orderBy(*keys).write.mode("overwrite").format(form).save(path)


def write_json_lines(rows: DataFrame, path: str, keys: list[str]) -> None:
    """One JSON object a row in order of ``keys``, fields in order of name, nulls written."""
    line = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    rows.orderBy(*keys).select(line.alias("value")).write.mode("overwrite").text(path)
