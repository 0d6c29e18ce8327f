"""Session helpers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(app: str = "sievemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that results rely on: UTC, ANSI and adaptive plans."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    return builder.config(map=settings).getOrCreate()


#: Rows in an Arrow batch: texts may be long, and each task holds some batches outside the heap.
ARROW_ROWS = 2_000


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once for an application, and keep
    the session's Arrow batches small (a smaller setting of its own stays)."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, ARROW_ROWS)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).resolve().parent
        with tempfile.TemporaryDirectory() as folder:
            copy = Path(folder) / "tree" / package.name
            shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
            keep = tempfile.mkdtemp(prefix="sievemark-ship-")
            spark.sparkContext.addPyFile(shutil.make_archive(f"{keep}/sievemark", "zip", copy.parent, package.name))
    return spark
