"""The stateless detectors over a stream: an extension beside the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.detectors import masked, scan


def detect_stream(stream: DataFrame, out: str, checkpoint: str, text: str = "text", kinds: tuple[str, ...] = ("email", "phone", "creditCard")) -> StreamingQuery:
    """Masked matches of each micro-batch, appended to a table of files."""
    found = scan(stream, text, kinds).withColumn("value", masked(F.col("value")))
    return found.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).outputMode("append").trigger(availableNow=True).start()
