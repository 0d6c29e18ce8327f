"""Content-addressed web archive.

An archive is two Parquet tables in one folder. ``payloads`` holds each distinct
payload once, under its SHA-256; ``records`` holds for every capture its key, the
exact bytes of its WARC/1.1 header block and the digest of its payload. Record ids
are unique: they name the capture, not its key. The digest of a
stored payload is computed anew whenever it is read, and a mismatch fails the
read. Original records come back through a join of the two.

Defined results: a null payload is the empty one, a null address gives a record
without target; captures without an id come last among equal payloads; repeated
rows are captures of their own, and equal payloads with the same smallest id are
all responses; an empty table makes an empty archive. Columns of the input other
than the three named ones are not archived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import quoted
from .storage import Workspace

#: RFC 4648's base32 letters for the digits of radix 32, and the standard's profile name.
_RADIX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: ten hex digits are eight of radix 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _RADIX32, _BASE32)


def record_id(archive: str, capture: Column) -> Column:
    """A name-based urn:uuid of a capture's number in an archive."""
    h = F.sha2(F.concat(F.lit(f"{archive}/"), capture.cast("string")).cast("binary"), 256)
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-5"), cut[2], F.lit("-a"), cut[3], F.lit("-"), cut[4], F.lit(">"))


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html", date: str = "2024-01-01T00:00:00Z", least: int = 0) -> None:
    """Archive every row of ``pages`` in the folder ``path``.

    Of the rows with equal payloads of at least ``least`` bytes the one with the
    smallest key is the response and the others are revisits of it; smaller ones
    are all responses. Only digests, keys and lengths are grouped and joined;
    payloads are shuffled once, each distinct one of a partition.
    """
    work = Workspace(pages.sparkSession, "captures")
    payload = F.coalesce(quoted(body).cast("binary"), F.lit(b""))
    rows = pages.select(quoted(key).alias("key"), quoted(url).alias("url"), payload.alias("payload"))
    light = rows.select("key", "url", F.sha2("payload", 256).alias("sha256"), base32_sha1(F.col("payload")).alias("sha1"), F.length("payload").cast("long").alias("bytes"))
    # Written, so that a capture's number is the same wherever it is read.
    light = work.write(light.withColumn("capture", F.monotonically_increasing_id()), "captures")
    first = light.where(F.col("bytes") >= least).groupBy("sha256").agg(F.min_by(F.struct("key", "capture"), F.struct(F.col("key").isNull(), "key", "capture")).alias("first"))
    joined = light.join(first, "sha256", "left")
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first.key"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(work.path, F.col("capture"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", record_id(work.path, F.col("first.capture"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    joined.select("key", header.cast("binary").alias("header"), "sha256").write.parquet(f"{path}/records")
    work.drop(light)
    distinct = rows.select(F.sha2("payload", 256).alias("sha256"), "payload").dropDuplicates(["sha256"])
    distinct.write.option("compression", "zstd").parquet(f"{path}/payloads")


def _field(name: str) -> Column:
    return F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r\n]*)", 1)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Each record's key, header fields, and the length and digest of its payload.

    The type, the digest, the target and the record referred to come from the stored
    header bytes; the payload is read and digested again, and a record whose header or
    address names another digest than the payload has fails the query, as does a
    revisit of no response.
    """
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads")
    checked = payloads.select("sha256", F.sha2("payload", 256).alias("again"), F.length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    kind, own, to = (_field(f"WARC-{x}") for x in ("Type", "Record-ID", "Refers-To"))
    rows = records.select("key", "sha256", kind.alias("record_type"), _field("WARC-Target-URI").alias("target"), _field("WARC-Payload-Digest").alias("named"), F.when(kind == "revisit", to).otherwise(own).alias("to"))
    # A response is joined to itself, so no key is shared by all rows without a reference.
    responses = records.where(kind == "response").select(own.alias("to"), F.struct(F.col("key")).alias("meant"))
    both = rows.join(responses, "to", "left").join(checked, "sha256", "left")
    sound = (F.col("again") == F.col("sha256")) & (F.col("named") == F.concat(F.lit("sha1:"), F.col("payload_digest"))) & F.col("meant").isNotNull()
    digest = F.when(sound, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("archive: payload does not match its digest, or its response is missing: "), F.col("sha256"))))
    refers_to = F.when(F.col("record_type") == "revisit", F.col("meant.key"))
    return both.select("key", "payload_bytes", digest.alias("payload_digest"), "record_type", refers_to.alias("refers_to"), "target", "sha256")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(key, record): the original records byte for byte, header block, payload
    and the two line ends. A revisit's block is empty, so payloads join only
    responses, one row each."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads")
    end = F.lit(b"\r\n\r\n")
    revisit = _field("WARC-Type") == "revisit"
    whole = records.where(~revisit).join(payloads, "sha256").select("key", F.concat("header", "payload", end).alias("record"))
    bare = records.where(revisit).select("key", F.concat("header", end).alias("record"))
    return whole.unionByName(bare)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the records back."""
    work = Workspace(pages.sparkSession, "warc")
    path = work.fresh("archive")
    write_archive(pages, path, **options)
    return read_index(pages.sparkSession, path)
