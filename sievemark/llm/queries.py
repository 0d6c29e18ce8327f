"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, language_id, license_scan, minhash, packing, pii, sentence_pieces, token_counts, topk, warc, word_bpe
from .oracles import ORACLES
from .storage import Workspace

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages and read the records back."""
    index = warc.round_trip(_table(spark, sf_dir, "pages"))
    return index.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 85 % of their 3-word shingles."""
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.withColumnRenamed("id", "doc_id")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    found = license_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array_join(F.transform("matches", lambda m: m["license"]), ",")
    return found.select("doc_id", F.size("matches").cast("long").alias("n_licenses"), names.alias("licenses"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of all documents; a third of the ids teaches nothing."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    model = language_id.fit(docs, where=~held_out)
    return language_id.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), word_bpe.default_path())


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.digest_columns(pii.detect(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into pieces and decode them again."""
    import public_tokenizers

    pieces = sentence_pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("was"))
    coded = sentence_pieces.encode(docs, pieces).drop("text")
    back = sentence_pieces.decode(coded, pieces)
    digest = F.crc32(F.array_join("ids", ",").cast("binary"))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), digest.alias("ids_crc32"), (F.sha2(F.col("decoded").cast("binary"), 256) == F.col("was")).alias("round_trip"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as flat token files, then count their tokens there."""
    work, end_id = Workspace(spark, "tokens"), 49_407  # the vocabulary's end of text
    path = work.fresh("files")
    written = work.write(token_counts.write_token_files(_table(spark, sf_dir, "documents"), path, word_bpe.default_path(), end_id), "written")
    counted = token_counts.count_tokens(spark, path, end_id)
    # A merge join by hint: the written table packs so well that its size on disk says little.
    return written.hint("merge").join(counted, ["file", "ordinal"], "left").select("doc_id", "n_tokens", "ended")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every hundredth."""
    rows = _table(spark, sf_dir, "embeddings")
    return topk.search(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of vectors at a cosine of 0.95."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_warc, op2_minhash, op3_license_scan, op4_language_id, op5_best_fit_packing, op6_pii, op7_sentencepiece, op8_token_counts, op9_topk, op10_embedding_dedup)}

__all__ = ["ORACLES", "QUERIES"]
