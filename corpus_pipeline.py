"""A corpus pipeline: language ID, near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. A stage works on all rows that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm import language_id, minhash, packing, pii, word_bpe
from sievemark.llm.columns import fresh, quoted
from sievemark.llm.storage import Workspace, left_out
from sievemark.session import ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or letters go. A missing
    label is filled with the prediction. If no row has a label, nothing can be
    learned; then all documents with a letter stay as they are."""
    ship_package(spark)
    label, score = fresh(docs, "lang_pred", "score")
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, model, out=(label, score)).where(F.col(label) != language_id.UNDETERMINED)
    return found.withColumn("lang", F.coalesce("lang", label)).select(*map(quoted, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest id (a null
    id counts as the largest). Rows without words stay, each for itself. Rows that
    share an id and differ in text are documents of their own.
    """
    ship_package(spark)
    work = Workspace(spark, "dedup")
    (key,) = fresh(docs, "row_key")
    plain = not docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count()
    # Where ids do not tell rows apart, a hash of id and text does.
    keyed = docs.withColumn(key, F.col("doc_id").cast("long") if plain else F.xxhash64("doc_id", "text"))
    groups = minhash.near_duplicates(keyed, key=key, words=5, percent=80).where("n_shingles > 0")
    if plain:
        lost = work.write(groups.where("NOT kept").select("id"), "lost")
    else:
        groups = work.write(groups.select("id", "component_id").distinct(), "groups")
        named = groups.join(keyed.select(F.col(key).alias("id"), "doc_id").distinct(), "id")
        first = named.groupBy("component_id").agg(F.min_by("id", F.struct(F.col("doc_id").isNull(), "doc_id", "id")).alias("first"))
        lost = work.write(groups.join(first, "component_id").where("id != first").select("id"), "lost")
    # Texts move for an anti-join only where their key may be a lost one.
    kept = left_out(keyed, lost, key)
    if not plain:
        repeated = groups.select("id").join(keyed.groupBy(key).count().where("count > 1").select(F.col(key).alias("id")), "id")
        repeated = work.write(repeated, "repeated")
        once = kept.join(repeated.withColumnRenamed("id", key), key, "left_semi").dropDuplicates([key])
        kept = left_out(kept, repeated, key).unionByName(once)
    return kept.select(*map(quoted, docs.columns))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each personal span replaced by its kind; ``n_chars`` follows."""
    ship_package(spark)
    (spans,) = fresh(docs, "spans")
    found = pii.detect(docs, out=spans, redact_to="text")
    length = F.when(F.size(spans) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*map(quoted, docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048 tokens."""
    ship_package(spark)
    return packing.pack(docs, word_bpe.default_path())


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express tokenizing, so the stages are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
