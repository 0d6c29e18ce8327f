"""Queries: hashing, Bloom filters, generators, context features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import validators as V
from ..functions.context import match_features
from ..functions.detectors import REGISTRY, hits
from ..functions.detectors import rule_catalog as catalog
from ..operators import bloom, corpus, generate, hostile, values
from .registry import query, table


@query("""WITH p AS (SELECT (p_partkey * 37 + i * 101) % 10007 AS pos FROM part, range(4) r(i)) SELECT pos // 64 AS word_idx, bit_or(CASE WHEN pos % 64 = 63 THEN (-9223372036854775807 - 1)::BIGINT ELSE (1::BIGINT << (pos % 64)::INTEGER) END) AS word FROM p GROUP BY 1""")
def bloom_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given positions OR-ed into 64-bit words."""
    at = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.col("p_partkey") * 37 + i * 101) % 10007)
    return bloom.or_words(table(spark, sf_dir, "part").select(F.explode(at).alias("pos")), "pos")


@query()
def rsbf_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed filter of the part names: sizes, header and digest."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    built = bloom.build(names, "p_name")
    data = bloom.pack(built, bloom.digest(names, "p_name"))
    found = bloom.probe(table(spark, sf_dir, "part").select("p_name"), "p_name", built).agg(F.count_if("hit").alias("n_hits"))
    return found.select("n_hits", F.lit(built.m).alias("m"), F.lit(built.rows).alias("n_rows"), F.lit(len(data)).alias("n_bytes"), F.lit(data[: bloom.HEADER].hex()).alias("header"))


@query("""WITH t AS (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[0-9]{5,}')) AS v, lang FROM documents) SELECT coalesce(lang, 'none') AS lang, count(*) AS n_runs, max(length(v)) AS longest FROM t GROUP BY 1""")
def negative_digit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of five digits or more, which a benign corpus must not have."""
    found = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("none")).alias("lang"), F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[0-9]{5,}"), F.lit(0))).alias("v"))
    return found.groupBy("lang").agg(F.count("*").alias("n_runs"), F.max(F.length("v").cast("long")).alias("longest"))


@query("""WITH n AS (SELECT (8 * 2 ** i)::INTEGER AS length FROM range(8) r(i)) SELECT shape, length, sha256(text) AS digest FROM (SELECT 'same_letter' AS shape, length, repeat('a', length) AS text FROM n UNION ALL SELECT 'letters_then_mark', length, repeat('a', length - 1) || '!' FROM n UNION ALL SELECT 'digits_and_dashes', length, repeat('0-', length)[1:length] FROM n UNION ALL SELECT 'dots', length, repeat('a.', length // 2) FROM n)""")
def redos_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ladder of hostile inputs."""
    return generate.redos_ladder(spark).select("shape", "length", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query()
def corpus_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled corpus under each profile, by template and bucket, and what breaks its rules."""
    planned = corpus.plan(spark)

    def counted(profile: str) -> DataFrame:
        docs = corpus.corpus(planned, profile)
        broken = corpus.assembly_violations(docs).groupBy("id").agg(F.count("*").alias("broken"))
        joined = docs.join(broken, "id", "left")
        sums = [F.count("*").alias("n"), F.sum(F.size("pii_spans")).alias("n_spans"), F.sum(F.size("furniture")).alias("n_furniture"), F.count("broken").alias("n_broken"), F.sum(F.crc32(F.col("text").cast("binary"))).alias("checksum")]
        return joined.groupBy(F.lit(profile).alias("profile"), "template", "bucket").agg(*sums)

    parts = [counted(p) for p in corpus.PROFILES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query()
def vector_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test vectors of the 15 families by reason, and how many the validators judge alike."""
    rows = spark.createDataFrame(values.vectors(generate.SEED), "family string, value string, valid boolean, reason string")
    v, family = F.col("value"), F.col("family")
    part = lambda i: F.split_part("value", F.lit("/"), F.lit(i)).try_cast("int")
    structural = {"ssn": V.ssn_reason(v), "itin": V.itin_reason(v), "npi": V.npi_reason(v), "dea": V.dea_reason(v), "creditCard": V.card_reason(v), "routingNumber": V.aba_reason(v), "ein": F.when(~V.ein_ok(v), "shape"), "dateOfBirth": V.dob_reason(part(1), part(2), part(3))}
    judged = F.lit(None).cast("string")
    for name, reason in structural.items():
        judged = F.when(family == name, reason).otherwise(judged)
    for name in set(values.VECTORS) - set(structural):
        judged = F.when(family == name, F.when(F.size(hits(v, name)) == 0, "shape")).otherwise(judged)
    return rows.withColumn("judged", judged).groupBy("family", "reason").agg(F.count("*").alias("n"), F.count_if(F.col("judged").eqNullSafe(F.col("reason"))).alias("n_alike"))


@query("""WITH d AS (SELECT i AS id FROM range(150) r(i)) SELECT 'benign_' || lpad(id::VARCHAR, 3, '0') AS id, 0 AS n_runs FROM d""")
def benign_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benign corpus and its runs of five digits, of which there are none."""
    return corpus.benign(spark).select("id", F.regexp_count("text", F.lit("[0-9]{5}")).alias("n_runs"))


@query("""SELECT kind, count(*) AS n FROM (SELECT ['byte_flip', 'truncation', 'xref_damage', 'bad_length'][(i % 4 + 1)] AS kind FROM range(64) r(i)) GROUP BY 1""")
def pdf_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged copies of a small PDF by kind; only those that differ from it count."""
    source = b"%PDF-1.4\n1 0 obj\n<< /Length 11 >>\nstream\nhello world\nendstream\nendobj\nxref\n0 2\n0000000000 65535 f \n0000000009 00000 n \ntrailer\n<< /Size 2 >>\nstartxref\n80\n%%EOF\n"
    made = hostile.mutations(spark, source, 7)
    return made.where(F.col("content") != F.lit(source)).groupBy("kind").agg(F.count("*").alias("n"))


@query("""SELECT * FROM (VALUES ('context_swap', 2, 2), ('detector_shape_fp', 3, 3), ('furniture_overlap', 2, 2), ('keyword_stuffing', 2, 2), ('layout_split', 2, 2), ('name_collision', 2, 1), ('unicode_confusable', 2, 2)) t(category, n, n_detectors)""")
def adversarial_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adversarial table by category."""
    return hostile.adversarial(spark).groupBy("category").agg(F.count("*").cast("int").alias("n"), F.countDistinct("detector").cast("int").alias("n_detectors"))


@query("""SELECT 21::BIGINT AS n_rules, 4::BIGINT AS n_gated, 15::BIGINT AS n_patterns""")
def rule_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of rules: how many, how many behind a checksum, how many with a pattern."""
    return catalog(spark).agg(F.count("*").alias("n_rules"), F.count_if("is_checksum_gated").alias("n_gated"), F.count("pattern").alias("n_patterns"))


@query()
def bca_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bootstrap intervals of F1 over the users of each event type."""
    hit, fired = F.col("user_id") % 3 == 0, F.col("value") > 100
    rows = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count_if(hit & fired).alias("tp"), F.count_if(~hit & fired).alias("fp"), F.count_if(hit & ~fired).alias("fn"))
    return generate.bca_by_pool(rows, "event_type", "user_id")


@query()
def context_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every phone number in the documents."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("id"), "text", F.lit("generic").alias("doctype"))
    return match_features(docs, "phone", REGISTRY["phone"].pattern, (["phone", "tel", "call", "the"], ["case no", "invoice"]))
