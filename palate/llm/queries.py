"""One registered query per operator over its whole table, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palate.llm import ann_hnsw, bpe, decontaminate, importance, jaccard_join, language_id, license_scan, merkle, oracles, pii, secrets, sharding, whitening, winnowing
from palate.llm.common import joined_spans, table


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"), ["doc_id"])


def nearest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann_hnsw.nearest_neighbours(rows, rows.where(F.col("vec_id") % 100 == 0))


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = language_id.training_texts(docs)
    predicted = language_id.predict_languages(docs, texts, ["doc_id"])
    return predicted.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits")


def leaks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def importance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id", *map(count_of, pii.KINDS),
        F.sha2(joined_spans(F.filter("spans", lambda s: s["order"] < len(pii.KINDS))), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"))


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    kinds = [rule.kind for rule in secrets.RULES[:3]]
    return found.select(
        "doc_id", *map(count_of, kinds),
        F.sha2(joined_spans(F.filter("spans", lambda s: s["order"] < len(kinds))), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"))


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        ["doc_id"], digests=True)


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))


def fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_sequence(table(spark, sf_dir, "documents"))


def manifest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    return merkle.manifest(docs, presented={"text": text}).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_license_scan": license_query,
    "op2_hnsw": nearest_query,
    "op3_language_id": language_query,
    "op4_pii": pii_query,
    "op5_decontamination": leaks_query,
    "op6_importance_resampling": importance_query,
    "op7_secrets": secrets_query,
    "op8_jaccard_join": jaccard_query,
    "op9_byte_bpe": bpe_query,
    "op10_feistel_shards": sharding_query,
    "op11_winnowing": fingerprint_query,
    "op12_merkle_manifest": manifest_query,
    "op13_jacobi_davidson": whitening_query,
}

ORACLES = {
    "op1_license_scan": oracles.license_sql(), "op4_pii": oracles.PERSONAL, "op7_secrets": oracles.SECRETS, "op8_jaccard_join": oracles.JACCARD,
    "op10_feistel_shards": oracles.shards_sql(), "op11_winnowing": oracles.fingerprint_sql(), "op12_merkle_manifest": oracles.manifest_sql(),
}
