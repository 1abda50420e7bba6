"""The corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.llm import bpe, decontaminate, jaccard_join, language_id, secrets
from palate.llm.common import row_hash, sized_broadcast, table, written

# SQL has neither automata nor a rank queue; the stages are tested against brute force instead.
ORACLE_SQL = None


def carried(docs: DataFrame) -> DataFrame:
    """doc_id and text, the whole row as _doc, so that no column of it can clash, and _row, a hash equal rows share."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_doc"), row_hash(docs).alias("_row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those that fit none of the languages learnt from the labelled ones."""
    predicted = language_id.predict_languages(carried(docs), language_id.training_texts(docs), ["_doc"])
    return predicted.where((F.col("lang_pred") != language_id.UNDECIDED) & ~F.col("foreign")).select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of the 5-word Jaccard join at 0.8: that of the smallest (doc_id, row hash)."""
    marked = carried(docs)
    keyed = marked.select("text", F.struct("doc_id", F.col("_row").alias("row")).alias("_key"))
    joined = written(jaccard_join.jaccard_components(keyed, key="_key"), "components")
    kept = joined.where("_key = component_id").groupBy("_key").agg(F.count(F.lit(1)).alias("copies"))
    once = kept.where("copies = 1").select(F.col("_key.row").alias("_row"))
    more = kept.where("copies > 1").select(F.col("_key.row").alias("_row"))
    single = marked.join(sized_broadcast(once), "_row", "left_semi")
    if not more.isEmpty():
        single = single.union(marked.join(sized_broadcast(more), "_row", "left_semi").dropDuplicates(["_row"]))
    return single.select("_doc.*")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item or a paraphrase of one."""
    marked = carried(docs)
    leaks = decontaminate.find_leaks(marked, table(spark, sf_dir, "benchmark"), key="_row")
    return marked.join(sized_broadcast(written(leaks.select("_row").distinct(), "leaks")), "_row", "left_anti").select("_doc.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts by its kind; all documents stay, n_chars follows the text."""
    scanned = secrets.scan_secrets(carried(docs), ["_doc"])
    found = F.size("spans") > 0
    text = F.when(found, secrets.redacted(F.col("_doc.text"), F.col("spans"))).otherwise(F.col("_doc.text"))
    marked = scanned.select("_doc", found.alias("found"), text.alias("text"))
    size = F.when(F.col("found"), F.length("text").cast("long")).otherwise(F.col("_doc.n_chars"))
    return marked.select(*[
        F.col("text") if c == "text" else size.alias(c) if c == "n_chars" else F.col("_doc")[c].alias(c) for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, and whether they decode to its text; columns of those names are replaced."""
    columns = [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "round_trip")]
    encoded = bpe.encode_documents(
        docs.select("text", F.struct(*columns).alias("_doc")), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, ["_doc"])
    return encoded.select("_doc.*", "n_tokens", "ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
