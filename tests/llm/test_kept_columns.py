"""Kept columns of any name and type, copies without number, and the join of hot texts."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palate.llm import bpe, language_id, license_scan, pii, secrets, sharding
from tests.llm.cases import awkward

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
OPERATORS = {
    "licenses": lambda docs, kept: license_scan.scan_licenses(docs, kept, spans=True),
    "languages": lambda docs, kept: language_id.predict_languages(docs, {"en": b"the quick brown fox", "fr": b"le renard brun"}, kept),
    "personal": pii.find_personal_data,
    "secrets": secrets.scan_secrets,
    "tokens": lambda docs, kept: bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, kept),
}
CLASHES = (
    "_kept", "_blank", "_place", "_part", "_letters", "_ids", "labels", "lang_pred", "bits", "foreign", "n_tokens", "ids", "detections",
    "extra", "copies", "parts", "rules_", "trigram", "n_words")


@pytest.mark.parametrize("name", OPERATORS)
def test_every_clashing_column_is_kept_or_gives_way(spark, name):
    docs = awkward(spark)
    for clash in CLASHES:
        docs = docs.withColumn(clash, F.lit(f"kept {clash}"))
    docs = docs.withColumn("m", F.create_map(F.lit("a"), F.col("source"))).withColumn("b", F.encode(F.lit("x"), "utf-8"))
    plain = OPERATORS[name](docs.select("doc_id", "text"), ["doc_id"])
    made = [c for c in plain.columns if c != "doc_id"]
    full = OPERATORS[name](docs, docs.columns)
    kept = [c for c in docs.columns if c not in made]
    assert full.columns == [*kept, *made]

    def cells(df, columns):
        return sorted(map(repr, df.select(*columns).collect()))

    assert cells(full, kept) == cells(docs, kept)
    assert cells(full, ["doc_id", *made]) == cells(plain, ["doc_id", *made])


def test_copies_are_dealt_out_in_runs(spark):
    rows = spark.createDataFrame([("a", 5, 23), ("b", 28, 1), ("c", 29, 7), ("d", 36, 8)], "_doc string, first long, copies long")
    dealt = sharding.dealt_out(rows, 7)
    assert sorted((r["_doc"], r.row_no) for r in dealt.collect()) == [
        (doc, n) for doc, first, copies in (("a", 5, 23), ("b", 28, 1), ("c", 29, 7), ("d", 36, 8)) for n in range(first, first + copies)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would put these few rows into one partition
    try:
        hot = spark.createDataFrame([("h", 0, 1000)], "_doc string, first long, copies long")
        assert sharding.dealt_out(hot, 7).select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_shards_and_pipeline_rows_take_map_columns(spark):
    docs = spark.createDataFrame(
        [(1, "same", {"a": 1}), (1, "same", {"a": 1}), (1, "same", {"a": 2}), (1, "same", None), (2, None, {}), (2, None, None)],
        "doc_id long, text string, m map<string,int>")
    held = sharding.placed_rows(docs, 2, 7, "doc_id", "text").collect()
    assert sorted(map(repr, (tuple(r["_doc"]) for r in held))) == sorted(map(repr, map(tuple, docs.collect())))
    assert sorted(r.row_no for r in held) == list(range(6))
    assert corpus_pipeline.carried(docs).select("_row").distinct().count() == 5


def test_a_cell_that_is_null_tells_rows_apart(spark):
    docs = spark.createDataFrame([(None, "x", 1), ("x", None, 1)], "text string, source string, doc_id long")
    assert corpus_pipeline.carried(docs).select("_row").distinct().count() == 2


def test_hot_texts_meet_their_terms_under_several_keys(spark, monkeypatch):
    rows = [(i, f"Zorblatt writes to ann@example.org about it {i // 40 % 2}") for i in range(160)] + [(200 + i, f"plain text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    whole = sorted(map(repr, pii.find_personal_data(docs, ["doc_id"]).collect()))
    assert any("term" in row for row in whole)
    monkeypatch.setattr(pii, "COPIES", 9)
    assert sorted(map(repr, pii.find_personal_data(docs, ["doc_id"]).collect())) == whole
