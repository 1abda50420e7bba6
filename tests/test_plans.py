import dataclasses

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks.common import view
from palate.config import Settings
from palate.operators.features import FEATURE_COLUMNS
from palate.plans.descriptive import descriptive_report, write_descriptive_report
from palate.plans.prepare import prepare_cohort, write_cohort
from palate.plans import train
from palate.plans.search import build_search
from palate.plans.stages import Stages, content_digest
from palate.plans.train import StaticTables, train_recommender, write_recommender
from palate.session import scratch_path
from palate.sources.artifacts import read_artifact, read_report
from palate.sources.jsonl import is_elite

SETTINGS = Settings(
    cities=None, min_user_reviews=2, min_business_reviews=5, als_factors=4, als_iterations=2, n_candidates=15,
    rank_rounds=2, rank_min_rows=5, attribution_rows=50, demo_users=7, encoder_dim=32, n_pairs=200,
)


def text_ids(df):
    """The real inputs have string ids."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("user_id", "business_id") if c in df.columns})


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    businesses = text_ids(view(spark, sf_dir, "businesses"))
    cohort = prepare_cohort(businesses, text_ids(view(spark, sf_dir, "order_reviews")), SETTINGS)
    folder = scratch_path(spark, "cohort")
    write_cohort(cohort, folder)
    interactions = read_artifact(spark, f"{folder}/interactions")
    static = StaticTables(
        cohort.businesses, *[text_ids(view(spark, sf_dir, name)) for name in ("users", "checkins", "tips")])
    return interactions, train_recommender(interactions, static, SETTINGS)


def test_cohort_artifact_is_split(trained):
    interactions, _ = trained
    assert {r.split for r in interactions.select("split").distinct().collect()} == {"train", "valid", "test"}


def test_recommender_outputs(spark, trained):
    interactions, done = trained
    table = done.comparison.collect()
    assert [r.method for r in table] == ["popularity", "als", "two-stage"]
    assert all(0 <= r.ndcg <= 1 and 0 <= r.recall <= 1 and 0 <= r.map <= 1 for r in table)
    assert len({r.n_users for r in table}) == 1 and table[0].n_users > 0
    history = interactions.where("split <> 'test'")
    frame = done.test_frame
    assert set(FEATURE_COLUMNS) <= set(frame.columns)
    assert frame.join(history, ["user_id", "business_id"], "left_semi").count() == 0
    per_user = frame.groupBy("user_id").agg(F.count("*").alias("n"), F.max("cf_rank").alias("hi"))
    assert per_user.where("n <> hi + 1 OR n > 15").count() == 0
    assert done.demo.select("user_id").distinct().count() == 7
    assert {r.feature for r in done.importance.collect()} == set(FEATURE_COLUMNS)
    assert {r.feature for r in done.attribution.collect()} == set(FEATURE_COLUMNS)


def test_recommender_reports(spark, trained):
    _, done = trained
    folder = scratch_path(spark, "reports")
    write_recommender(done, folder)
    schema = ("position int, method string, ndcg double, ndcg_lift_pct double, recall double, recall_lift_pct double, "
              "map double, map_lift_pct double, n_users long")
    assert rows(read_report(spark, f"{folder}/recsys_metrics", schema), "method") == [("als",), ("popularity",), ("two-stage",)]
    assert read_artifact(spark, f"{folder}/test_frame").count() == done.test_frame.count()


def test_training_goes_on_after_the_last_finished_stage(spark, sf_dir, trained, monkeypatch):
    interactions, done = trained
    static = StaticTables(
        text_ids(view(spark, sf_dir, "businesses")), *[text_ids(view(spark, sf_dir, name)) for name in ("users", "checkins", "tips")])
    folder = scratch_path(spark, "stages")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(train, "fit_ranker", lost)
        with pytest.raises(RuntimeError, match="lost"):
            train_recommender(interactions, static, SETTINGS, folder)
    # finished stages must not be computed again: the parts that they call are gone
    with monkeypatch.context() as gone:
        real = train.fit_factors
        calls = []
        gone.setattr(train, "fit_factors", lambda *given: calls.append(1) or real(*given))
        again = train_recommender(interactions, static, SETTINGS, folder)
    assert again.ran[0] == "ranker" and "fit_frame" not in again.ran and len(calls) == 1
    for name in ("fit_factors", "fit_ranker", "als_frame", "rank_ltr", "evaluate_rankings"):
        monkeypatch.setattr(train, name, lost)
    third = train_recommender(interactions, static, SETTINGS, folder)
    assert third.ran == () and third.model.history == again.model.history
    assert third.comparison.collect() == again.comparison.collect()
    # another setting of the booster repeats what reads it, another input everything
    other = dataclasses.replace(SETTINGS, rank_rounds=1)
    with pytest.raises(RuntimeError, match="lost"):
        train_recommender(interactions, static, other, folder)
    with pytest.raises(RuntimeError, match="lost"):
        train_recommender(interactions.where("user_id <> '1'"), static, SETTINGS, folder)


def test_half_written_stages_do_not_count(spark):
    path = scratch_path(spark, "half")
    stages = Stages(spark, SETTINGS, path, rows=spark.range(3))

    def half():
        yield spark.range(2)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        stages.tables("pair", ["one", "two"], half, ["rows"])
    one, two = stages.tables("pair", ["one", "two"], lambda: [spark.range(4), spark.range(5)], ["rows"])
    assert (one.count(), two.count()) == (4, 5)


def test_content_digest_ignores_order_and_sees_every_cell(spark):
    df = spark.createDataFrame(
        [(1, None, {"a": "b"}), (None, 1, None), (1, None, {"a": "b"})], "`x.y` int, z int, m map<string,string>")
    same = content_digest(df)
    assert content_digest(df.repartition(3)) == same
    others = [df.dropDuplicates(["z"]), df.withColumn("z", F.coalesce("z", F.lit(2))), df.select(df["z"].alias("x.y"), F.col("`x.y`").alias("z"), "m"),
              df.withColumn("m", F.lit(None).cast("map<string,string>")), df.where("false"), df.withColumnRenamed("z", "w")]
    assert len({same, *(content_digest(other) for other in others)}) == 7


def test_descriptive_report(spark, sf_dir):
    reviews = view(spark, sf_dir, "reviews").withColumn("date", F.lit("2020-02-03").cast("timestamp"))
    users = view(spark, sf_dir, "users").withColumn("is_elite", is_elite(F.col("elite")))
    report = descriptive_report(text_ids(view(spark, sf_dir, "businesses")), reviews, users)
    folder = scratch_path(spark, "descriptive")
    write_descriptive_report(report, folder)
    assert len(report) == 18
    assert read_report(spark, f"{folder}/polarity", "polarity string, n long").count() == 3


def test_build_search_from_text(spark, sf_dir):
    corpus = view(spark, sf_dir, "reviews").where(F.length("text") >= 40)
    path = scratch_path(spark, "vectors")
    index = build_search(corpus, SETTINGS, path)
    assert spark.read.parquet(f"{path}/vectors").count() == corpus.count() == index.vectors.count()
    report = {r.encoder: r for r in index.report.collect()}
    assert set(report) == {"base", "adapted"} and 0 <= report["base"].mrr <= report["base"].hit <= 1
