from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from checks.common import view
from palate.operators import cohort

SCHEMA = "user_id string, business_id string"


def test_dining_filter_is_a_case_sensitive_substring_test(spark):
    labels = ["Restaurants, Thai", "Fast Food", "Seafood", None, ""]
    df = spark.createDataFrame(list(enumerate(labels)), "business_id int, categories string")
    assert rows(cohort.dining_filter(df), "business_id") == [(0,), (1,)]


def test_select_businesses_by_list_and_by_volume(spark):
    data = [(i, city, "Food", "4", "x") for i, city in enumerate("aaabbcd")]
    df = spark.createDataFrame(data, "business_id int, city string, categories string, stars string, review_count string")
    assert rows(cohort.select_businesses(df, cities=["b", "d"]), "city", "stars", "review_count") == [
        ("b", 4.0, None), ("b", 4.0, None), ("d", 4.0, None)]
    assert {r.city for r in cohort.select_businesses(df, n_auto=2).collect()} == {"a", "b"}


def test_cohort_reviews_keeps_only_the_text_length(spark):
    reviews = spark.createDataFrame(
        [("u", "b", 4.0, None, "hé\n", 2.0, "r"), ("u", "c", 4.0, None, "x", 1.0, "s")],
        "user_id string, business_id string, stars double, date timestamp, text string, useful double, review_id string")
    kept = spark.createDataFrame([("b",)], "business_id string")
    assert rows(cohort.cohort_reviews(reviews, kept)) == [("u", "b", 4.0, None, 3, 2)]


def test_kcore_cascades(spark):
    pairs = [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x"), ("c", "z")]
    core = cohort.kcore(spark.createDataFrame(pairs, SCHEMA), 2, 2)
    assert rows(core) == [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")]


def test_kcore_counts_rows_not_pairs(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x")], SCHEMA)
    assert cohort.kcore(df, 2, 2).count() == 2


def test_kcore_may_end_empty(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], SCHEMA)
    assert cohort.kcore(df, 2, 2).count() == 0
    assert cohort.kcore(df.limit(0), 2, 2).count() == 0


def test_kcore_fixpoint_on_the_tables(spark, sf_dir):
    core = cohort.kcore(view(spark, sf_dir, "interactions"), 20, 25)
    assert core.count() == 4671
    assert core.groupBy("user_id").count().agg(F.min("count")).first()[0] >= 20
    assert core.groupBy("business_id").count().agg(F.min("count")).first()[0] >= 25
    assert cohort.kcore(core, 20, 25).count() == core.count()


def test_temporal_split(spark):
    days = [(i, datetime(2020, 1, i)) for i in range(1, 6)] + [(9, None)]
    df = spark.createDataFrame(days, "id int, date timestamp")
    split = cohort.temporal_split(df, 0.5, 0.25)
    assert rows(split, "id", "split") == [
        (1, "train"), (2, "train"), (3, "train"), (4, "valid"), (5, "test"), (9, "test")]


def test_split_is_ordered_in_time(spark, sf_dir):
    split = cohort.temporal_split(view(spark, sf_dir, "event_interactions"))
    edges = {r.split: (r.lo, r.hi) for r in split.groupBy("split").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()}
    assert edges["train"][1] < edges["valid"][0] and edges["valid"][1] < edges["test"][0]
