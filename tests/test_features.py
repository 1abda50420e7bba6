import math
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from palate.operators import features as f

HISTORY = "user_id string, business_id string, stars double, date timestamp, review_len long, useful long"
BUSINESS = ("business_id string, city string, stars double, review_count double, is_open double, categories string, "
            "attributes map<string,string>")


@pytest.fixture(scope="module")
def businesses(spark):
    return f.enrich_businesses(spark.createDataFrame([
        ("x", "b", 4.0, 10.0, 1.0, "Food, Restaurants, Thai", {"RestaurantsPriceRange2": "'2'", "RestaurantsTakeOut": "True"}),
        ("y", "a", 3.0, 30.0, None, "Restaurants", {"RestaurantsPriceRange2": "2.7", "RestaurantsTakeOut": " true "}),
        ("z", None, 5.0, 50.0, 0.0, None, {"RestaurantsPriceRange2": "u'2'", "RestaurantsTakeOut": "u'True'"}),
        ("w", None, 5.0, 50.0, 0.0, "", None),
    ], BUSINESS))


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame([
        ("u", "x", 3.0, datetime(2020, 1, 1, 23), 10, 1),
        ("u", "y", 5.0, datetime(2020, 1, 2, 1), 30, 0),
        ("v", "z", 4.0, datetime(2020, 3, 1), 50, 2),
    ], HISTORY)


def test_enrich(businesses):
    assert rows(businesses, "business_id", "price_range", "primary_category") == [
        ("w", -1, "Unknown"), ("x", 2, "Thai"), ("y", 2, "Restaurants"), ("z", -1, "Unknown")]


def test_user_features(spark, history, businesses):
    users = f.cohort_users(spark.createDataFrame(
        [("u", datetime(2020, 2, 28), "2019", "7", 1.0, None)],
        "user_id string, signup_date timestamp, elite string, fans string, compliment_hot double, compliment_cool double"), history)
    got = {r.user_id: r for r in f.user_features(history, businesses, users).collect()}
    u, v = got["u"], got["v"]
    assert (u.u_n_reviews, u.u_n_distinct_biz, u.u_active_days, u.u_avg_stars, u.u_pct_positive) == (2, 2, 0, 4.0, 0.5)
    assert math.isclose(u.u_std_stars, 1.41421356, rel_tol=1e-8) and v.u_std_stars == 0.0
    assert (u.u_modal_city, v.u_modal_city, v.u_top_cat) == ("a", "Unknown", "Unknown")
    assert (u.u_avg_price, v.u_avg_price) == (2.0, 2.0)  # v takes the median over users
    assert (u.u_account_age_days, v.u_account_age_days) == (2, None)
    assert (u.u_is_elite, u.u_fans, u.u_total_compliments, v.u_fans) == (1.0, 7.0, 1.0, 0.0)
    assert u.u_avg_biz_pop == 20.0 and u.u_reviews_per_month == 2.0


def test_business_features(spark, history, businesses):
    stamps = f.checkin_stats(spark.createDataFrame(
        [("x", "2021-01-01 00:00:00, 2020-05-05 10:00:00"), ("y", ""), ("z", None)], "business_id string, date string"))
    assert rows(stamps) == [("x", 2, datetime(2020, 5, 5, 10)), ("y", 0, None), ("z", 0, None)]
    tips = f.tip_counts(spark.createDataFrame([("x",), ("x",)], "business_id string"))
    got = {r.business_id: r for r in f.business_features(history, businesses, stamps, tips).collect()}
    assert [got[b].b_takeout for b in "xyz"] == [1, 1, 0]
    assert [got[b].b_n_categories for b in "xyz"] == [3, 1, 0]
    assert [got[b].b_is_open for b in "xyz"] == [1.0, 0.0, 0.0]
    assert got["x"].b_age_days == 59 and got["z"].b_age_days == 0
    assert (got["x"].b_checkin_count, got["x"].b_tip_count, got["z"].b_tip_count) == (2.0, 2.0, 0.0)
    assert math.isclose(got["x"].b_checkin_per_month, 2 / (59 / 30 + 1))


def test_as_of_leaves_out_later_checkins_and_tips(spark):
    when = F.lit("2020-06-01").cast("timestamp")
    stamps = spark.createDataFrame([("x", "2021-01-01 00:00:00, 2020-05-05 10:00:00")], "business_id string, date string")
    assert rows(f.checkin_stats(stamps, when), "checkin_count") == [(1,)]
    tips = spark.createDataFrame([("x", datetime(2020, 1, 1)), ("x", datetime(2021, 1, 1))], "business_id string, date timestamp")
    assert rows(f.tip_counts(tips, when)) == [("x", 1)]


def test_pop_percentile_averages_ties(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 5)], "business_id string, b_n_reviews long")
    assert rows(f.pop_percentile(df), "business_id", "b_pop_percentile") == [
        ("a", 0.375), ("b", 0.375), ("c", 0.75), ("d", 1.0)]


def test_cross_features(spark):
    df = spark.createDataFrame(
        [(1, 4.0, 3.0, 2.0, -1, "a", "a", "Thai", None), (2, 4.0, 3.0, 2.0, 3, "Unknown", "Unknown", "Thai", "Thai"),
         (3, 4.0, 3.0, 2.0, None, None, "a", "x", "y")],
        "id int, u_avg_stars double, b_avg_stars double, u_avg_price double, b_price_range int, b_city string, "
        "u_modal_city string, b_primary_category string, u_top_cat string")
    assert rows(f.cross_features(df), "id", "star_gap", "price_gap", "same_city", "same_top_cat") == [
        (1, 1.0, 0.0, 1, 0), (2, 1.0, 1.0, 1, 1), (3, 1.0, 0.0, 0, 0)]


def test_model_columns():
    assert len(f.USER_NUMERIC) == 14 and len(f.BUSINESS_NUMERIC) == 22 and len(set(f.FEATURE_COLUMNS)) == 42


def test_visits_meet_businesses_and_users_without_being_sorted(spark, history, businesses):
    users = f.cohort_users(spark.createDataFrame(
        [("u", datetime(2020, 2, 28), "2019", "7")], "user_id string, signup_date timestamp, elite string, fans string"), history)
    stamps = f.checkin_stats(spark.createDataFrame([("x", "2021-01-01 00:00:00")], "business_id string, date string"))
    tips = f.tip_counts(spark.createDataFrame([("x",), ("x",)], "business_id string"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for made, n in (
            (f.user_features(history, businesses, users, only=history.select("user_id").distinct()), 2),
            (f.business_features(history, businesses, stamps, tips), 3),
        ):
            plan = made._jdf.queryExecution().sparkPlan().toString()
            # of many rows a key only the window's users may still be found by a sort
            assert plan.count("ShuffledHashJoin") >= 3 and "LeftOuter" in plan
            assert not [line for line in plan.splitlines() if "SortMergeJoin" in line and "LeftSemi" not in line]
            assert made.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
