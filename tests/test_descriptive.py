from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F

from palate.operators import descriptive as d
from palate.sources.jsonl import is_elite


def test_rating_distribution_rounds_half_even_to_one_decimal(spark):
    df = spark.createDataFrame([(3.25,), (3.25,), (4.0,), (None,)], "stars double")
    assert rows(d.rating_distribution(df)) == [(3.2, 2), (4.0, 1)]


def test_price_range_dist_keeps_all_labels(spark):
    prices = ["2", "'2'", "3.0", "None", None, "5"]
    df = spark.createDataFrame([({"RestaurantsPriceRange2": p},) for p in prices] + [(None,)], "attributes map<string,string>")
    assert dict(rows(d.price_range_dist(df))) == {"$": 0, "$$": 2, "$$$": 1, "$$$$": 0}


def test_reviews_over_time_fills_empty_months(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 5),), (datetime(2020, 3, 9),), (None,)], "date timestamp")
    assert rows(d.reviews_over_time(df)) == [(date(2020, 1, 31), 1), (date(2020, 2, 29), 0), (date(2020, 3, 31), 1)]
    assert rows(d.reviews_over_time(df, "QE")) == [(date(2020, 3, 31), 2)]
    assert rows(d.reviews_over_time(df, "YE")) == [(date(2020, 12, 31), 2)]


def test_user_activity_bins_are_right_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 10, 11, 501)] + [(None,)], "review_count double")
    assert [(r.tier, r.n) for r in d.user_activity_bins(df).orderBy("bin").collect()] == [
        ("1", 1), ("2–10", 2), ("11–50", 1), ("51–100", 0), ("101–500", 0), ("500+", 1)]


def test_word_freq(spark):
    df = spark.createDataFrame([(5.0, "Don't stop, GREAT food!"), (5.0, "a great  b"), (1.0, None)], "stars double, text string")
    assert rows(d.word_freq_by_stars(df), "stars", "word", "n") == [
        (5.0, "dont", 1), (5.0, "food", 1), (5.0, "great", 2), (5.0, "stop", 1)]


def test_polarity(spark):
    df = spark.createDataFrame([(4.0,), (3.5,), (2.0,), (None,)], "stars double")
    assert rows(d.polarity(df)) == [("negative", 1), ("neutral", 2), ("positive", 1)]


def test_elite_flag(spark):
    df = spark.createDataFrame([("2019,2020",), ("",), (" ",), ("nan",), (None,)], "elite string")
    assert [r[0] for r in df.select(is_elite(F.col("elite"))).collect()] == [True, False, False, False, False]


def test_open_shares_sum_to_hundred(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (0.0,), (7.0,), (None,)], "is_open double")
    assert [(s, n) for s, n, _ in rows(d.share_open(df))] == [("Closed", 1), ("Open", 2)]
    assert abs(sum(r.pct for r in d.share_open(df).collect()) - 100) < 1e-9


def test_geo_sample_is_a_seeded_subset(spark):
    df = spark.range(500).select(
        F.col("id").alias("business_id"), *[F.lit("x").alias(c) for c in ("name", "city", "state")],
        *[F.lit(1.0).alias(c) for c in ("stars", "review_count", "longitude")],
        F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("latitude"))
    one, two = rows(d.geo_sample(df, 50), "business_id"), rows(d.geo_sample(df, 50), "business_id")
    assert one == two and len(one) == 50
    assert all(i % 5 for (i,) in one)


def test_length_stats_of_one_dominant_star(spark):
    """Most rows in one group, and the plan aggregates by (stars, length) before any group meets."""
    from palate.operators import descriptive as d

    lengths = [(5.0, "x" * (i % 37)) for i in range(2000)] + [(1.0, "y" * i) for i in range(4)] + [(1.0, None), (None, "z")]
    df = spark.createDataFrame(lengths, "stars double, text string")
    got = {r.stars: (r.avg_chars, r.median_chars, r.n_reviews) for r in d.review_length_stats(df).collect()}
    five = sorted(i % 37 for i in range(2000))
    assert got == {5.0: (round(sum(five) / 2000, 1), (five[999] + five[1000]) / 2, 2000), 1.0: (1.5, 1.5, 4)}
