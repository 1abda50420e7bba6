"""Descriptive statistics over businesses, reviews and users: one declarative aggregate each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from palate.functions.numbers import round_half_even
from palate.functions.sampling import hash_sample
from palate.functions.text import strip, words

# Price labels, activity tiers, stopwords.
PRICE_LABELS = ("$", "$$", "$$$", "$$$$")
ACTIVITY_BINS = (
    (0, 1, "1"), (1, 10, "2–10"), (10, 50, "11–50"), (50, 100, "51–100"), (100, 500, "101–500"),
    (500, None, "500+"),
)
STOPWORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "is", "it", "was", "i", "we", "they", "this", "that",
    "be", "are", "have", "has", "had", "my", "our", "not", "so", "as",
    "very", "just", "get", "got", "do", "did", "one", "you", "me", "he",
    "she", "from", "all", "there", "been", "will", "would", "what",
    "if", "up", "out", "no", "by", "also", "when", "than", "more", "like",
    "their", "them", "which", "s", "t", "re", "m",
)
MIN_WORD_LENGTH = 3


# -- businesses ---------------------------------------------------------------------------------

# A cut to so many rows is broadcast.
BROADCAST_ROWS = 100_000


def top_categories(businesses: DataFrame, n: int = 20) -> DataFrame:
    category = F.explode(F.split("categories", ", "))
    return (
        businesses.where(F.col("categories").isNotNull())
        .select(category.alias("category")).select(strip(F.col("category")).alias("category"))
        .groupBy("category").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "category").limit(n)
    )


def rating_distribution(df: DataFrame, column: str = "stars") -> DataFrame:
    """Rows per rating, rounded to one decimal."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(round_half_even(F.col(column), 1).alias("stars")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy("stars")
    )


def city_summary(businesses: DataFrame, n: int = 20) -> DataFrame:
    return (
        businesses.where(F.col("city").isNotNull()).groupBy("city")
        .agg(
            F.count("business_id").alias("business_count"),
            round_half_even(F.avg("stars"), 2).alias("avg_stars"),
            round_half_even(F.coalesce(F.sum("review_count"), F.lit(0.0)), 2).alias("total_reviews"),
        )
        .orderBy(F.desc("business_count"), "city").limit(n)
    )


def open_vs_closed(businesses: DataFrame) -> DataFrame:
    status = F.when(F.col("is_open") == 1, "Open").when(F.col("is_open") == 0, "Closed")
    return (
        businesses.select(status.alias("status")).where(F.col("status").isNotNull())
        .groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    )


def share_open(businesses: DataFrame) -> DataFrame:
    """Percentage of each open/closed group."""
    counts = open_vs_closed(businesses)
    total = F.sum("n").over(Window.partitionBy())  # two rows
    return counts.withColumn("pct", F.col("n") * F.lit(100.0) / total)


def _label_spine(spark: SparkSession, labels: list[str], column: str) -> DataFrame:
    schema = T.StructType([T.StructField("bin", T.IntegerType()), T.StructField(column, T.StringType())])
    return spark.createDataFrame(list(enumerate(labels, start=1)), schema)


def price_range_dist(businesses: DataFrame) -> DataFrame:
    """Businesses per price label; all four labels are always present."""
    raw = F.btrim(F.col("attributes")["RestaurantsPriceRange2"], F.lit("'\" "))
    level = F.coalesce(*[
        F.when(raw.isin(str(i), f"{i}.0"), F.lit(i)) for i in range(1, len(PRICE_LABELS) + 1)
    ])
    counts = (
        businesses.select(level.alias("bin")).where(F.col("bin").isNotNull())
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        _label_spine(businesses.sparkSession, list(PRICE_LABELS), "price")
        .join(counts, "bin", "left")
        .select("price", F.coalesce("n", F.lit(0)).alias("n"))
    )


def state_summary(businesses: DataFrame, n: int = 30) -> DataFrame:
    return (
        businesses.where(F.col("state").isNotNull()).groupBy("state")
        .agg(F.count("business_id").alias("n"), F.avg("stars").alias("avg_stars"))
        .orderBy(F.desc("n"), "state").limit(n)
    )


def geo_sample(businesses: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """Located businesses for a map, or a seeded sample of n of them."""
    located = businesses.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "business_id", "name", "city", "state", "stars", "review_count", "latitude", "longitude"
    )
    return located if n is None else hash_sample(located, "business_id", n, seed)


def geo_center(sample: DataFrame) -> DataFrame:
    return sample.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


# -- reviews ------------------------------------------------------------------------------------

# frequency -> (truncation unit, months per period)
_PERIODS = {"ME": ("month", 1), "QE": ("quarter", 3), "YE": ("year", 12)}


def reviews_over_time(reviews: DataFrame, freq: str = "ME") -> DataFrame:
    """Rows per month, quarter or year, labelled by the last day; empty periods count 0."""
    unit, months = _PERIODS[freq]
    counts = (
        reviews.where(F.col("date").isNotNull())
        .groupBy(F.trunc(F.col("date").cast("date"), unit).alias("period"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spine = counts.agg(F.min("period").alias("lo"), F.max("period").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.make_interval(months=F.lit(months)))).alias("period")
    )
    return spine.join(counts, "period", "left").select(
        F.date_sub(F.add_months("period", months), 1).alias("period_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def review_length_stats(reviews: DataFrame) -> DataFrame:
    # counted per (stars, length) first: a star value with most of the rows is spread over its lengths
    histogram = (
        reviews.where(F.col("stars").isNotNull())
        .select("stars", F.length("text").alias("length")).groupBy("stars", "length").agg(F.count("length").alias("n"))
    )
    upto = Window.partitionBy("stars").orderBy("length").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = histogram.withColumn("last", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy("stars")))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("last") > place) & (F.col("last") - F.col("n") <= place), F.col("length")))

    low, high = F.floor((F.col("total") - 1) / 2), F.ceil((F.col("total") - 1) / 2)
    return ranked.groupBy("stars").agg(
        round_half_even(F.sum(F.col("length") * F.col("n")) / F.sum("n"), 1).alias("avg_chars"),
        round_half_even((at(low) + at(high)) / 2, 1).alias("median_chars"),
        F.sum("n").alias("n_reviews"),
    )


def voting_by_stars(reviews: DataFrame) -> DataFrame:
    return (
        reviews.where(F.col("stars").isNotNull()).groupBy("stars")
        .agg(*[round_half_even(F.avg(c), 3).alias(c) for c in ("useful", "funny", "cool")])
    )


def top_reviewed_businesses(reviews: DataFrame, businesses: DataFrame, n: int = 15) -> DataFrame:
    """The n most reviewed businesses; names are joined after the cut to n rows."""
    top = (
        reviews.where(F.col("business_id").isNotNull())
        .groupBy("business_id").agg(F.count(F.lit(1)).alias("review_count"))
        .orderBy(F.desc("review_count"), "business_id").limit(n)
    )
    # few rows: broadcasting the left side lets the business scan stay where it is
    ids = top.select("business_id")
    named = businesses.select("business_id", "name", "city", "stars").join(
        F.broadcast(ids) if n <= BROADCAST_ROWS else ids, "business_id", "left_semi"
    )
    return top.join(named, "business_id", "left")


def word_freq_by_stars(reviews: DataFrame, n: int = 50) -> DataFrame:
    """Top n words of every star value in a single pass over the whole texts."""
    counted = (
        reviews.where(F.col("stars").isNotNull() & F.col("text").isNotNull())
        .select("stars", F.explode(words(F.col("text"))).alias("word"))
        .where((F.length("word") >= MIN_WORD_LENGTH) & ~F.col("word").isin(*STOPWORDS))
        .groupBy("stars", "word").agg(F.count(F.lit(1)).alias("n"))
    )
    by_count = Window.partitionBy("stars").orderBy(F.desc("n"), "word")
    return (
        counted.withColumn("place", F.row_number().over(by_count))
        .where(F.col("place") <= n)
    )


def polarity_from_stars(stars: Column) -> Column:
    return F.when(stars >= 4, "positive").when(stars <= 2, "negative").otherwise("neutral")


def polarity(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy(polarity_from_stars(F.col("stars")).alias("polarity"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# -- users --------------------------------------------------------------------------------------

def user_activity_bins(users: DataFrame) -> DataFrame:
    """Users per activity tier; tiers are right-closed, empty ones stay, 0 and null fall outside."""
    count = F.col("review_count")
    tier = F.coalesce(*[
        F.when((count > low) & (F.lit(True) if high is None else count <= high), F.lit(i))
        for i, (low, high, _) in enumerate(ACTIVITY_BINS, start=1)
    ])
    counts = (
        users.select(tier.alias("bin")).where(F.col("bin").isNotNull())
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        _label_spine(users.sparkSession, [label for _, _, label in ACTIVITY_BINS], "tier")
        .join(counts, "bin", "left")
        .select("bin", "tier", F.coalesce("n", F.lit(0)).alias("n"))
    )


def elite_vs_regular(users: DataFrame) -> DataFrame:
    return (
        users.groupBy(F.when(F.col("is_elite"), "Elite").otherwise("Regular").alias("user_type"))
        .agg(
            F.count("user_id").alias("n"),
            round_half_even(F.avg("review_count"), 2).alias("avg_reviews"),
            round_half_even(F.avg("average_stars"), 2).alias("avg_stars"),
            round_half_even(F.avg("fans"), 2).alias("avg_fans"),
        )
    )


def signup_cohorts(users: DataFrame) -> DataFrame:
    """Users per year they joined."""
    return (
        users.where(F.col("signup_date").isNotNull())
        .groupBy(F.year("signup_date").alias("year")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy("year")
    )


def overview_kpis(businesses: DataFrame, reviews: DataFrame, users: DataFrame) -> DataFrame:
    """One row: businesses, reviews, users and distinct cities."""
    return businesses.agg(
        F.count(F.lit(1)).alias("n_businesses"), F.count_distinct("city").alias("n_cities")
    ).select(
        "n_businesses",
        reviews.agg(F.count(F.lit(1))).scalar().alias("n_reviews"),
        users.agg(F.count(F.lit(1))).scalar().alias("n_users"),
        "n_cities",
    )
