"""Taste profiles: liked visits, taste vectors, content-based picks and profile sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from palate.functions.numbers import round_half_even
from palate.functions.text import comma_parts, price_level
from palate.operators.search import mean_unit_vectors
from palate.operators.topk import topk_inner_product
from palate.session import cut_lineage

# Labels too generic to describe a taste.
GENERIC_CATEGORIES = ("Restaurants", "Food", "Nightlife", "Bars", "Event Planning & Services")


def liked(interactions: DataFrame, positive: float = 4.0) -> DataFrame:
    """Each user's rows with stars >= positive; all rows of users who have none.

    The per-user flag is a small aggregate joined back, so a very active user is never gathered in one
    task the way a window over the user would.
    """
    is_liked = F.coalesce(F.col("stars") >= positive, F.lit(False))
    likers = interactions.where(is_liked).select("user_id").distinct()
    return interactions.where(is_liked).unionByName(
        interactions.join(likers, "user_id", "left_anti").select(*interactions.columns)
    )


def business_vectors(corpus: DataFrame) -> DataFrame:
    """business_id, vec: normalised mean of the business's review vectors."""
    return mean_unit_vectors(corpus, "business_id", "embedding")


def taste_vector(interactions: DataFrame, vectors: DataFrame, positive: float = 4.0) -> DataFrame:
    """user_id, vec: normalised mean over the user's distinct liked businesses."""
    places = liked(interactions, positive).select("user_id", "business_id").distinct()
    return mean_unit_vectors(places.join(vectors, "business_id"), "user_id", "vec")


def recommend_by_taste(
    interactions: DataFrame,
    vectors: DataFrame,
    businesses: DataFrame,
    k: int = 10,
    positive: float = 4.0,
) -> DataFrame:
    """Top-k businesses the user has not visited, by taste vector match."""
    tastes = taste_vector(interactions, vectors, positive)
    found = topk_inner_product(
        tastes.select(F.col("user_id").alias("query_id"), "vec"),
        vectors.select(F.col("business_id").alias("item_id"), "vec"),
        k,
        exclude=interactions.select(F.col("user_id").alias("query_id"), F.col("business_id").alias("item_id")),
    )
    details = businesses.select("business_id", "name", "city", "stars", "categories")
    return (
        found.withColumnsRenamed({"query_id": "user_id", "item_id": "business_id", "score": "match"})
        .join(details, "business_id", "left")
        .select("user_id", "rank", "business_id", "name", "city", "stars", "categories", "match")
    )


def _top_values(rows: DataFrame, value: str, n: int, out: str) -> DataFrame:
    """The n values with the largest total weight per user, in order, as an array."""
    order = Window.partitionBy("user_id").orderBy(F.desc("total"), value)
    return (
        rows.where(F.col(value).isNotNull())
        .groupBy("user_id", value).agg(F.sum("weight").alias("total"))
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
        .groupBy("user_id")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("place", value))), lambda s: s[value]).alias(out))
    )


def profile_stats(interactions: DataFrame, businesses: DataFrame, positive: float = 4.0) -> DataFrame:
    """Per user: activity over all rows, and categories, price, cities and favourites over liked rows.

    The interactions are read once and combined to one row per (user, business); a liked visit counts
    with its multiplicity from then on.
    """
    is_liked = F.coalesce(F.col("stars") >= positive, F.lit(False))
    pairs = cut_lineage(interactions.groupBy("user_id", "business_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(is_liked.cast("long")).alias("n_liked"),
        F.max("stars").alias("best"),
        F.sum("stars").alias("star_sum"),
        F.count("stars").alias("n_stars"),
    ))
    activity = pairs.groupBy("user_id").agg(
        F.sum("n").alias("n_reviews"),
        round_half_even(F.try_divide(F.sum("star_sum"), F.sum("n_stars")), 2).alias("avg_stars"),
        F.sum("n_liked").alias("n_likes"),
    )
    weight = F.when(F.col("n_likes") > 0, F.col("n_liked")).otherwise(F.col("n"))
    details = businesses.where(F.col("name").isNotNull()).select(
        "business_id", "name", "city", "categories",
        price_level(F.col("attributes")["RestaurantsPriceRange2"]).alias("price"),
    )
    weighed = (
        pairs.join(activity.select("user_id", "n_likes"), "user_id")
        .select("user_id", "business_id", "best", weight.alias("weight")).where(F.col("weight") > 0)
    )
    visits = weighed.join(details, "business_id")
    labels = visits.select("user_id", "weight", F.explode(comma_parts(F.col("categories"))).alias("category")).where(
        ~F.col("category").isin(*GENERIC_CATEGORIES) & (F.col("category") != "")
    )
    best = Window.partitionBy("user_id").orderBy(F.desc_nulls_last("best"), "business_id")
    favourites = (
        weighed.withColumn("place", F.row_number().over(best)).where(F.col("place") <= 5)
        .join(details.select("business_id", "name"), "business_id")
        .groupBy("user_id")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "name"))), lambda s: s["name"]).alias("favorites"))
    )
    nothing = F.array().cast("array<string>")
    return (
        activity.join(_top_values(labels, "category", 5, "top_categories"), "user_id", "left")
        .join(_top_values(visits, "price", 1, "prices"), "user_id", "left")
        .join(_top_values(visits, "city", 3, "top_cities"), "user_id", "left")
        .join(favourites, "user_id", "left")
        .select(
            "user_id", "n_reviews", "avg_stars",
            F.coalesce("top_categories", nothing).alias("top_categories"),
            F.coalesce(F.expr("repeat('$', prices[0])"), F.lit("n/a")).alias("price_pref"),
            F.coalesce("top_cities", nothing).alias("top_cities"),
            F.coalesce("favorites", nothing).alias("favorites"),
        )
    )


def _listed(array: str, n: int, separator: str, fallback: str):
    text = F.array_join(F.slice(array, 1, n), separator)
    return F.when(text == "", fallback).otherwise(text)


def profile_text(stats: DataFrame) -> DataFrame:
    """One or two sentences per user built from profile_stats."""
    # The phrases and the limits between tones define the profile.
    average = F.col("avg_stars")
    tone = (
        F.when(average < 3.5, "a tough grader")
        .when(average >= 4.2, "an enthusiastic regular")
        .otherwise("a balanced reviewer")
    )
    favourites = F.array_join(F.slice("favorites", 1, 3), "; ")
    text = F.concat(
        F.lit("You're "), tone, F.lit(" who has reviewed "), F.col("n_reviews").cast("string"),
        F.lit(" places, averaging "), F.coalesce(average.cast("string"), F.lit("nan")),
        F.lit("★. You gravitate toward "), _listed("top_categories", 3, ", ", "a wide range of places"),
        F.lit(", usually around "), F.col("price_pref"),
        F.lit(" in "), _listed("top_cities", 2, " and ", "your area"), F.lit("."),
        F.when(favourites != "", F.concat(F.lit(" Your go-to spots include "), favourites, F.lit("."))).otherwise(""),
    )
    return stats.select("user_id", text.alias("profile"))
