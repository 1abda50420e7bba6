"""User, business and cross features computed from a history window of interactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from palate.functions.numbers import to_number, whole_days
from palate.functions.quantiles import exact_quantiles
from palate.functions.text import comma_parts, price_level, strip
from palate.session import cut_lineage
from palate.sources.jsonl import is_elite
from palate.sources.schemas import COMPLIMENT_COLUMNS

# Umbrella categories, amenity attributes, model columns.
UMBRELLA = ("Restaurants", "Food")
AMENITIES = {
    "b_takeout": "RestaurantsTakeOut",
    "b_delivery": "RestaurantsDelivery",
    "b_groups": "RestaurantsGoodForGroups",
    "b_reservations": "RestaurantsReservations",
    "b_cards": "BusinessAcceptsCreditCards",
}
USER_NUMERIC = (
    "u_n_reviews", "u_avg_stars", "u_std_stars", "u_pct_positive", "u_avg_review_len",
    "u_n_distinct_biz", "u_avg_biz_pop", "u_avg_price", "u_active_days",
    "u_reviews_per_month", "u_account_age_days", "u_is_elite", "u_fans",
    "u_total_compliments",
)
BUSINESS_NUMERIC = (
    "b_n_reviews", "b_avg_stars", "b_std_stars", "b_pct_positive", "b_avg_review_len",
    "b_useful_per_rev", "b_age_days", "b_reviews_per_month", "b_global_stars",
    "b_global_review_count", "b_is_open", "b_price_range", "b_n_categories",
    "b_takeout", "b_delivery", "b_groups", "b_reservations", "b_cards",
    "b_checkin_count", "b_checkin_per_month", "b_tip_count", "b_pop_percentile",
)
CROSS_NUMERIC = ("als_score", "cf_rank", "star_gap", "price_gap", "same_city", "same_top_cat")
FEATURE_COLUMNS = USER_NUMERIC + BUSINESS_NUMERIC + CROSS_NUMERIC

PRICE_CELL = 1.0 / 1024


# -- static tables ------------------------------------------------------------------------------

def cohort_users(users: DataFrame, ids: DataFrame) -> DataFrame:
    """Profile rows of the cohort's users with elite flag and summed compliments."""
    present = [c for c in COMPLIMENT_COLUMNS if c in users.columns]
    total = F.lit(0.0)
    for column in present:
        total = total + F.coalesce(to_number(F.col(column)), F.lit(0.0))
    return (
        users.join(ids.select("user_id").distinct(), "user_id", "left_semi")
        .select(
            "user_id", "signup_date",
            is_elite(F.col("elite")).alias("is_elite"),
            to_number(F.col("fans")).alias("fans"),
            total.alias("total_compliments"),
        )
    )


def checkin_stats(checkins: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Stamps per business and the last one in list order; `as_of` ignores later stamps."""
    listed = F.coalesce(F.col("date"), F.lit(""))
    stamps = F.when(listed != "", F.split(listed, ", ")).otherwise(F.array().cast("array<string>"))
    if as_of is not None:
        stamps = F.filter(stamps, lambda s: F.try_to_timestamp(s) <= as_of)
    return (
        checkins.select("business_id", stamps.alias("stamps"))
        .select(
            "business_id",
            F.size("stamps").cast("long").alias("checkin_count"),
            F.try_to_timestamp(F.try_element_at("stamps", F.lit(-1))).alias("last_checkin"),
        )
    )


def tip_counts(tips: DataFrame, as_of: Column | None = None) -> DataFrame:
    counted = tips if as_of is None else tips.where(F.col("date") <= as_of)
    return counted.groupBy("business_id").agg(F.count(F.lit(1)).alias("tip_count"))


def primary_category(categories: Column) -> Column:
    """First label that is not an umbrella one, else the first label; 'Unknown' when there is none."""
    parts = comma_parts(categories)
    specific = F.filter(parts, lambda c: ~c.isin(*UMBRELLA))
    first = F.coalesce(F.get(specific, F.lit(0)), F.get(parts, F.lit(0)))
    return F.when(F.coalesce(categories, F.lit("")) == "", "Unknown").otherwise(first)


def enrich_businesses(businesses: DataFrame) -> DataFrame:
    return businesses.withColumns({
        "price_range": F.coalesce(price_level(F.col("attributes")["RestaurantsPriceRange2"]), F.lit(-1)),
        "primary_category": primary_category(F.col("categories")),
    })


# -- per-user features --------------------------------------------------------------------------

def _positive_share(stars: Column, threshold: float) -> Column:
    return F.avg(F.coalesce((stars >= threshold).cast("double"), F.lit(0.0)))


def _window_end(history: DataFrame) -> Column:
    return history.agg(F.max("date").alias("window_end")).scalar()


def _modes(visits: DataFrame, value: str, out: str) -> DataFrame:
    """Each user's most frequent value, ties to the smallest: two plain aggregates, combined on the map side."""
    counts = visits.where(F.col(value).isNotNull()).groupBy("user_id", value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("user_id").agg(F.min(F.struct((-F.col("n")).alias("n"), value)).alias("best")).select(
        "user_id", F.col(f"best.{value}").alias(out))


def user_features(
    history: DataFrame,
    businesses: DataFrame,
    users: DataFrame,
    positive: float = 4.0,
    only: DataFrame | None = None,
) -> DataFrame:
    """One row per user of the history window; `businesses` enriched, `users` from cohort_users.

    `only` (user_id) limits the rows to those users; the typical price is still taken over all users.
    """
    places = businesses.select(
        "business_id",
        F.col("review_count").alias("biz_rc"), F.col("stars").alias("biz_gs"),
        F.when(F.col("price_range") > 0, F.col("price_range")).alias("biz_price"),
        F.col("city").alias("biz_city"), F.col("primary_category").alias("biz_cat"),
    )
    # many rows meet one per business or user: these are hashed, so that a task sorts no visits
    places = places.hint("shuffle_hash")
    visits = history.join(places, "business_id", "left")
    own, own_visits = history, visits
    if only is not None:
        own = history.join(only.select("user_id"), "user_id", "left_semi")
        own_visits = own.join(places, "business_id", "left")
    activity = (
        own_visits.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("u_n_reviews"),
            F.avg("stars").alias("u_avg_stars"),
            F.coalesce(F.stddev_samp("stars"), F.lit(0.0)).alias("u_std_stars"),
            _positive_share(F.col("stars"), positive).alias("u_pct_positive"),
            F.avg("review_len").alias("u_avg_review_len"),
            F.avg("biz_rc").alias("u_avg_biz_pop"),
            F.avg("biz_gs").alias("u_avg_biz_stars"),
            F.avg("biz_price").alias("own_price"),
            whole_days(F.max("date"), F.min("date")).alias("u_active_days"),
        )
    )
    modal_city, top_cat = _modes(own_visits, "biz_city", "u_modal_city"), _modes(own_visits, "biz_cat", "u_top_cat")
    # counted on its own: a distinct next to the mode buffers would carry those per (user, business)
    breadth = (
        own.select("user_id", "business_id").distinct()
        .groupBy("user_id").agg(F.count("business_id").alias("u_n_distinct_biz"))
    )
    if only is None:
        # one row per user, read again for the typical price: cheaper kept than regrouped
        prices = activity = cut_lineage(activity)
    else:
        prices = visits.groupBy("user_id").agg(F.avg("biz_price").alias("own_price"))
    typical_price = exact_quantiles(prices, F.col("own_price"), (0.5,), PRICE_CELL).scalar()
    age = F.greatest(whole_days(_window_end(history), F.col("signup_date")), F.lit(0))
    return (
        activity.join(breadth.hint("shuffle_hash"), "user_id")
        .join(modal_city.hint("shuffle_hash"), "user_id", "left").join(top_cat.hint("shuffle_hash"), "user_id", "left")
        .join(users.hint("shuffle_hash"), "user_id", "left")
        .select(
            "user_id", "u_n_reviews", "u_avg_stars", "u_std_stars", "u_pct_positive",
            "u_avg_review_len", "u_n_distinct_biz", "u_avg_biz_pop", "u_avg_biz_stars",
            F.coalesce("own_price", typical_price).alias("u_avg_price"),
            "u_active_days",
            (F.col("u_n_reviews") / (F.col("u_active_days") / F.lit(30.0) + 1.0)).alias("u_reviews_per_month"),
            F.coalesce("u_modal_city", F.lit("Unknown")).alias("u_modal_city"), F.coalesce("u_top_cat", F.lit("Unknown")).alias("u_top_cat"),
            F.when(F.col("signup_date").isNotNull(), age).alias("u_account_age_days"),
            F.coalesce(F.col("is_elite").cast("double"), F.lit(0.0)).alias("u_is_elite"),
            F.coalesce("fans", F.lit(0.0)).alias("u_fans"),
            F.coalesce("total_compliments", F.lit(0.0)).alias("u_total_compliments"),
        )
    )


# -- per-business features ----------------------------------------------------------------------

def pop_percentile(counts: DataFrame, value: str = "b_n_reviews", out: str = "b_pop_percentile") -> DataFrame:
    """Average-tie percentile rank of `value`, from its histogram.

    Distinct review counts are at most sqrt(2 * rows), so the running sum over them stays short however
    many businesses there are.
    """
    histogram = counts.groupBy(value).agg(F.count(F.lit(1)).alias("ties"))
    below = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = histogram.select(
        value,
        (
            (F.coalesce(F.sum("ties").over(below), F.lit(0)) + (F.col("ties") + 1) / F.lit(2.0))
            / F.sum("ties").over(Window.partitionBy())
        ).alias(out),
    )
    return counts.join(F.broadcast(ranked), value)


def _amenity(key: str) -> Column:
    flag = F.lower(strip(F.col("attributes")[key])) == "true"
    return F.coalesce(flag.cast("int"), F.lit(0))


def business_features(
    history: DataFrame, businesses: DataFrame, checkins: DataFrame, tips: DataFrame, positive: float = 4.0
) -> DataFrame:
    """One row per business of the history window, with metadata, check-ins and tips joined on."""
    activity = history.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("b_n_reviews"),
        F.avg("stars").alias("b_avg_stars"),
        F.coalesce(F.stddev_samp("stars"), F.lit(0.0)).alias("b_std_stars"),
        _positive_share(F.col("stars"), positive).alias("b_pct_positive"),
        F.avg("review_len").alias("b_avg_review_len"),
        F.avg("useful").alias("b_useful_per_rev"),
        F.min("date").alias("first_date"),
    )
    parts = F.filter(comma_parts(F.coalesce(F.col("categories"), F.lit(""))), lambda c: c != "")
    metadata = businesses.select(
        "business_id",
        F.col("stars").alias("b_global_stars"),
        F.col("review_count").alias("b_global_review_count"),
        F.coalesce(to_number(F.col("is_open")), F.lit(0.0)).alias("b_is_open"),
        F.col("price_range").alias("b_price_range"),
        F.size(parts).alias("b_n_categories"),
        F.col("city").alias("b_city"),
        F.col("primary_category").alias("b_primary_category"),
        *[_amenity(key).alias(name) for name, key in AMENITIES.items()],
    )
    months = F.col("b_age_days") / F.lit(30.0) + 1.0
    joined = (
        activity.withColumn("b_age_days", whole_days(_window_end(history), F.col("first_date")))
        .withColumn("b_reviews_per_month", F.col("b_n_reviews") / months)
        .drop("first_date")
        .join(metadata.hint("shuffle_hash"), "business_id", "left")
        .join(checkins.select("business_id", "checkin_count").hint("shuffle_hash"), "business_id", "left")
        .join(tips.hint("shuffle_hash"), "business_id", "left")
        .withColumn("b_checkin_count", F.coalesce(F.col("checkin_count").cast("double"), F.lit(0.0)))
        .withColumn("b_checkin_per_month", F.col("b_checkin_count") / months)
        .withColumn("b_tip_count", F.coalesce(F.col("tip_count").cast("double"), F.lit(0.0)))
        .drop("checkin_count", "tip_count")
    )
    return pop_percentile(joined)


# -- cross features -----------------------------------------------------------------------------

def cross_features(frame: DataFrame) -> DataFrame:
    """Compare the user with the candidate; needs both feature sets on the row."""
    price = F.when(F.col("b_price_range") > 0, F.col("b_price_range"))
    return frame.withColumns({
        "star_gap": F.col("u_avg_stars") - F.col("b_avg_stars"),
        "price_gap": F.coalesce(F.abs(F.col("u_avg_price") - price), F.lit(0.0)),
        "same_city": F.coalesce((F.col("b_city") == F.col("u_modal_city")).cast("int"), F.lit(0)),
        "same_top_cat": F.coalesce((F.col("b_primary_category") == F.col("u_top_cat")).cast("int"), F.lit(0)),
    })
