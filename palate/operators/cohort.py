"""Cohort preparation: dining filter, city choice, review projection, k-core, chronological split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from palate.config import DINING_CATEGORIES
from palate.functions.numbers import micros, to_number
from palate.functions.quantiles import HOUR_MICROS, exact_quantiles
from palate.session import cut_lineage, keep_table

# Dropped ids of one k-core step are broadcast up to this count (tens of megabytes).
BROADCAST_IDS = 1_000_000


def is_dining(categories: Column, labels: Sequence[str] = DINING_CATEGORIES) -> Column:
    """Case-sensitive substring test; null or empty categories never match."""
    hit = F.lit(False)
    for label in labels:
        hit = hit | categories.contains(label)
    return F.coalesce(hit, F.lit(False))


def dining_filter(businesses: DataFrame, labels: Sequence[str] = DINING_CATEGORIES) -> DataFrame:
    return businesses.where(is_dining(F.col("categories"), labels))


def auto_cities(dining: DataFrame, n: int = 5) -> DataFrame:
    """The n cities with most dining businesses."""
    return (
        dining.where(F.col("city").isNotNull())
        .groupBy("city").agg(F.count(F.lit(1)).alias("n_businesses"))
        .orderBy(F.desc("n_businesses"), "city").limit(n)
    )


def select_businesses(
    businesses: DataFrame,
    cities: Sequence[str] | None = None,
    n_auto: int = 5,
    labels: Sequence[str] = DINING_CATEGORIES,
) -> DataFrame:
    """Dining businesses in the given cities, or in the busiest ones when no list is given."""
    dining = dining_filter(businesses, labels)
    if cities is not None:
        kept = dining.where(F.col("city").isin(list(cities)))
    else:
        # n_auto rows
        cities = auto_cities(dining, n_auto).select("city")
        kept = dining.join(cities if n_auto > BROADCAST_IDS else F.broadcast(cities), "city", "left_semi")
    return kept.withColumns({c: to_number(F.col(c)) for c in ("stars", "review_count")})


def cohort_reviews(reviews: DataFrame, businesses: DataFrame) -> DataFrame:
    """Reviews of the kept businesses, with the text reduced to its length at the scan."""
    narrow = reviews.select(
        "user_id", "business_id", "stars", "date",
        F.length("text").cast("long").alias("review_len"),
        F.col("useful").cast("long").alias("useful"),
    )
    return narrow.join(businesses.select("business_id"), "business_id", "left_semi").select(*narrow.columns)


def _degrees_after(degrees: DataFrame, key: str, lost: DataFrame) -> DataFrame:
    """Row counts per vertex minus the rows lost with the other side's dropped vertices."""
    losses = lost.groupBy(key).agg(F.count(F.lit(1)).alias("lost"))
    return cut_lineage(
        degrees.join(losses, key, "left").select(key, (F.col("n") - F.coalesce("lost", F.lit(0))).alias("n"))
    )


def kcore(interactions: DataFrame, min_user: int = 5, min_item: int = 10) -> DataFrame:
    """Largest subset in which every user has >= min_user rows and every business >= min_item rows.

    Peeling: row counts per vertex are aggregated once and then only corrected. Each step takes the rows
    of the vertices that have just fallen below their threshold and subtracts them on the other side, so
    the table of edges is scanned but never regrouped, and written anew whenever half of it has fallen; while
    the list of fallen vertices is short (its length is known) it is broadcast and the edges do not move. Full rows
    are filtered once, at the end.
    """
    edges = keep_table(interactions.select("user_id", "business_id"), "edges")
    n_edges = n_written = edges.count()
    sides = [("user_id", min_user), ("business_id", min_item)]
    degrees = {
        key: cut_lineage(edges.groupBy(key).agg(F.count(F.lit(1)).alias("n"))) for key, _ in sides
    }
    idle = 0
    while idle < len(sides):
        for (key, least), (other, _) in (sides, sides[::-1]):
            fallen = degrees[key].where(F.col("n") < least).select(key)
            n_fallen = fallen.count()
            idle = idle + 1 if n_fallen == 0 else 0
            if n_fallen:
                ids = F.broadcast(fallen) if n_fallen <= BROADCAST_IDS else fallen
                n_edges -= degrees[key].where(F.col("n") < least).agg(F.sum("n")).first()[0]
                degrees[other] = _degrees_after(degrees[other], other, edges.join(ids, key, "left_semi"))
                degrees[key] = degrees[key].where(F.col("n") >= least)
                if n_edges * 2 <= n_written:  # the scan has become half empty: write what is left
                    for side, _ in sides:
                        edges = edges.join(degrees[side].select(side), side, "left_semi")
                    edges, n_written = keep_table(edges, "edges"), n_edges
            if idle >= len(sides):
                break
    kept = interactions
    for key, _ in sides:
        kept = kept.join(degrees[key].select(key), key, "left_semi")
    return kept.select(*interactions.columns)


def split_cuts(
    interactions: DataFrame, train_frac: float = 0.70, valid_frac: float = 0.15
) -> tuple[float | None, float | None]:
    """The two cut instants in microseconds: exact global date quantiles."""
    instant = micros(F.col("date"))
    row = exact_quantiles(interactions, instant, (train_frac, train_frac + valid_frac), HOUR_MICROS).first()
    return row.q0, row.q1


def temporal_split(
    interactions: DataFrame, train_frac: float = 0.70, valid_frac: float = 0.15
) -> DataFrame:
    """Tag rows train / valid / test by date; null dates count as test.

    The cuts are found first and enter the plan as literals, so the split adds no shuffle.
    """
    train_end, valid_end = split_cuts(interactions, train_frac, valid_frac)
    instant = micros(F.col("date"))
    split = (
        F.when(instant <= F.lit(train_end), "train")
        .when(instant <= F.lit(valid_end), "valid")
        .otherwise("test")
    )
    return interactions.withColumn("split", split)


def surviving_businesses(businesses: DataFrame, interactions: DataFrame) -> DataFrame:
    ids = interactions.select("business_id").distinct()
    return businesses.join(ids, "business_id", "left_semi").select(*businesses.columns)


def split_counts(split: DataFrame) -> DataFrame:
    """Rows, users and businesses per split."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("business_id").alias("n_businesses"),
    )
