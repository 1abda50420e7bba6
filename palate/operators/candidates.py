"""Labels, confidences, target users and the per-(user, candidate) ranking frame."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from palate.config import STAR_TO_GAIN
from palate.functions.sampling import dense_index, hash_sample, ordered_index
from palate.operators.features import cross_features
from palate.session import cut_lineage, keep_table


# A cut to so many users is broadcast.
BROADCAST_USERS = 100_000
# Popularity places up to this one are broadcast; features of so many candidate businesses are.
BROADCAST_PLACES = 1_000_000
BROADCAST_BUSINESSES = 100_000
# Rows of the frame, or of its candidates, that a task reads: by bytes, which compress well, a task would get millions.
FRAME_ROWS = 500_000


def star_gain(stars: Column) -> Column:
    """Graded relevance of a star value; unlisted values give 0."""
    gain = F.lit(0)
    for value, points in STAR_TO_GAIN.items():
        gain = F.when(stars == value, points).otherwise(gain)
    return gain


def id_index(interactions: DataFrame, column: str) -> DataFrame:
    """Dense 0..n-1 index of a column's distinct ids: (column, ix)."""
    return dense_index(interactions.select(column).distinct(), column, "ix")


def confidence_matrix(history: DataFrame, alpha: float = 12.0) -> DataFrame:
    """1 + alpha * gain per row, summed over repeat visits."""
    confidence = F.lit(1.0) + F.lit(alpha) * star_gain(F.col("stars"))
    return history.groupBy("user_id", "business_id").agg(F.sum(confidence).alias("confidence"))


def label_gains(labels: DataFrame) -> DataFrame:
    """Best gain per (user, business) in a label window."""
    return labels.groupBy("user_id", "business_id").agg(F.max(star_gain(F.col("stars"))).alias("gain"))


def relevance(labels: DataFrame, users: DataFrame) -> DataFrame:
    """Positive gains of the given users."""
    return (
        label_gains(labels).where(F.col("gain") > 0)
        .join(users.select("user_id").hint("shuffle_hash"), "user_id", "left_semi")
        .select("user_id", "business_id", "gain")
    )


def target_users(labels: DataFrame, history: DataFrame, size: int | None = None, seed: int = 42) -> DataFrame:
    """Known users with a positive in the label window, or a seeded sample of `size` of them."""
    known = history.select("user_id").distinct()
    pool = cut_lineage(relevance(labels, known).select("user_id").distinct())
    return pool if size is None else hash_sample(pool, "user_id", size, seed)


def fit_stop_split(targets: DataFrame, share: float = 0.85, seed: int = 42) -> DataFrame:
    """Tag floor(share * n) targets 'fit' and the rest 'stop' (early stopping)."""
    targets = cut_lineage(targets.select("user_id"))
    quota = int(targets.count() * share)
    fit = hash_sample(targets.select("user_id"), "user_id", quota, seed).select("user_id")
    return targets.select("user_id").join(
        fit.withColumn("part", F.lit("fit")), "user_id", "left"
    ).select("user_id", F.coalesce("part", F.lit("stop")).alias("part"))


def popularity_candidates(targets: DataFrame, history: DataFrame, n: int = 100) -> DataFrame:
    """Top-n businesses by history volume that the user has not visited, shaped like ALS candidates."""
    # one global order; a user reads it only as far as n places beyond what the user has seen
    volume = history.groupBy("business_id").agg(F.count(F.lit(1)).cast("double").alias("volume"))
    order = cut_lineage(ordered_index(volume, [F.desc("volume"), F.asc("business_id")], "place"))  # one row per business
    # places are hashed: the history, many rows a business, is not sorted by it
    ranked = seen_pairs(history, targets).join(
        order.select(F.col("business_id").alias("item_id"), "place").hint("shuffle_hash"), "item_id")
    users = keep_table(
        targets.select(F.col("user_id").alias("query_id"))
        .join(ranked.groupBy("query_id").agg(F.collect_set("place").alias("seen")), "query_id", "left")
        .select("query_id", F.coalesce("seen", F.expr("cast(array() as array<bigint>)")).alias("seen")), "seen")
    # a user's list is made in place: the first n places that the user has not seen
    unseen = F.slice(F.array_except(F.sequence(F.lit(1).cast("long"), F.size("seen").cast("long") + n), F.col("seen")), 1, n)
    reach = users.select("query_id", F.posexplode(unseen).alias("cf_rank", "place"))
    last = (users.agg(F.max(F.size("seen"))).first()[0] or 0) + n
    read = order.where(F.col("place") <= last)
    # places that no business holds are the last ones and fall out of the join
    return reach.join(F.broadcast(read) if last <= BROADCAST_PLACES else read, "place").select(
        F.col("query_id").alias("user_id"), "business_id", F.col("volume").alias("als_score"), "cf_rank")


def seen_pairs(history: DataFrame, targets: DataFrame) -> DataFrame:
    return (
        history.join(targets.select("user_id"), "user_id", "left_semi")
        .select(F.col("user_id").alias("query_id"), F.col("business_id").alias("item_id"))
    )


def as_candidates(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("query_id").alias("user_id"), F.col("item_id").alias("business_id"),
        F.col("score").alias("als_score"), (F.col("rank") - 1).alias("cf_rank"),
    )


def inject_positives(candidates: DataFrame, positives: DataFrame, sentinel: int) -> DataFrame:
    """Add scored label positives that are not candidates yet, ranked at the sentinel."""
    # candidates, of which there are many per positive, are met by hashed positives and not sorted
    pair = ["user_id", "business_id"]
    there = candidates.select(*pair).join(positives.select(*pair).hint("shuffle_hash"), pair, "left_semi")
    missing = positives.join(there, pair, "left_anti").select(
        "user_id", "business_id", "als_score", F.lit(sentinel).alias("cf_rank")
    )
    return candidates.unionByName(missing)


def frame_parts(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / FRAME_ROWS))


def ranking_frame(
    candidates: DataFrame, labels: DataFrame, user_feats: DataFrame, business_feats: DataFrame
) -> DataFrame:
    """Candidates with graded labels, user and business features and cross features.

    Users or businesses without features never reach the frame. Candidates are kept once and move by user while they are
    narrow: a user's labels come along with the user's features. Features of few businesses travel to the candidates.
    Candidates, of which there are many per user, are neither broadcast nor sorted: a task holds the features of its own
    users and reads about FRAME_ROWS candidates.
    """
    candidates = keep_table(candidates, "candidates")
    labelled = label_gains(labels).where("business_id IS NOT NULL").groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("business_id", "gain"))).alias("_gains"))
    wanted = candidates.select("business_id").distinct()
    if wanted.count() <= BROADCAST_BUSINESSES:
        business_feats = F.broadcast(business_feats.join(F.broadcast(wanted), "business_id", "left_semi"))
    # the columns of joins by name: the last key first
    columns = ["business_id", "user_id", *[c for t in (candidates, user_feats, business_feats) for c in [
        *t.columns, *(["label"] if t is candidates else [])] if c not in ("user_id", "business_id")]]
    parts = frame_parts(candidates.sparkSession, candidates.count())
    joined = (
        candidates.repartition(parts, "user_id")
        .join(user_feats.join(labelled, "user_id", "left").repartition(parts, "user_id").hint("shuffle_hash"), "user_id")
        .withColumn("label", F.coalesce(F.element_at("_gains", F.col("business_id")), F.lit(0)))
        .join(business_feats, "business_id").select(*columns)
    )
    return cross_features(joined)


def rank_by(frame: DataFrame, score: str | Column, rows: int | None = None) -> DataFrame:
    """Rankings (user_id, business_id, rank from 1) by descending score, ties by business id.

    `rows`, the number of the frame's rows where it is known (a kept frame), bounds what a task sorts.
    """
    value = F.col(score) if isinstance(score, str) else score
    best_first = Window.partitionBy("user_id").orderBy(F.desc("score"), "business_id")
    scored = frame.select("user_id", "business_id", value.alias("score"))
    if rows is not None:
        scored = scored.repartition(frame_parts(frame.sparkSession, rows), "user_id")
    return scored.select("user_id", "business_id", F.row_number().over(best_first).alias("rank"))


def rank_popularity(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """Reorders the user's own candidates by overall review count (not a global list)."""
    return rank_by(frame, "b_global_review_count", rows)


def rank_als(frame: DataFrame, rows: int | None = None) -> DataFrame:
    return rank_by(frame, "als_score", rows)


def demo_recs(
    rankings: DataFrame, relevant: DataFrame, businesses: DataFrame, n_users: int | None = None, k: int = 10
) -> DataFrame:
    """Top-k of every ranked user, or of the first n_users by id, with business details and a visited flag."""
    if n_users is not None:
        shown = rankings.where(F.col("rank") == 1).select("user_id").orderBy("user_id").limit(n_users)
        rankings = rankings.join(F.broadcast(shown) if n_users <= BROADCAST_USERS else shown, "user_id", "left_semi")
    visited = relevant.select("user_id", "business_id", F.lit(True).alias("hit"))
    details = businesses.select("business_id", "name", "city", "categories", F.lit(True).alias("known"))
    known = F.col("known").isNotNull()
    return (
        rankings.where(F.col("rank") <= k)
        .join(details.hint("shuffle_hash"), "business_id", "left")
        .join(visited, ["user_id", "business_id"], "left")
        .select(
            "user_id", "rank", "business_id",
            F.when(known, F.col("name")).otherwise(F.col("business_id").cast("string")).alias("name"),
            F.when(known, F.col("city")).otherwise("").alias("city"),
            F.when(known, F.col("categories")).otherwise("").alias("categories"),
            F.coalesce("hit", F.lit(False)).alias("visited_in_test"),
        )
    )


def demo_hits(demo: DataFrame) -> DataFrame:
    return demo.groupBy("user_id").agg(F.sum(F.col("visited_in_test").cast("long")).alias("hits"))
