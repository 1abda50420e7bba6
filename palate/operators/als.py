"""Implicit-feedback ALS: fit on confidences, exact unseen top-N, scores of given pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, functions as F

from palate.operators.candidates import as_candidates, confidence_matrix, id_index, seen_pairs
from palate.operators.factorize import CHECKPOINT_EVERY, fit_blocks
from palate.operators.topk import topk_inner_product
from palate.session import cut_lineage, freeing_shuffles, keep_table, shared_dir

# A visit without gain still counts as observed: its rating must stay above zero.
SMALLEST_RATING = 1e-6


def als_ratings(history: DataFrame, alpha: float) -> DataFrame:
    """Ratings r with 1 + alpha * r equal to the summed confidence of the pair."""
    rating = F.greatest((F.col("confidence") - 1.0) / F.lit(alpha), F.lit(SMALLEST_RATING))
    return confidence_matrix(history, alpha).select("user_id", "business_id", rating.alias("rating"))


@dataclass(frozen=True)
class AlsFactors:
    """Factors keyed by the original ids."""

    users: DataFrame  # user_id, vec
    items: DataFrame  # business_id, vec


def als_fit(
    history: DataFrame,
    factors: int = 96,
    iterations: int = 20,
    regularization: float = 0.05,
    alpha: float = 12.0,
    seed: int = 42,
    blocks: int | None = None,
) -> AlsFactors:
    shared_dir(history.sparkSession)  # the fit cuts its lineage there
    users = id_index(history, "user_id").withColumn("ix", F.col("ix").cast("int")).persist()
    items = id_index(history, "business_id").withColumn("ix", F.col("ix").cast("int")).persist()
    indexed = keep_table(
        als_ratings(history, alpha)
        .join(users.withColumnRenamed("ix", "user_ix"), "user_id")
        .join(items.withColumnRenamed("ix", "item_ix"), "business_id")
        .select("user_ix", "item_ix", "rating"), "ratings")
    # the first user factors are those of Spark's fit without iterations, which depend on the users' numbers alone
    als = ALS(
        userCol="user_ix", itemCol="item_ix", ratingCol="rating", implicitPrefs=True,
        rank=factors, maxIter=0, regParam=regularization, alpha=alpha, seed=seed,
        checkpointInterval=CHECKPOINT_EVERY,
    )
    if blocks is not None:
        als = als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    with freeing_shuffles(history.sparkSession):
        start = als.fit(indexed.select("user_ix").distinct().select("user_ix", F.lit(0).alias("item_ix"), F.lit(1.0).alias("rating"))).userFactors
        user_factors, item_factors = fit_blocks(indexed, start, iterations, regularization, alpha, blocks)
    named_users = users.join(user_factors, users["ix"] == user_factors["id"])
    named_items = items.join(item_factors, items["ix"] == item_factors["id"])
    # read by candidates and by pair scores: keep them once, without the training lineage
    fitted = AlsFactors(
        cut_lineage(named_users.select("user_id", F.col("features").alias("vec"))),
        cut_lineage(named_items.select("business_id", F.col("features").alias("vec"))),
    )
    users.unpersist()
    items.unpersist()
    return fitted


def als_candidates(
    model: AlsFactors, targets: DataFrame, history: DataFrame, n: int = 100
) -> DataFrame:
    """Top-n unseen businesses per known target: user_id, business_id, als_score, cf_rank from 0."""
    known = model.users.join(targets.select("user_id"), "user_id", "left_semi")
    found = topk_inner_product(
        known.select(F.col("user_id").alias("query_id"), "vec"),
        model.items.select(F.col("business_id").alias("item_id"), "vec"),
        n,
        exclude=seen_pairs(history, targets),
    )
    return as_candidates(found)


def als_score_pairs(model: AlsFactors, pairs: DataFrame) -> DataFrame:
    """Factor dot product of given pairs; pairs with an unknown id are left out."""
    dot = F.aggregate(
        F.zip_with("user_vec", "item_vec", lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0), lambda total, x: total + x,
    )
    return (
        pairs.select("user_id", "business_id")
        .join(model.users.withColumnRenamed("vec", "user_vec"), "user_id")
        .join(model.items.withColumnRenamed("vec", "item_vec"), "business_id")
        .select("user_id", "business_id", dot.alias("als_score"))
    )
