"""Ranking quality: NDCG, Recall and MAP at k from long tables of ranks and gains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from palate.functions.numbers import percent_lift, round_half_even


def _discounted(gain: Column, rank: Column) -> Column:
    return (F.pow(F.lit(2.0), gain) - 1.0) / F.log2(rank + F.lit(1.0))


def user_metrics(rankings: DataFrame, relevance: DataFrame, k: int) -> DataFrame:
    """NDCG, Recall and average precision per user that appears in both tables.

    rankings: user_id, business_id, rank (from 1); relevance: user_id, business_id, gain > 0.
    Ranks beyond k are dropped before the join, so nothing wider than k rows per user is sorted. Who is ranked at all needs
    no ranks: the rankings are sorted once.
    """
    ranked_users = rankings.select("user_id").distinct()
    relevant = relevance.where(F.col("gain") > 0)
    best_first = Window.partitionBy("user_id").orderBy(F.desc("gain"), "business_id")
    ideal = (
        relevant.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= k)
        .groupBy("user_id").agg(F.sum(_discounted(F.col("gain"), F.col("place"))).alias("ideal"))
    )
    totals = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    hits = rankings.where(F.col("rank") <= k).join(relevant, ["user_id", "business_id"])
    so_far = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    scored = (
        hits.withColumn("precision", F.count(F.lit(1)).over(so_far) / F.col("rank"))
        .groupBy("user_id")
        .agg(
            F.sum(_discounted(F.col("gain"), F.col("rank"))).alias("dcg"),
            F.count(F.lit(1)).alias("n_hits"),
            F.sum("precision").alias("precision_sum"),
        )
    )
    zero = F.lit(0.0)
    return (
        totals.join(ideal, "user_id").join(ranked_users, "user_id", "left_semi")
        .join(scored, "user_id", "left")
        .select(
            "user_id",
            F.coalesce(F.col("dcg") / F.col("ideal"), zero).alias("ndcg"),
            F.coalesce(F.col("n_hits") / F.col("n_relevant"), zero).alias("recall"),
            F.coalesce(
                F.col("precision_sum") / F.least(F.col("n_relevant"), F.lit(k)), zero
            ).alias("ap"),
        )
    )


def evaluate_rankings(rankings: DataFrame, relevance: DataFrame, k: int = 10) -> DataFrame:
    """Means over users as one row; zeros when no user qualifies."""
    zero = F.lit(0.0)
    return user_metrics(rankings, relevance, k).agg(
        F.coalesce(F.avg("ndcg"), zero).alias("ndcg"),
        F.coalesce(F.avg("recall"), zero).alias("recall"),
        F.coalesce(F.avg("ap"), zero).alias("map"),
        F.count(F.lit(1)).alias("n_users"),
    )


def comparison_table(results: dict[str, DataFrame]) -> DataFrame:
    """One row per method with percentage lift over the first method, rounded to 4 digits."""
    rows = reduce(DataFrame.unionByName, [
        metrics.select(F.lit(i).alias("position"), F.lit(method).alias("method"), *metrics.columns)
        for i, (method, metrics) in enumerate(results.items())
    ])
    whole = Window.partitionBy()  # one row per method
    columns = []
    for name in ("ndcg", "recall", "map"):
        base = F.max(F.when(F.col("position") == 0, F.col(name))).over(whole)
        columns.append(round_half_even(F.col(name), 4).alias(name))
        columns.append(round_half_even(percent_lift(F.col(name), base), 4).alias(f"{name}_lift_pct"))
    return rows.select("position", "method", *columns, "n_users").orderBy("position")


def method_lift(results: dict[str, DataFrame], better: str, base: str) -> DataFrame:
    """NDCG lift of one method over another."""
    b = results[base].select("ndcg").scalar()
    return results[better].select(
        F.lit(better).alias("method"), F.lit(base).alias("over"),
        percent_lift(F.col("ndcg"), b).alias("ndcg_lift_pct"),
    )
