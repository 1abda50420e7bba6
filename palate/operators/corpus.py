"""Review-text corpus, retrieval split and same-business pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from palate.functions.sampling import dense_index, hash_int, hash_sample, seeded_hash
from palate.functions.text import strip
from palate.session import cut_lineage

# A sample of at most this many review ids is broadcast to the texts.
BROADCAST_IDS = 500_000


def build_corpus(
    reviews: DataFrame,
    businesses: DataFrame | None = None,
    min_chars: int = 40,
    max_chars: int | None = None,
    per_business: int | None = None,
    size: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Substantial reviews of the cohort: review_id, business_id, stars, text.

    Texts stay whole and every review is kept. `max_chars` asks for a cut, `per_business` and `size` for seeded
    samples. The per-business sample ranks hashes, and rank <= n is pushed into each
    map task, so a business with most of the reviews sends only its n best rows per task.
    """
    rows = reviews.select("review_id", "business_id", "stars", F.translate(strip(F.col("text")), "\n", " ").alias("text"))
    rows = rows.where(F.length("text") >= min_chars)
    if businesses is not None:
        rows = rows.join(businesses.select("business_id"), "business_id", "left_semi")
    if max_chars is not None:
        rows = rows.withColumn("text", F.substring("text", 1, max_chars))
    if per_business is None and size is None:
        return rows
    # choose by ids alone: texts are only read again for the chosen reviews and never shuffled
    ids = rows.select("review_id", "business_id")
    if per_business is not None:
        by_hash = Window.partitionBy("business_id").orderBy("_hash", "review_id")
        ids = (
            ids.withColumn("_hash", seeded_hash(F.col("review_id"), seed))
            .withColumn("_place", F.row_number().over(by_hash))
            .where(F.col("_place") <= per_business)
        )
    ids = cut_lineage(ids.select("review_id"))
    if size is not None:
        ids = hash_sample(ids, "review_id", size, seed)
        if size <= BROADCAST_IDS:
            ids = F.broadcast(ids)
    return rows.join(ids, "review_id", "left_semi").select("review_id", "business_id", "stars", "text")


def retrieval_split(corpus: DataFrame, share: float = 0.15, seed: int = 42) -> DataFrame:
    """Businesses with at least two reviews: floor(share * n) of them 'eval', the others 'train'."""
    # one row per business, read by the sample's jobs and the join: kept once
    eligible = cut_lineage(
        corpus.groupBy("business_id").agg(F.count(F.lit(1)).alias("n_reviews"))
        .where(F.col("n_reviews") >= 2)
    )
    quota = int(eligible.count() * share)
    chosen = hash_sample(eligible.select("business_id"), "business_id", quota, seed)
    return eligible.join(chosen.withColumn("role", F.lit("eval")), "business_id", "left").select(
        "business_id", "n_reviews", F.coalesce("role", F.lit("train")).alias("role")
    )


def eval_query_ids(corpus: DataFrame, split: DataFrame, size: int | None = None, seed: int = 42) -> DataFrame:
    """The eval businesses' reviews, or a seeded sample of `size` of them."""
    held_out = split.where(F.col("role") == "eval").select("business_id")
    reviews = corpus.select("review_id", "business_id").join(held_out, "business_id", "left_semi")
    return reviews.select("review_id", "business_id") if size is None else hash_sample(
        reviews, "review_id", size, seed).select("review_id", "business_id")


def mine_pairs(corpus: DataFrame, train: DataFrame, n: int = 25_000, seed: int = 42) -> DataFrame:
    """n pairs of distinct reviews of one business; businesses are drawn uniformly with replacement.

    Draw p takes a business by hash, then two different positions inside it. Positions come from
    `dense_index`, so each draw is two equi joins on (business, position), hot business or not.
    """
    reviews = cut_lineage(dense_index(
        corpus.select("review_id", "business_id").join(train.select("business_id"), "business_id", "left_semi"),
        "review_id", "place", ("business_id",),
    ))
    groups = dense_index(
        reviews.groupBy("business_id").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= 2),
        "business_id", "ix",
    )
    n_groups = groups.agg(F.count(F.lit(1))).scalar()

    def draw(label: str):
        return hash_int(F.concat(F.lit(f"{label}|{seed}|"), F.col("pair_id").cast("string")))

    draws = (
        corpus.sparkSession.range(n).withColumnRenamed("id", "pair_id")
        .withColumn("ix", F.try_mod(draw("business"), n_groups))
        .join(groups, "ix")
        .withColumn("first", F.pmod(draw("anchor"), F.col("size")))
        .withColumn("other", F.pmod(draw("positive"), F.col("size") - 1))
        .withColumn("second", F.when(F.col("other") >= F.col("first"), F.col("other") + 1).otherwise(F.col("other")))
    )
    anchors = reviews.select("business_id", F.col("place").alias("first"), F.col("review_id").alias("anchor_id"))
    positives = reviews.select("business_id", F.col("place").alias("second"), F.col("review_id").alias("positive_id"))
    return (
        draws.join(anchors, ["business_id", "first"]).join(positives, ["business_id", "second"])
        .select("pair_id", "business_id", "anchor_id", "positive_id")
    )
