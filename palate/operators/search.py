"""Search over review vectors, pooling to businesses, and retrieval quality."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from palate.functions.numbers import percent_lift
from palate.operators.cells import build_cells, cell_topk
from palate.operators.topk import best_groups, topk_inner_product
from palate.session import cut_lineage

ELLIPSIS = "…"
# Hit lists (queries * k short rows) are broadcast up to this count, so the corpus is joined in place.
BROADCAST_HITS = 1_000_000


def _normalised(vector: Column) -> Column:
    """Unit vector, or null for a zero one."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))
    return F.when(norm > 0, F.transform(vector, lambda x: x / norm))


def mean_unit_vectors(rows: DataFrame, key: str, vector: str, out: str = "vec") -> DataFrame:
    """Normalised mean vector per key; combined on the map side, zero means are left out."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return (
        rows.groupBy(key).agg(vector_to_array(mean).alias("_mean"))
        .select(key, _normalised(F.col("_mean")).alias(out))
        .where(F.col(out).isNotNull())
    )


def vector_topk(queries: DataFrame, corpus: DataFrame, k: int = 10, **how) -> DataFrame:
    """queries: query_id, embedding; corpus: review_id, embedding -> query_id, review_id, score, rank."""
    return topk_inner_product(
        queries.select("query_id", F.col("embedding").alias("vec")),
        corpus.select(F.col("review_id").alias("item_id"), F.col("embedding").alias("vec")),
        k, **how,
    ).withColumnRenamed("item_id", "review_id")


def write_vector_index(corpus: DataFrame, folder: str, **how) -> None:
    """corpus: review_id, embedding -> an index of cells in `folder`."""
    build_cells(corpus.select(F.col("review_id").alias("item_id"), F.col("embedding").alias("vec")), folder, **how)


def indexed_topk(spark: SparkSession, queries: DataFrame, folder: str, k: int = 10, **how) -> DataFrame:
    """The rows of `vector_topk` from an index that was written: only cells that can hold a hit are read."""
    asked = queries.select("query_id", F.col("embedding").alias("vec"))
    return cell_topk(spark, asked, folder, k, **how).withColumnRenamed("item_id", "review_id")


def _beside_corpus(hits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    return F.broadcast(hits) if queries.count() * k <= BROADCAST_HITS else hits


def search_reviews(
    queries: DataFrame, corpus: DataFrame, businesses: DataFrame, k: int = 10
) -> DataFrame:
    """Top-k reviews per query with the business they describe; `stars` is the business rating."""
    hits = vector_topk(queries, corpus, k)
    places = businesses.select("business_id", "name", "city", "stars")
    texts = corpus.select("review_id", "business_id", F.col("stars").alias("review_stars"), "text")
    return (
        _beside_corpus(hits, queries, k).join(texts, "review_id").join(places, "business_id", "left")
        .select("query_id", "rank", "review_id", "business_id", "name", "city", "stars", "review_stars", "score", "text")
    )


def search_businesses(
    queries: DataFrame,
    corpus: DataFrame,
    businesses: DataFrame,
    k: int = 10,
    pool: int | None = None,
    snippet_chars: int = 160,
) -> DataFrame:
    """Top-k businesses per query: best score, number of hits, and the best hit's snippet.

    Every review is a hit unless `pool` narrows the hits to the best so many reviews, which can leave fewer than k
    businesses. Only (query, business, score, review) move; texts are fetched for the k winners.
    """
    winners = _all_businesses(queries, corpus, k) if pool is None else _pooled_businesses(queries, corpus, k, pool)
    places = businesses.select("business_id", "name", "city", "stars", "categories")
    snippet = F.concat(F.substring("text", 1, snippet_chars), F.lit(ELLIPSIS))
    return (
        _beside_corpus(winners, queries, k).join(corpus.select("review_id", "text"), "review_id")
        .join(places, "business_id", "left")
        .select("query_id", "place", "business_id", "name", "city", "stars", "categories", "match", "n_hits",
                snippet.alias("snippet"))
    )


def _all_businesses(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """query_id, business_id, match, n_hits, place, review_id over all reviews."""
    best = best_groups(
        queries.select("query_id", F.col("embedding").alias("vec")),
        corpus.select(F.col("review_id").alias("item_id"), F.col("business_id").alias("group_id"), F.col("embedding").alias("vec")), k)
    sizes = corpus.groupBy("business_id").agg(F.count(F.lit(1)).alias("n_hits"))
    return best.select(
        "query_id", F.col("group_id").alias("business_id"), F.col("score").alias("match"), F.col("rank").alias("place"),
        F.col("item_id").alias("review_id")).join(sizes, "business_id")


def _pooled_businesses(queries: DataFrame, corpus: DataFrame, k: int, pool: int) -> DataFrame:
    hits = _beside_corpus(vector_topk(queries, corpus, pool), queries, pool)
    pooled = hits.join(corpus.select("review_id", "business_id"), "review_id").groupBy("query_id", "business_id").agg(
        F.max("score").alias("match"),
        F.count(F.lit(1)).alias("n_hits"),
        F.min(F.struct("rank", "review_id")).alias("best"),
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("match"), "business_id")
    return (
        pooled.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        .withColumn("review_id", F.col("best.review_id")).drop("best")
    )


def retrieval_ranks(corpus: DataFrame, query_ids: DataFrame, k: int = 10) -> DataFrame:
    """Per query review: rank of the first other review of the same business in its top-k, or null."""
    queries = corpus.join(query_ids.select("review_id"), "review_id", "left_semi")
    found = vector_topk(queries.select(F.col("review_id").alias("query_id"), "embedding"), corpus, k + 1)
    owners = corpus.select("review_id", "business_id")
    # the query itself may be anywhere in the list, or beyond it: drop it, renumber, keep k
    order = Window.partitionBy("query_id").orderBy("rank")
    others = (
        found.where(F.col("review_id") != F.col("query_id"))
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    )
    others = (
        _beside_corpus(others, query_ids, k).join(owners, "review_id")
        .join(queries.select(F.col("review_id").alias("query_id"), F.col("business_id").alias("own")), "query_id")
    )
    first = others.where(F.col("business_id") == F.col("own")).groupBy("query_id").agg(F.min("place").alias("first_hit"))
    return (
        queries.select(F.col("review_id").alias("query_id"), "business_id")
        .join(first, "query_id", "left")
    )


def eval_retrieval(corpus: DataFrame, query_ids: DataFrame, k: int = 10) -> DataFrame:
    """Hit@k and MRR@k of same-business retrieval, as one row."""
    ranks = retrieval_ranks(corpus, query_ids, k)
    return ranks.agg(
        F.coalesce(F.avg(F.col("first_hit").isNotNull().cast("double")), F.lit(0.0)).alias("hit"),
        F.coalesce(F.avg(F.coalesce(F.lit(1.0) / F.col("first_hit"), F.lit(0.0))), F.lit(0.0)).alias("mrr"),
        F.count(F.lit(1)).alias("n_queries"),
    )


def retrieval_lift(base: DataFrame, adapted: DataFrame) -> DataFrame:
    """Base and adapted quality with percentage lift over the base; each is evaluated once."""
    base, adapted = cut_lineage(base), cut_lineage(adapted)
    start = base.select(F.struct("hit", "mrr").alias("start")).scalar()
    rows = base.withColumn("encoder", F.lit("base")).unionByName(adapted.withColumn("encoder", F.lit("adapted")))
    return rows.select(
        "encoder", "hit", "mrr", "n_queries",
        percent_lift(F.col("hit"), start["hit"]).alias("hit_lift_pct"),
        percent_lift(F.col("mrr"), start["mrr"]).alias("mrr_lift_pct"),
    )
