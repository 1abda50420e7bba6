"""Review corpus, pairs, exact vector search and retrieval quality."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks.common import Check, canonical, compose, view
from checks.views import CTES
from palate.config import Settings
from palate.functions.text import WHITESPACE_CHARS
from palate.operators import corpus as c, encode, search as s, wordvec
from palate.plans.search import build_search, corpus_of, open_search
from palate.session import cut_lineage, keep_table, scratch_path, shared_dir
from palate.sources.artifacts import write_artifact


def _corpus_sql(source: str, cap: int | None = None, size: int | None = None) -> str:
    strip = f"replace(trim(text, '{WHITESPACE_CHARS}'), chr(10), ' ')"
    rows = f"SELECT review_id, business_id, stars, t AS text FROM (SELECT *, {strip} AS t FROM {source}) WHERE length(t) >= 40"
    if cap is None:
        return rows
    return f"""SELECT * EXCLUDE (p) FROM (SELECT *, row_number() OVER (PARTITION BY business_id
               ORDER BY md5(review_id::VARCHAR || '|42'), review_id) AS p FROM ({rows})) WHERE p <= {cap}
               ORDER BY md5(review_id::VARCHAR || '|42') LIMIT {size}"""


def split_ctes(source: str, prefix: str) -> dict:
    return {
        f"{prefix}_split": ((source,), f"""
            SELECT business_id, n_reviews,
                   CASE WHEN row_number() OVER (ORDER BY md5(business_id::VARCHAR || '|42')) <= floor(0.15 * count(*) OVER ())
                        THEN 'eval' ELSE 'train' END AS role
            FROM (SELECT business_id, count(*) AS n_reviews FROM {source} GROUP BY 1 HAVING count(*) >= 2)"""),
        f"{prefix}_queries": ((source, f"{prefix}_split"), f"""
            SELECT review_id, business_id FROM {source}
            WHERE business_id IN (SELECT business_id FROM {prefix}_split WHERE role = 'eval')
            """),
    }


def pair_ctes(source: str, prefix: str, n: int) -> dict:
    """The mined pairs of a corpus with a split; the last CTE is `<prefix>_pairs`."""
    placed, groups, drawn = f"{prefix}_placed", f"{prefix}_groups", f"{prefix}_drawn"
    return {
        placed: ((source, f"{prefix}_split"), f"""
            SELECT review_id, business_id, row_number() OVER (PARTITION BY business_id
                   ORDER BY substr(md5(review_id::VARCHAR), 1, 3), review_id) - 1 AS place
            FROM {source} WHERE business_id IN (SELECT business_id FROM {prefix}_split WHERE role = 'train')"""),
        groups: ((placed,), f"""
            SELECT business_id, count(*) AS size,
                   row_number() OVER (ORDER BY substr(md5(business_id::VARCHAR), 1, 3), business_id) - 1 AS ix
            FROM {placed} GROUP BY business_id HAVING count(*) >= 2"""),
        drawn: ((groups,), f"""
            SELECT pair_id, business_id, first, CASE WHEN other >= first THEN other + 1 ELSE other END AS second
            FROM (SELECT pair_id, business_id, ('0x' || substr(md5('anchor|42|' || pair_id), 1, 8))::BIGINT % size AS first,
                         ('0x' || substr(md5('positive|42|' || pair_id), 1, 8))::BIGINT % (size - 1) AS other
                  FROM (SELECT range AS pair_id, ('0x' || substr(md5('business|42|' || range), 1, 8))::BIGINT
                               % (SELECT count(*) FROM {groups}) AS ix FROM range({n})) JOIN {groups} USING (ix))"""),
        f"{prefix}_pairs": ((drawn, placed), f"""
            SELECT pair_id, p.business_id, a.review_id AS anchor_id, b.review_id AS positive_id
            FROM {drawn} p JOIN {placed} a ON a.business_id = p.business_id AND a.place = first
            JOIN {placed} b ON b.business_id = p.business_id AND b.place = second"""),
    }


def _top_sql(queries: str, corpus: str, k: int) -> str:
    """queries: query_id, vec; corpus: item_id, vec."""
    return f"""SELECT query_id, item_id, score, rank FROM (
        SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank
        FROM (SELECT query_id, item_id, round(list_dot_product(q.vec, i.vec), 9) AS score FROM {queries} q, {corpus} i))
        WHERE rank <= {k}"""


CTES["corpus"] = (("reviews",), _corpus_sql("reviews"))
CTES["sampled_corpus"] = (("reviews",), _corpus_sql("reviews", 30, 300))
CTES.update(split_ctes("corpus", "text"))
CTES.update(split_ctes("review_vectors", "vec"))
CTES["vec_items"] = (("review_vectors",), "SELECT review_id AS item_id, embedding::DOUBLE[] AS vec FROM review_vectors")
CTES["vec_all_queries"] = (("review_vectors",), "SELECT review_id AS query_id, embedding::DOUBLE[] AS vec FROM review_vectors")
CTES["vec_eval_queries"] = (("vec_all_queries", "vec_queries"), """
    SELECT * FROM vec_all_queries WHERE query_id IN (SELECT review_id FROM vec_queries)""")
CTES["neighbours"] = (("corpus",), """
    SELECT t[i] AS a, t[i + d] AS b FROM (SELECT t, unnest(range(1, len(t) + 1)) AS i
      FROM (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM corpus)), range(1, 4) r(d) WHERE i + d <= len(t)""")
CTES["contexts"] = (("neighbours",), """
    SELECT word, context, count(*) AS n FROM (SELECT a AS word, b AS context FROM neighbours UNION ALL SELECT b, a FROM neighbours) GROUP BY 1, 2""")
CTES["margins"] = (("contexts",), "SELECT word, sum(n) AS n FROM contexts GROUP BY word")
CTES["hits10"] = (("vec_items", "vec_all_queries"), _top_sql("vec_all_queries", "vec_items", 10))
CTES["hits200"] = (("vec_items", "vec_all_queries"), _top_sql("vec_all_queries", "vec_items", 200))
CTES["all_hits"] = (("vec_items", "vec_all_queries"), _top_sql("vec_all_queries", "vec_items", 1_000_000_000))
CTES["eval_hits"] = (("vec_items", "vec_eval_queries", "review_vectors"), f"""
    SELECT query_id, a.business_id AS own, b.business_id AS found,
           row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place
    FROM ({_top_sql('vec_eval_queries', 'vec_items', 11)}) h JOIN review_vectors a ON a.review_id = query_id
    JOIN review_vectors b ON b.review_id = item_id WHERE item_id <> query_id""")


def _corpus(spark, sf_dir, **how):
    return c.build_corpus(view(spark, sf_dir, "reviews"), **how)


def _kept_corpus(spark, sf_dir):
    """Ids of the corpus, kept the way the corpus step keeps its output."""
    return cut_lineage(_corpus(spark, sf_dir).select("review_id", "business_id"))


def _digest(df):
    return canonical(df.withColumn("text", F.md5("text")))


def run_corpus(spark, sf_dir):
    return _digest(_corpus(spark, sf_dir))


def sampled_corpus(spark, sf_dir):
    return _digest(_corpus(spark, sf_dir, per_business=30, size=300))


def short_corpus(spark, sf_dir):
    return _digest(_corpus(spark, sf_dir, max_chars=1500))


def retrieval_split(spark, sf_dir):
    return canonical(c.retrieval_split(_kept_corpus(spark, sf_dir)))


def eval_queries(spark, sf_dir):
    corpus = _kept_corpus(spark, sf_dir)
    return canonical(c.eval_query_ids(corpus, c.retrieval_split(corpus)))


def eval_queries_50(spark, sf_dir):
    corpus = _kept_corpus(spark, sf_dir)
    return canonical(c.eval_query_ids(corpus, c.retrieval_split(corpus), 50))


def mine_pairs(spark, sf_dir):
    corpus = _kept_corpus(spark, sf_dir)
    split = cut_lineage(c.retrieval_split(corpus))
    return canonical(c.mine_pairs(corpus, split.where(F.col("role") == "train")))


def _vectors(spark, sf_dir):
    return view(spark, sf_dir, "review_vectors")


def _all_queries(spark, sf_dir):
    return _vectors(spark, sf_dir).select(F.col("review_id").alias("query_id"), "embedding")


def vector_topk(spark, sf_dir):
    return canonical(s.vector_topk(_all_queries(spark, sf_dir), _vectors(spark, sf_dir)))


def vector_topk_blocks(spark, sf_dir):
    found = s.vector_topk(_all_queries(spark, sf_dir), _vectors(spark, sf_dir), strategy="blocks", block=200)
    return canonical(found)


def vector_topk_cells(spark, sf_dir):
    folder = scratch_path(spark, "cells")
    s.write_vector_index(_vectors(spark, sf_dir), folder, cells=32, piece_rows=200)
    return canonical(s.indexed_topk(spark, _all_queries(spark, sf_dir), folder, block=64))


def search_reviews(spark, sf_dir):
    found = s.search_reviews(_all_queries(spark, sf_dir), _vectors(spark, sf_dir), view(spark, sf_dir, "businesses"))
    return _digest(found)


def search_businesses(spark, sf_dir):
    return canonical(s.search_businesses(
        _all_queries(spark, sf_dir), _vectors(spark, sf_dir), view(spark, sf_dir, "businesses")))


def search_businesses_pool(spark, sf_dir):
    return canonical(s.search_businesses(
        _all_queries(spark, sf_dir), _vectors(spark, sf_dir), view(spark, sf_dir, "businesses"), pool=200))


def eval_retrieval(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    split = cut_lineage(c.retrieval_split(vectors))
    return canonical(s.eval_retrieval(vectors, cut_lineage(c.eval_query_ids(vectors, split))))


def encode_corpus(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    encoded = encode.fit_encoder(corpus).encode(corpus)
    return encoded.select("review_id", F.size("embedding").alias("dim"),
                          F.round(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x), 4).alias("norm"))


def encode_words(spark, sf_dir):
    """Vectors by the learnt encoder: dimension and squared norm of every review's."""
    corpus = _corpus(spark, sf_dir)
    encoded = wordvec.fit_word_encoder(corpus).encode(corpus)
    return encoded.select("review_id", F.size("embedding").alias("dim"),
                          F.round(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x), 4).alias("norm"))


def word_information(spark, sf_dir):
    """The table that the learnt encoder factorises, over the whole corpus."""
    return canonical(wordvec.shifted_information(keep_table(wordvec.context_counts(_corpus(spark, sf_dir)), "contexts"), 2.0))


def _adapted(spark, sf_dir):
    vectors = _vectors(spark, sf_dir).select("review_id", "business_id", "embedding")
    split = cut_lineage(c.retrieval_split(vectors))
    pairs = c.mine_pairs(vectors, split.where(F.col("role") == "train"))
    return vectors, split, encode.adapt_embeddings(vectors, pairs)


def adapt_embeddings(spark, sf_dir):
    return _adapted(spark, sf_dir)[2]


def retrieval_lift(spark, sf_dir):
    vectors, split, adapted = _adapted(spark, sf_dir)
    adapted = cut_lineage(adapted)
    queries = cut_lineage(c.eval_query_ids(vectors, split))
    return canonical(s.retrieval_lift(s.eval_retrieval(vectors, queries), s.eval_retrieval(adapted, queries)))


def _index(spark, sf_dir):
    """The default index over these tables: whichever key comes first in a session writes it, the others open it."""
    name = hashlib.md5(f"{spark.sparkContext.applicationId}|{sf_dir}".encode()).hexdigest()
    folder = f"{shared_dir(spark)}/search-{name}"
    try:
        report = spark.read.parquet(f"{folder}/report")  # written last
    except AnalysisException:
        built = build_search(corpus_of(view(spark, sf_dir, "reviews"), None), Settings(), folder)
        write_artifact(built.report, f"{folder}/report")
        report = spark.read.parquet(f"{folder}/report")
    return open_search(spark.read.parquet(f"{folder}/vectors"), folder), report


def run_build_search(spark, sf_dir):
    return canonical(_index(spark, sf_dir)[1])


def _sources(spark, sf_dir):
    """The reviews' businesses are document sources."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("source").alias("business_id")).distinct()
    return rows.selectExpr("business_id", "concat('Place ', business_id) AS name", "'here' AS city", "4.0D AS stars", "'Food' AS categories")


def _passages(spark, sf_dir):
    """Free-text queries: the benchmark passages."""
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumnRenamed("item_id", "query_id")


def search_text_reviews(spark, sf_dir):
    return _digest(_index(spark, sf_dir)[0].reviews(_passages(spark, sf_dir), _sources(spark, sf_dir)))


def search_text_businesses(spark, sf_dir):
    return canonical(_index(spark, sf_dir)[0].businesses(_passages(spark, sf_dir), _sources(spark, sf_dir)))


def search_text(spark, sf_dir):
    """Free text against the review texts in the base space."""
    corpus = _corpus(spark, sf_dir)
    encoder = encode.fit_encoder(corpus)
    return canonical(s.vector_topk(encoder.encode(_passages(spark, sf_dir)), encoder.encode(corpus)))


def _businesses_sql(hits):
    return compose(f"""
        SELECT query_id, place, w.business_id, name, city, b.stars, categories, match, n_hits, substr(r.text, 1, 160) || '…' AS snippet
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY match DESC, business_id) AS place
              FROM (SELECT query_id, business_id, max(score) AS match, count(*) AS n_hits, arg_min(review_id, rank) AS review_id
                    FROM {hits} JOIN review_vectors ON review_id = item_id GROUP BY 1, 2)) w
        JOIN review_vectors r ON r.review_id = w.review_id LEFT JOIN businesses b ON b.business_id = w.business_id
        WHERE place <= 10""", [hits, "review_vectors", "businesses"], ["match", "stars"])


CHECKS = {
    "build_corpus": Check(run_corpus, compose(
        "SELECT review_id, business_id, stars, md5(text) AS text FROM corpus", ["corpus"])),
    "build_corpus_sample": Check(sampled_corpus, compose(
        "SELECT review_id, business_id, stars, md5(text) AS text FROM sampled_corpus", ["sampled_corpus"])),
    "build_corpus_short": Check(short_corpus, compose(
        "SELECT review_id, business_id, stars, md5(substr(text, 1, 1500)) AS text FROM corpus", ["corpus"])),
    "eval_queries_50": Check(eval_queries_50, compose(
        "SELECT * FROM text_queries ORDER BY md5(review_id::VARCHAR || '|42') LIMIT 50", ["text_queries"])),
    "retrieval_split": Check(retrieval_split, compose("SELECT * FROM text_split", ["text_split"])),
    "eval_queries": Check(eval_queries, compose("SELECT * FROM text_queries", ["text_queries"])),
    "mine_pairs": Check(mine_pairs, compose("SELECT * FROM text_pairs", ["text_pairs"], extra=pair_ctes("corpus", "text", 25_000))),
    "vector_topk": Check(vector_topk, compose(
        "SELECT query_id, item_id AS review_id, score, rank FROM hits10", ["hits10"], ["score"])),
    "vector_topk_cells": Check(vector_topk_cells, compose(
        "SELECT query_id, item_id AS review_id, score, rank FROM hits10", ["hits10"], ["score"])),
    "vector_topk_blocks": Check(vector_topk_blocks, compose(
        "SELECT query_id, item_id AS review_id, score, rank FROM hits10", ["hits10"], ["score"])),
    "search_reviews": Check(search_reviews, compose("""
        SELECT query_id, rank, item_id AS review_id, r.business_id, name, city, b.stars, r.stars AS review_stars, score, md5(text) AS text
        FROM hits10 JOIN review_vectors r ON r.review_id = item_id LEFT JOIN businesses b ON b.business_id = r.business_id""",
        ["hits10", "review_vectors", "businesses"], ["score", "stars", "review_stars"])),
    "search_businesses": Check(search_businesses, _businesses_sql("all_hits")),
    "search_businesses_pool": Check(search_businesses_pool, _businesses_sql("hits200")),
    "eval_retrieval": Check(eval_retrieval, compose("""
        SELECT avg(CASE WHEN first IS NULL THEN 0.0 ELSE 1.0 END) AS hit, avg(coalesce(1.0 / first, 0)) AS mrr, count(*) AS n_queries
        FROM vec_eval_queries LEFT JOIN
             (SELECT query_id, min(place) AS first FROM eval_hits WHERE own = found AND place <= 10 GROUP BY 1) USING (query_id)""",
        ["vec_eval_queries", "eval_hits"], ["hit", "mrr"])),
    "encode_corpus": Check(encode_corpus),
    "encode_words": Check(encode_words),
    "word_information": Check(word_information, compose("""
        SELECT word, context, value FROM (
          SELECT c.word, c.context, ln(c.n * total / (a.n * b.n::DOUBLE)) - ln(2.0) AS value
          FROM contexts c JOIN margins a ON a.word = c.word JOIN margins b ON b.word = c.context, (SELECT sum(n)::DOUBLE AS total FROM contexts))
        WHERE value > 0""", ["contexts", "margins"], ["value"])),
    "adapt_embeddings": Check(adapt_embeddings),
    "retrieval_lift": Check(retrieval_lift),
    "build_search": Check(run_build_search),
    "search_text": Check(search_text),
    "search_text_reviews": Check(search_text_reviews),
    "search_text_businesses": Check(search_text_businesses),
}
