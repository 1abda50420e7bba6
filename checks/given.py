"""The deterministic parts of learned steps on given factors, trees and matrices, with their SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks import ranking, search
from checks.common import Check, canonical, compose, view
from checks.views import CTES
from palate.operators import als, candidates as c, contrast, corpus, encode, rerank
from palate.session import cut_lineage, keep_table

# Factors: the embeddings, dealt to users and businesses by their numbers.
FACTORS = {
    "user": "SELECT user_id, embedding AS vec FROM (SELECT DISTINCT user_id FROM interactions) u JOIN embeddings ON vec_id = user_id % 500",
    "business": "SELECT business_id, embedding AS vec FROM (SELECT DISTINCT business_id FROM interactions) b "
                "JOIN embeddings ON vec_id = (business_id * 7 + 3) % 500",
}
for _side, _sql in FACTORS.items():
    CTES[f"{_side}_factors"] = (("interactions",), _sql.replace("embedding AS vec", "CAST(embedding AS DOUBLE[]) AS vec"))
CTES["given_scores"] = (("targets", "user_factors", "business_factors", "history"), """
    SELECT user_id, business_id, score AS als_score, place - 1 AS cf_rank FROM (
      SELECT user_id, business_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, business_id) AS place
      FROM (SELECT u.user_id, b.business_id, round(list_dot_product(u.vec, b.vec), 9) AS score
            FROM user_factors u JOIN targets USING (user_id), business_factors b
            WHERE (u.user_id, b.business_id) NOT IN (SELECT DISTINCT user_id, business_id FROM history))) WHERE place <= 100""")
CTES["pair_scores"] = (("user_factors", "business_factors"), """
    SELECT u.user_id, b.business_id, list_dot_product(u.vec, b.vec) AS als_score FROM user_factors u, business_factors b""")


def _factors(spark, sf_dir):
    view(spark, sf_dir, "interactions").createOrReplaceTempView("interactions")
    spark.read.parquet(f"{sf_dir}/embeddings.parquet").createOrReplaceTempView("embeddings")
    return als.AlsFactors(spark.sql(FACTORS["user"]), spark.sql(FACTORS["business"]))


def als_candidates(spark, sf_dir):
    history, _, targets = ranking._scene(spark, sf_dir)
    return canonical(als.als_candidates(_factors(spark, sf_dir), targets, history, 100))


def als_score_pairs(spark, sf_dir):
    _, test, _ = ranking._scene(spark, sf_dir)
    return canonical(als.als_score_pairs(_factors(spark, sf_dir), test.select("user_id", "business_id").distinct()))


def inject_positives(spark, sf_dir):
    history, test, targets = ranking._scene(spark, sf_dir)
    factors = _factors(spark, sf_dir)
    found = keep_table(als.als_candidates(factors, targets, history, 100), "candidates")
    return canonical(c.inject_positives(found, als.als_score_pairs(factors, c.relevance(test, targets)), 100))


# Two small trees over two features of the popularity frame.
FEATURES = ("b_global_review_count", "u_avg_stars")
RATE = 0.5


def model() -> rerank.RankerModel:
    first = rerank.Tree(*map(np.array, ([0, -1, 1, -1, -1], [150.0, 0.0, 3.0, 0.0, 0.0], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1],
                                        [0.1, 0.5, 0.4, -0.2, 0.8], [5.0, 0.0, 2.0, 0.0, 0.0], [100.0, 40.0, 60.0, 24.0, 36.0])))
    second = rerank.Tree(*map(np.array, ([1, -1, -1], [2.9, 0.0, 0.0], [1, -1, -1], [2, -1, -1], [0.05, 0.3, -0.1], [3.0, 0.0, 0.0], [100.0, 30.0, 70.0])))
    return rerank.RankerModel(FEATURES, RATE, [first, second])


CTES["inputs"] = (("frame",), """
    SELECT user_id, business_id, label, CAST(coalesce(b_global_review_count, -1) AS DOUBLE) AS f0, CAST(coalesce(u_avg_stars, -1) AS DOUBLE) AS f1 FROM frame""")
CTES["steps"] = (("inputs",), """
    SELECT *, CASE WHEN f0 <= 150 THEN 0.5 WHEN f1 <= 3 THEN -0.2 ELSE 0.8 END::DOUBLE AS v1, CASE WHEN f1 <= 2.9 THEN 0.3 ELSE -0.1 END::DOUBLE AS v2 FROM inputs""")
# The first tree's value with neither, one or both features known; unknown splits average by cover, 40 : 60 and 24 : 36.
CTES["known"] = (("steps",), """
    SELECT *, 0.4 * 0.5 + 0.6 * (0.4 * -0.2 + 0.6 * 0.8) AS k, CASE WHEN f0 <= 150 THEN 0.5 ELSE 0.4 * -0.2 + 0.6 * 0.8 END::DOUBLE AS k0,
           (0.4 * 0.5 + 0.6 * CASE WHEN f1 <= 3 THEN -0.2 ELSE 0.8 END)::DOUBLE AS k1, v2 - (0.3 * 0.3 + 0.7 * -0.1) AS second FROM steps""")
CTES["shares"] = (("known",), """
    SELECT *, ((k0 - k) + (v1 - k1)) / 2 AS c0, ((k1 - k) + (v1 - k0)) / 2 + second AS c1 FROM known""")
CTES["graded"] = (("frame",), """
    SELECT user_id, business_id, label, 2.0 ** label AS gain, CASE WHEN p <= 30 THEN 1 / log2(p + 1) ELSE 0 END AS discount
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY business_id) AS p FROM frame)""")
CTES["ideals"] = (("frame",), """
    SELECT user_id, sum((2.0 ** label - 1) / log2(p + 1)) AS ideal
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY label DESC) AS p FROM frame) WHERE p <= 30 GROUP BY 1""")
CTES["swings"] = (("graded", "ideals"), """
    SELECT a.user_id, a.business_id AS hi, b.business_id AS lo, abs(a.gain - b.gain) * abs(a.discount - b.discount) / ideal AS swing
    FROM graded a JOIN graded b ON a.user_id = b.user_id AND a.label > b.label JOIN ideals i ON i.user_id = a.user_id""")


def _frame(spark, sf_dir):
    return ranking._frame(spark, sf_dir)[0]


def lambda_gradients(spark, sf_dir):
    rows = _frame(spark, sf_dir).withColumn("score", F.lit(0.0))
    return canonical(rerank.lambda_gradients(rows, 30).select("user_id", "business_id", "lam", "weight"))


def contributions(spark, sf_dir):
    """Shapley values of every row; score from the trees themselves, in SQL the sum of the expected value and the parts."""
    explained = model().score(model().contributions(_frame(spark, sf_dir).drop("score")))
    parts = [F.col("contributions")[place].alias(f"c{place}") for place in range(2)]
    return canonical(explained.select("user_id", "business_id", *parts, "score"))


# A band matrix: each component takes half of the one before it.
def _moved(spark, sf_dir):
    rows = view(spark, sf_dir, "review_vectors").select("review_id", "business_id", "embedding")
    return encode.apply_adaptation(rows, np.eye(64) + 0.5 * np.eye(64, k=1))


def adapt_embeddings(spark, sf_dir):
    return canonical(_moved(spark, sf_dir).select("review_id", F.posexplode("embedding").alias("place", "value")))


CTES["moved"] = (("review_vectors",), """
    SELECT review_id, [CAST(x / sqrt(list_dot_product(m, m)) AS FLOAT) FOR x IN m] AS vec
    FROM (SELECT review_id, [v[j] + CASE WHEN j > 1 THEN 0.5 * v[j - 1] ELSE 0 END FOR j IN range(1, 65)] AS m
          FROM (SELECT review_id, embedding::DOUBLE[] AS v FROM review_vectors))""")


BAND = np.eye(64) + 0.5 * np.eye(64, k=1)


def contrastive_gradient(spark, sf_dir):
    """One step's gradient at the band matrix, over all groups of the mined pairs."""
    vectors = view(spark, sf_dir, "review_vectors")
    pairs = corpus.mine_pairs(vectors, cut_lineage(corpus.retrieval_split(vectors)).where("role = 'train'"), 2_000)
    loss, count, gradient = contrast.summed_loss(contrast.pair_groups(pairs, vectors), BAND)
    rows = [(i, j, float(v) / count, loss / count) for i, line in enumerate(gradient) for j, v in enumerate(line)]  # d x d
    return canonical(spark.createDataFrame(rows, "i long, j long, value double, loss double"))


CTES["sides"] = (("review_vectors",), """
    SELECT review_id, business_id, x, m, sqrt(list_dot_product(m, m)) AS norm, [v / sqrt(list_dot_product(m, m)) FOR v IN m] AS u
    FROM (SELECT review_id, business_id, x, [x[j] + CASE WHEN j > 1 THEN 0.5 * x[j - 1] ELSE 0 END FOR j IN range(1, 65)] AS m
          FROM (SELECT review_id, business_id, embedding::DOUBLE[] AS x FROM review_vectors))""")
CTES["drawn_pairs"] = (("vec_pairs", "sides"), """
    SELECT pair_id, pair_id // 64 AS g, p.business_id AS own, a.x AS ax, a.u AS au, a.norm AS an, b.x AS bx, b.u AS bu, b.norm AS bn
    FROM vec_pairs p JOIN sides a ON a.review_id = anchor_id JOIN sides b ON b.review_id = positive_id""")
CTES["logits"] = (("drawn_pairs",), """
    SELECT p.pair_id AS i, q.pair_id AS j, 20 * list_dot_product(p.au, q.bu) AS s, p.pair_id = q.pair_id AS same
    FROM drawn_pairs p JOIN drawn_pairs q ON p.g = q.g AND (p.pair_id = q.pair_id OR p.own <> q.own)""")
CTES["pulls"] = (("logits",), """
    SELECT i, j, 20 * (exp(s) / sum(exp(s)) OVER (PARTITION BY i) - same::INT) AS w,
           CASE WHEN same THEN ln(sum(exp(s)) OVER (PARTITION BY i)) - s END AS loss FROM logits""")
CTES["towards"] = (("pulls", "drawn_pairs"), """
    SELECT pair_id, x, u, norm, list(t ORDER BY k) AS t FROM (
      SELECT i AS pair_id, 0 AS side, k, sum(w * v) AS t FROM (SELECT i, w, unnest(q.bu) AS v, unnest(range(64)) AS k FROM pulls JOIN drawn_pairs q ON q.pair_id = j) GROUP BY ALL
      UNION ALL
      SELECT j, 1, k, sum(w * v) FROM (SELECT j, w, unnest(p.au) AS v, unnest(range(64)) AS k FROM pulls JOIN drawn_pairs p ON p.pair_id = i) GROUP BY ALL)
    JOIN (SELECT pair_id, 0 AS side, ax AS x, au AS u, an AS norm FROM drawn_pairs UNION ALL SELECT pair_id, 1, bx, bu, bn FROM drawn_pairs) USING (pair_id, side)
    GROUP BY pair_id, side, x, u, norm""")


def pair_covariance(spark, sf_dir):
    vectors = view(spark, sf_dir, "review_vectors")
    pairs = corpus.mine_pairs(vectors, cut_lineage(corpus.retrieval_split(vectors)).where("role = 'train'"), 2_000)
    total = encode.pair_covariance(pairs, vectors.select("review_id", "embedding"))
    rows = [(i, j, float(v)) for i, line in enumerate(total) for j, v in enumerate(line)]  # d x d
    return canonical(spark.createDataFrame(rows, "i long, j long, value double"))


CHECKS = {
    "als_candidates_given": Check(als_candidates, compose("SELECT * FROM given_scores", ["given_scores"], ["als_score"])),
    "als_score_pairs_given": Check(als_score_pairs, compose(
        "SELECT DISTINCT user_id, business_id, als_score FROM test_rows JOIN pair_scores USING (user_id, business_id)",
        ["test_rows", "pair_scores"], ["als_score"])),
    "inject_positives_given": Check(inject_positives, compose("""
        SELECT * FROM given_scores UNION ALL
        SELECT user_id, business_id, als_score, 100 AS cf_rank FROM relevant JOIN pair_scores USING (user_id, business_id)
        WHERE (user_id, business_id) NOT IN (SELECT user_id, business_id FROM given_scores)""",
        ["given_scores", "relevant", "pair_scores"], ["als_score"])),
    "rank_ltr_given": Check(lambda spark, sf_dir: canonical(rerank.rank_ltr(_frame(spark, sf_dir), model())), compose("""
        SELECT user_id, business_id, row_number() OVER (PARTITION BY user_id ORDER BY 0.5 * v1 + 0.5 * v2 DESC, business_id) AS rank FROM steps""",
        ["steps"])),
    "feature_importance_given": Check(
        lambda spark, sf_dir: canonical(rerank.feature_importance(model(), view(spark, sf_dir, "interactions"))),
        "SELECT 'b_global_review_count' AS feature, 5.0::DOUBLE AS gain, 50.0::DOUBLE AS gain_pct UNION ALL SELECT 'u_avg_stars', 5.0, 50.0"),
    "ranker_attribution_given": Check(lambda spark, sf_dir: canonical(rerank.ranker_attribution(model(), _frame(spark, sf_dir))), compose("""
        SELECT 'b_global_review_count' AS feature, avg(abs(0.5 * c0)) AS mean_abs_contribution FROM shares
        UNION ALL SELECT 'u_avg_stars', avg(abs(0.5 * c1)) FROM shares""", ["shares"], ["mean_abs_contribution"])),
    "ranker_contributions_given": Check(contributions, compose("""
        SELECT user_id, business_id, 0.5 * c0 AS c0, 0.5 * c1 AS c1, 0.5 * (k + 0.3 * 0.3 + 0.7 * -0.1) + 0.5 * c0 + 0.5 * c1 AS score FROM shares""",
        ["shares"], ["c0", "c1", "score"])),
    "lambda_gradients": Check(lambda_gradients, compose("""
        SELECT user_id, business_id, coalesce(sum(lam), 0) AS lam, coalesce(sum(weight), 0) AS weight FROM (
          SELECT user_id, business_id, 0.0::DOUBLE AS lam, 0.0::DOUBLE AS weight FROM frame
          UNION ALL SELECT user_id, hi, 0.5 * swing, 0.25 * swing FROM swings
          UNION ALL SELECT user_id, lo, -0.5 * swing, 0.25 * swing FROM swings) GROUP BY 1, 2""", ["frame", "swings"], ["lam", "weight"])),
    "adapt_embeddings_given": Check(adapt_embeddings, compose(
        "SELECT review_id, CAST(j - 1 AS BIGINT) AS place, CAST(vec[j] AS DOUBLE) AS value FROM moved, range(1, 65) r(j)", ["moved"], ["value"])),
    "contrastive_gradient_given": Check(contrastive_gradient, compose("""
        SELECT CAST(i - 1 AS BIGINT) AS i, CAST(j - 1 AS BIGINT) AS j, sum(x[i] * across[j]) / 2000 AS value, any_value(total) / 2000 AS loss
        FROM (SELECT x, [(t[k] - u[k] * list_dot_product(u, t)) / norm FOR k IN range(1, 65)] AS across FROM towards),
             (SELECT sum(loss) AS total FROM pulls), range(1, 65) r(i), range(1, 65) s(j) GROUP BY 1, 2""",
        ["towards", "pulls"], ["value", "loss"], extra=search.pair_ctes("review_vectors", "vec", 2000))),
    "pair_covariance": Check(pair_covariance, compose("""
        SELECT CAST(i - 1 AS BIGINT) AS i, CAST(j - 1 AS BIGINT) AS j, sum(d[i] * d[j]) / (2.0 * 2000) AS value
        FROM (SELECT [a.vec[x] - b.vec[x] FOR x IN range(1, 65)] AS d FROM vec_pairs
              JOIN vec_items a ON a.item_id = anchor_id JOIN vec_items b ON b.item_id = positive_id), range(1, 65) r(i), range(1, 65) s(j)
        GROUP BY 1, 2""", ["vec_pairs", "vec_items"], ["value"], extra=search.pair_ctes("review_vectors", "vec", 2000))),
}
