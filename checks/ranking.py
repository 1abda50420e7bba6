"""Candidates, ranking frame, rankings and their evaluation on deterministic popularity candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Check, canonical, compose, view
from checks.features import (
    BUSINESS_DOUBLES, CROSS_SQL, USER_DOUBLES, split_windows, tables,
)
from checks.views import CTES
from palate.operators import candidates as c, evaluate as e
from palate.operators.als import als_ratings
from palate.session import cut_lineage, keep_table

GAIN = "CASE stars WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3 ELSE 0 END"

CTES["gains"] = (("test_rows",), f"SELECT user_id, business_id, CAST(max({GAIN}) AS BIGINT) AS gain FROM test_rows GROUP BY 1, 2")
CTES["targets"] = (("gains", "history"), """
    SELECT user_id FROM (SELECT DISTINCT user_id FROM gains WHERE gain > 0)
    WHERE user_id IN (SELECT user_id FROM history)""")
CTES["relevant"] = (("gains", "targets"), "SELECT * FROM gains WHERE gain > 0 AND user_id IN (SELECT user_id FROM targets)")
CTES["volumes"] = (("history",), "SELECT business_id, CAST(count(*) AS DOUBLE) AS volume FROM history GROUP BY 1")
CTES["popular"] = (("targets", "volumes", "history"), """
    SELECT user_id, business_id, volume AS als_score, place - 1 AS cf_rank FROM (
      SELECT user_id, business_id, volume, row_number() OVER (PARTITION BY user_id ORDER BY volume DESC, business_id) AS place
      FROM targets, volumes WHERE (user_id, business_id) NOT IN (SELECT DISTINCT user_id, business_id FROM history))
    WHERE place <= 100""")
CTES["frame"] = (("popular", "gains", "uf", "bf"), f"""
    SELECT *, {CROSS_SQL} FROM (SELECT p.*, coalesce(gain, 0) AS label FROM popular p LEFT JOIN gains USING (user_id, business_id))
    JOIN uf USING (user_id) JOIN bf USING (business_id)""")


def _ranks(score: str) -> str:
    return f"""SELECT user_id, business_id, row_number() OVER (PARTITION BY user_id ORDER BY {score} DESC, business_id) AS rank FROM frame"""


CTES["by_popularity"] = (("frame",), _ranks("b_global_review_count"))
CTES["by_score"] = (("frame",), _ranks("als_score"))
CTES["by_stars"] = (("frame",), _ranks("b_avg_stars"))


def metric_ctes(ranks: str, k: int = 10) -> dict:
    """Per-user metrics of one ranking and their means."""
    return {
        f"m_{ranks}": ((ranks, "relevant"), f"""
            WITH ideal AS (SELECT user_id, sum((2 ** gain - 1) / log2(p + 1)) FILTER (p <= {k}) AS idcg, count(*) AS n_rel
                           FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY gain DESC) AS p FROM relevant) GROUP BY 1),
                 hits AS (SELECT user_id, rank, gain, count(*) OVER (PARTITION BY user_id ORDER BY rank) AS h
                          FROM {ranks} JOIN relevant USING (user_id, business_id) WHERE rank <= {k}),
                 per_user AS (SELECT user_id, sum((2 ** gain - 1) / log2(rank + 1)) AS dcg, count(*) AS n_hits, sum(h / rank) AS ps FROM hits GROUP BY 1)
            SELECT user_id, coalesce(dcg / idcg, 0) AS ndcg, coalesce(n_hits / n_rel, 0) AS recall,
                   coalesce(ps / least(n_rel, {k}), 0) AS ap
            FROM ideal LEFT JOIN per_user USING (user_id) WHERE user_id IN (SELECT user_id FROM {ranks})"""),
        f"s_{ranks}": ((f"m_{ranks}",), f"""
            SELECT avg(ndcg) AS ndcg, avg(recall) AS recall, avg(ap) AS map, count(*) AS n_users FROM m_{ranks}"""),
    }


for _ranking in ("by_popularity", "by_score", "by_stars"):
    CTES.update(metric_ctes(_ranking))


def _scene(spark, sf_dir):
    history, test = split_windows(spark, sf_dir)
    targets = cut_lineage(c.target_users(test, history))
    return history, test, targets


def _frame(spark, sf_dir):
    history, test, targets = _scene(spark, sf_dir)
    frame = c.ranking_frame(c.popularity_candidates(targets, history, 100), test, *tables(spark, sf_dir, history, targets))
    return frame, c.relevance(test, targets)


def _kept_frame(spark, sf_dir):
    """The frame's scoring columns, kept the way the training run keeps its test frame."""
    frame, relevant = _frame(spark, sf_dir)
    return keep_table(frame.select("user_id", "business_id", "als_score", "b_global_review_count", "b_avg_stars"), "frame"), relevant


def star_gain(spark, sf_dir):
    gain = c.star_gain(F.col("stars")).alias("gain")
    return canonical(view(spark, sf_dir, "interactions").groupBy("stars", gain).agg(F.count(F.lit(1)).alias("n")))


def id_index(spark, sf_dir):
    return canonical(c.id_index(view(spark, sf_dir, "interactions"), "user_id"))


def confidence_matrix(spark, sf_dir):
    return canonical(c.confidence_matrix(view(spark, sf_dir, "interactions")))


def run_als_ratings(spark, sf_dir):
    return canonical(als_ratings(view(spark, sf_dir, "interactions"), 12.0))


def label_gains(spark, sf_dir):
    return canonical(c.label_gains(split_windows(spark, sf_dir)[1]))


def relevance(spark, sf_dir):
    _, test, targets = _scene(spark, sf_dir)
    return canonical(c.relevance(test, targets))


def sample_users(spark, sf_dir):
    return canonical(c.fit_stop_split(_scene(spark, sf_dir)[2]))


def sample_users_400(spark, sf_dir):
    history, test = split_windows(spark, sf_dir)
    return canonical(c.target_users(test, history, 400))


def demo_recs_100(spark, sf_dir):
    frame, relevant = _kept_frame(spark, sf_dir)
    return canonical(c.demo_recs(c.rank_popularity(frame, frame.count()), relevant, view(spark, sf_dir, "businesses"), 100))


def rank_als(spark, sf_dir):
    frame, _ = _kept_frame(spark, sf_dir)
    return canonical(c.rank_als(frame, frame.count()))


def popularity_candidates(spark, sf_dir):
    history, _, targets = _scene(spark, sf_dir)
    return canonical(c.popularity_candidates(targets, history, 100))


def ranking_frame(spark, sf_dir):
    return canonical(_frame(spark, sf_dir)[0])


def rank_popularity(spark, sf_dir):
    return canonical(c.rank_popularity(_frame(spark, sf_dir)[0]))


def _metric(name):
    def run(spark, sf_dir):
        frame, relevant = _kept_frame(spark, sf_dir)
        return canonical(e.user_metrics(c.rank_popularity(frame, frame.count()), relevant, 10).select("user_id", name))

    return run


def evaluate_rankings(spark, sf_dir):
    frame, relevant = _kept_frame(spark, sf_dir)
    return canonical(e.evaluate_rankings(c.rank_popularity(frame, frame.count()), relevant))


def _results(spark, sf_dir):
    frame, relevant = _kept_frame(spark, sf_dir)
    return {
        "review count": e.evaluate_rankings(c.rank_popularity(frame, frame.count()), relevant),
        "score": e.evaluate_rankings(c.rank_als(frame, frame.count()), relevant),
        "stars": e.evaluate_rankings(c.rank_by(frame, "b_avg_stars", frame.count()), relevant),
    }


def comparison_table(spark, sf_dir):
    return canonical(e.comparison_table(_results(spark, sf_dir)))


def method_lift(spark, sf_dir):
    return canonical(e.method_lift(_results(spark, sf_dir), "score", "review count"))


def _demo(spark, sf_dir):
    frame, relevant = _kept_frame(spark, sf_dir)
    return c.demo_recs(c.rank_popularity(frame, frame.count()), relevant, view(spark, sf_dir, "businesses"))


def demo_recs(spark, sf_dir):
    return canonical(_demo(spark, sf_dir))


def demo_hits(spark, sf_dir):
    return canonical(c.demo_hits(_demo(spark, sf_dir)))


CTES["demo"] = (("by_popularity", "relevant", "businesses"), """
    SELECT user_id, rank, business_id, coalesce(name, CASE WHEN b.business_id IS NULL THEN r.business_id::VARCHAR END) AS name,
           coalesce(city, CASE WHEN b.business_id IS NULL THEN '' END) AS city,
           coalesce(categories, CASE WHEN b.business_id IS NULL THEN '' END) AS categories, gain IS NOT NULL AS visited_in_test
    FROM by_popularity r LEFT JOIN businesses b USING (business_id) LEFT JOIN relevant USING (user_id, business_id)
    WHERE rank <= 10""")

_LIFT = ", ".join(
    f"round_even({m}, 4) AS {m}, round_even(({m} / max(CASE WHEN position = 0 THEN {m} END) OVER () - 1) * 100, 4) AS {m}_lift_pct"
    for m in ("ndcg", "recall", "map"))

CHECKS = {
    "star_gain": Check(star_gain, compose(
        f"SELECT stars, CAST({GAIN} AS BIGINT) AS gain, count(*) AS n FROM interactions GROUP BY 1, 2", ["interactions"])),
    "id_index": Check(id_index, compose("""
        SELECT user_id, row_number() OVER (ORDER BY substr(md5(user_id::VARCHAR), 1, 3), user_id) - 1 AS ix
        FROM (SELECT DISTINCT user_id FROM interactions)""", ["interactions"])),
    "confidence_matrix": Check(confidence_matrix, compose(
        f"SELECT user_id, business_id, sum(1.0 + 12.0 * ({GAIN})) AS confidence FROM interactions GROUP BY 1, 2",
        ["interactions"], ["confidence"])),
    "als_ratings": Check(run_als_ratings, compose(f"""
        SELECT user_id, business_id, greatest((sum(1.0 + 12.0 * ({GAIN})) - 1) / 12.0, 0.000001) AS rating
        FROM interactions GROUP BY 1, 2""", ["interactions"], ["rating"])),
    "label_gains": Check(label_gains, compose("SELECT * FROM gains", ["gains"])),
    "relevance": Check(relevance, compose("SELECT * FROM relevant", ["relevant"])),
    "sample_users": Check(sample_users, compose("""
        SELECT user_id, CASE WHEN row_number() OVER (ORDER BY md5(user_id::VARCHAR || '|42'), user_id) <= floor(0.85::DOUBLE * count(*) OVER ())
                             THEN 'fit' ELSE 'stop' END AS part FROM targets""", ["targets"])),
    "sample_users_400": Check(sample_users_400, compose(
        "SELECT user_id FROM targets ORDER BY md5(user_id::VARCHAR || '|42'), user_id LIMIT 400", ["targets"])),
    "demo_recs_100": Check(demo_recs_100, compose(
        "SELECT * FROM demo WHERE user_id IN (SELECT DISTINCT user_id FROM by_popularity ORDER BY user_id LIMIT 100)", ["demo", "by_popularity"])),
    "rank_als": Check(rank_als, compose("SELECT * FROM by_score", ["by_score"])),
    "popularity_candidates": Check(popularity_candidates, compose("SELECT * FROM popular", ["popular"], ["als_score"])),
    "ranking_frame": Check(ranking_frame, compose(
        "SELECT * FROM frame", ["frame"], [*USER_DOUBLES, *BUSINESS_DOUBLES, "als_score", "star_gap", "price_gap"])),
    "rank_popularity": Check(rank_popularity, compose("SELECT * FROM by_popularity", ["by_popularity"])),
    "ndcg_at_k": Check(_metric("ndcg"), compose("SELECT user_id, ndcg FROM m_by_popularity", ["m_by_popularity"], ["ndcg"])),
    "recall_at_k": Check(_metric("recall"), compose("SELECT user_id, recall FROM m_by_popularity", ["m_by_popularity"], ["recall"])),
    "map_at_k": Check(_metric("ap"), compose("SELECT user_id, ap FROM m_by_popularity", ["m_by_popularity"], ["ap"])),
    "evaluate_rankings": Check(evaluate_rankings, compose("SELECT * FROM s_by_popularity", ["s_by_popularity"], ["ndcg", "recall", "map"])),
    "comparison_table": Check(comparison_table, compose(f"""
        SELECT CAST(position AS BIGINT) AS position, method, {_LIFT}, n_users FROM (
          SELECT 0 AS position, 'review count' AS method, * FROM s_by_popularity
          UNION ALL SELECT 1, 'score', * FROM s_by_score UNION ALL SELECT 2, 'stars', * FROM s_by_stars)""",
        ["s_by_popularity", "s_by_score", "s_by_stars"],
        ["ndcg", "ndcg_lift_pct", "recall", "recall_lift_pct", "map", "map_lift_pct"])),
    "method_lift": Check(method_lift, compose("""
        SELECT 'score' AS method, 'review count' AS over, (s.ndcg / p.ndcg - 1) * 100 AS ndcg_lift_pct
        FROM s_by_score s, s_by_popularity p""", ["s_by_score", "s_by_popularity"], ["ndcg_lift_pct"])),
    "demo_recs": Check(demo_recs, compose("SELECT * FROM demo", ["demo"])),
    "demo_hits": Check(demo_hits, compose(
        "SELECT user_id, CAST(sum(visited_in_test::INTEGER) AS BIGINT) AS hits FROM demo GROUP BY 1", ["demo"])),
}
