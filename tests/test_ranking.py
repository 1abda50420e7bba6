import gc
import math
import threading
import time

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks.common import view
from palate.operators import als, candidates as c, evaluate as e
from palate.operators.cohort import temporal_split
from palate.session import cut_lineage, freeing_shuffles


def test_confidence_sums_repeat_visits(spark):
    df = spark.createDataFrame([("u", "b", 5.0), ("u", "b", 3.0), ("u", "c", 1.0)], "user_id string, business_id string, stars double")
    assert rows(c.confidence_matrix(df)) == [("u", "b", 50.0), ("u", "c", 1.0)]
    assert [r.rating for r in als.als_ratings(df, 12.0).orderBy("business_id").collect()] == [49 / 12, 1e-6]
    assert rows(c.label_gains(df)) == [("u", "b", 3), ("u", "c", 0)]


def test_metrics(spark):
    ranks = spark.createDataFrame([("u", "x", 1), ("u", "y", 2), ("u", "z", 3), ("only ranked", "x", 1)], "user_id string, business_id string, rank int")
    gains = spark.createDataFrame([("u", "y", 3), ("u", "z", 1), ("only relevant", "x", 1)], "user_id string, business_id string, gain int")
    got = e.user_metrics(ranks, gains, 2).collect()
    assert [r.user_id for r in got] == ["u"]
    assert math.isclose(got[0].ndcg, 0.57876411, rel_tol=1e-7)
    assert (got[0].recall, got[0].ap) == (0.5, 0.25)
    assert e.evaluate_rankings(ranks, gains, 2).first().n_users == 1
    none = e.evaluate_rankings(ranks, gains.limit(0), 2).first()
    assert tuple(none) == (0.0, 0.0, 0.0, 0)


def test_ideal_order_scores_one(spark, sf_dir):
    gains = c.label_gains(view(spark, sf_dir, "interactions")).where("gain > 0")
    ranks = c.rank_by(gains, "gain")
    got = e.user_metrics(ranks, gains, 10).agg(F.min("ndcg"), F.max("ndcg"), F.min("ap"), F.max("recall")).first()
    assert math.isclose(got[0], 1.0) and math.isclose(got[1], 1.0) and math.isclose(got[2], 1.0) and got[3] <= 1.0


def test_comparison_table_lifts_over_the_first_method(spark):
    def one(*v):
        return spark.createDataFrame([v], "ndcg double, recall double, map double, n_users long")

    table = e.comparison_table({"a": one(0.1, 0.2, 0.0, 3), "b": one(0.15, 0.1, 0.5, 3)}).collect()
    assert [r.method for r in table] == ["a", "b"]
    assert (table[1].ndcg_lift_pct, table[1].recall_lift_pct, table[1].map_lift_pct) == (50.0, -50.0, None)


def test_inject_positives_keeps_the_candidate(spark):
    schema = "user_id string, business_id string, als_score double, cf_rank int"
    found = spark.createDataFrame([("u", "x", 0.5, 0)], schema)
    positives = spark.createDataFrame([("u", "x", 0.1), ("u", "y", 0.2)], "user_id string, business_id string, als_score double")
    assert rows(c.inject_positives(found, positives, 100)) == [("u", "x", 0.5, 0), ("u", "y", 0.2, 100)]


def test_fit_stop_split_is_a_partition(spark):
    targets = spark.range(101).withColumnRenamed("id", "user_id")
    got = {r.part: r["count"] for r in c.fit_stop_split(targets, 0.85).groupBy("part").count().collect()}
    assert got == {"fit": 85, "stop": 16}


def test_demo_recs_fall_back_to_the_id(spark):
    ranks = spark.createDataFrame([("u", "x", 1), ("u", "q", 2), ("v", "x", 1)], "user_id string, business_id string, rank int")
    relevant = spark.createDataFrame([("u", "q", 2)], "user_id string, business_id string, gain int")
    places = spark.createDataFrame([("x", "X!", "c", None)], "business_id string, name string, city string, categories string")
    demo = c.demo_recs(ranks, relevant, places, n_users=1)
    assert rows(demo) == [("u", 1, "x", "X!", "c", None, False), ("u", 2, "q", "q", "", "", True)]
    assert rows(c.demo_hits(demo)) == [("u", 1)]


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    split = cut_lineage(temporal_split(view(spark, sf_dir, "interactions")))
    history, test = split.where("split <> 'test'"), split.where("split = 'test'")
    targets = cut_lineage(c.target_users(test, history, 60))
    return history, test, targets, als.als_fit(history, factors=8, iterations=3)


def test_als_candidates_are_the_best_unseen_items(fitted):
    history, _, targets, factors = fitted
    n = 25
    got = als.als_candidates(factors, targets, history, n).toPandas()
    users = {r.user_id: np.array(r.vec, dtype=float) for r in factors.users.collect()}
    items = {r.business_id: np.array(r.vec, dtype=float) for r in factors.items.collect()}
    seen = history.select("user_id", "business_id").distinct().toPandas().groupby("user_id")["business_id"].apply(set).to_dict()
    assert len(got.user_id.unique()) == 60
    for user, part in got.groupby("user_id"):
        scores = sorted(((-round(float(users[user] @ v), 9), b) for b, v in items.items() if b not in seen[user]))[:n]
        ordered = part.sort_values("cf_rank")
        assert list(ordered.cf_rank) == list(range(len(scores)))
        assert list(ordered.business_id) == [b for _, b in scores]


def test_als_pair_scores_agree_with_candidates(fitted):
    history, _, targets, factors = fitted
    found = als.als_candidates(factors, targets, history, 5)
    scored = als.als_score_pairs(factors, found.select("user_id", "business_id"))
    gap = found.join(scored.withColumnRenamed("als_score", "again"), ["user_id", "business_id"]).agg(
        F.max(F.abs(F.col("als_score") - F.col("again"))), F.count("*")).first()
    assert gap[0] < 1e-6 and gap[1] == 300


def test_als_beats_the_reverse_order(fitted):
    history, _, _, factors = fitted
    own = c.label_gains(history).where("gain > 0")
    scored = als.als_score_pairs(factors, c.label_gains(history))
    best = e.evaluate_rankings(c.rank_by(scored, "als_score"), own).first().ndcg
    worst = e.evaluate_rankings(c.rank_by(scored, -F.col("als_score")), own).first().ndcg
    assert best > worst


def test_als_users_solve_their_normal_equations(spark, sf_dir):
    """The last half-step is the users': their factors are the ridge solution given the items' and the confidences."""
    import numpy as np

    from checks.common import view
    from palate.operators.als import als_fit, als_ratings
    history, alpha, ridge = view(spark, sf_dir, "interactions"), 12.0, 0.05
    fitted = als_fit(history, factors=6, iterations=3, regularization=ridge, alpha=alpha)
    items = {r.business_id: np.array(r.vec) for r in fitted.items.collect()}
    ratings = {}
    for r in als_ratings(history, alpha).collect():
        ratings.setdefault(r.user_id, []).append((r.business_id, r.rating))
    gram = sum(np.outer(v, v) for v in items.values())
    users = fitted.users.collect()
    assert {r.user_id for r in users} == set(ratings)
    for user in users:
        own = ratings[user.user_id]
        left = gram + ridge * len(own) * np.eye(6) + sum(alpha * w * np.outer(items[b], items[b]) for b, w in own)
        right = sum((1 + alpha * w) * items[b] for b, w in own)
        assert np.allclose(np.linalg.solve(left, right), user.vec, rtol=1e-3, atol=1e-4)


def test_popularity_reads_no_hot_place(spark):
    """Lists are made in place: no exchange or window by place, and the first unseen businesses of every user."""
    history = spark.createDataFrame(
        [(u, b) for u in range(40) for b in range(12) if (u * b) % 5 != 1 and b < 3 + u % 10] + [(99, 50)], "user_id long, business_id long")
    targets = spark.createDataFrame([(u,) for u in [*range(0, 40, 2), 777]], "user_id long")
    seen = {(r.user_id, r.business_id) for r in history.collect()}
    volume = {}
    for _, b in seen:
        volume[b] = volume.get(b, 0) + 1
    order = sorted(volume, key=lambda b: (-volume[b], b))
    want = []
    for u in [*range(0, 40, 2), 777]:
        want += [(u, b, p) for p, b in enumerate([b for b in order if (u, b) not in seen][:4])]
    found = c.popularity_candidates(targets, history, 4)
    assert rows(found, "user_id", "business_id", "cf_rank") == sorted(want, key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning(place" not in plan


def test_frame_moves_narrow_candidates(spark):
    """Labels come with the user, few businesses travel: one exchange by user and none by business; repeated keys stay."""
    found = spark.createDataFrame([(1, 10, 2.0, 0), (1, 11, 1.0, 1), (2, 10, 3.0, 0), (3, 12, 1.0, 0), (4, None, 1.0, 0)],
                                  "user_id long, business_id long, als_score double, cf_rank int")
    labels = spark.createDataFrame([(1, 11, 5.0), (1, 11, 3.0), (2, None, 5.0), (None, 10, 5.0)], "user_id long, business_id long, stars double")
    users = spark.createDataFrame([(1, 4.0, 1.0, "a", "x"), (2, 3.0, None, "b", "y"), (2, 2.0, None, "b", "y"), (4, 1.0, 1.0, "a", "x")],
                                  "user_id long, u_avg_stars double, u_avg_price double, u_modal_city string, u_top_cat string")
    places = spark.createDataFrame([(10, 3.0, 2, "a", "x"), (11, 2.0, -1, "b", "y")],
                                   "business_id long, b_avg_stars double, b_price_range int, b_city string, b_primary_category string")
    frame = c.ranking_frame(found, labels, users, places)
    assert frame.columns[:5] == ["business_id", "user_id", "als_score", "cf_rank", "label"]
    assert rows(frame, "user_id", "business_id", "label", "u_avg_stars") == [(1, 10, 0, 4.0), (1, 11, 3, 4.0), (2, 10, 0, 2.0), (2, 10, 0, 3.0)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = c.ranking_frame(found, labels, users, places)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin [business_id" in plan and "SortMergeJoin [business_id" not in plan


def test_frame_neither_broadcasts_nor_sorts_candidates(spark, monkeypatch):
    """Candidates compress to few bytes: they go by rows to tasks that hold the features of their own users."""
    monkeypatch.setattr(c, "FRAME_ROWS", 50)
    found = spark.range(300).selectExpr("id % 20 AS user_id", "id div 20 AS business_id", "1.0D AS als_score", "0 AS cf_rank")
    labels = spark.createDataFrame([(3, 4, 5.0), (3, 4, 4.0), (7, 99, 5.0)], "user_id long, business_id long, stars double")
    users = spark.range(19).selectExpr("id AS user_id", "2.0D AS u_avg_stars", "1.0D AS u_avg_price", "'c' AS u_modal_city", "'t' AS u_top_cat")
    places = spark.range(15).selectExpr("id AS business_id", "3.0D AS b_avg_stars", "2 AS b_price_range", "'c' AS b_city", "'x' AS b_primary_category")
    frame = c.ranking_frame(found, labels, users, places)
    got = frame.withColumn("task", F.spark_partition_id()).toPandas()
    assert len(got) == 19 * 15 and [tuple(r) for r in got[got.label > 0][["user_id", "business_id", "label"]].to_numpy()] == [(3, 4, 3)]
    assert got.groupby("user_id").task.nunique().max() == 1
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [user_id" in plan and "BuildLeft" not in plan
    assert plan.count(", 6), REPARTITION_BY_NUM") == 2


def test_a_task_ranks_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(c, "FRAME_ROWS", 10)
    frame = spark.range(60).selectExpr("id % 12 AS user_id", "id AS business_id", "id * 0.5D AS als_score")
    ranks = c.rank_als(frame, 60)
    assert ", 6), REPARTITION_BY_NUM" in ranks._jdf.queryExecution().executedPlan().toString()
    assert rows(ranks) == rows(c.rank_als(frame)) == sorted(((u, u + 12 * i, 5 - i) for u in range(12) for i in range(5)), key=repr)


def test_metrics_sort_a_ranking_once(spark):
    frame = spark.range(40).selectExpr("id % 4 AS user_id", "id AS business_id", "id * 0.5D AS taste")
    gains = spark.createDataFrame([(1, 5, 3), (2, 6, 1), (9, 9, 2)], "user_id long, business_id long, gain int")
    metrics = e.user_metrics(c.rank_by(frame, "taste"), gains, 3)
    plan = metrics._jdf.queryExecution().optimizedPlan().toString()
    assert len([line for line in plan.splitlines() if "Window [" in line and "score" in line]) == 1
    assert sorted(r.user_id for r in metrics.collect()) == [1, 2]


def test_a_fit_frees_the_shuffles_of_earlier_iterations(spark, monkeypatch):
    """Files of iterations before a checkpoint go while the fit runs, not half an hour later."""
    def shuffles():
        blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
        return {name.split("_")[1] for name in (blocks.apply(i).toString() for i in range(blocks.size())) if name.startswith("shuffle_")}

    before = shuffles()
    spark.range(100).repartition(3).count()
    made = shuffles() - before
    assert made
    with freeing_shuffles(spark, 0.2):
        for _ in range(100):
            gc.collect()
            if not made & shuffles():
                break
            time.sleep(0.2)
    assert not made & shuffles()

    used = []

    class Noted(als.ALS):
        def fit(self, df):
            used.append((self.getCheckpointInterval(), threading.active_count()))
            return super().fit(df)

    monkeypatch.setattr(als, "ALS", Noted)
    history = spark.createDataFrame([(u, b, 5.0) for u in range(6) for b in range(4) if (u + b) % 2], "user_id long, business_id long, stars double")
    idle = threading.active_count()
    fitted = als.als_fit(history, factors=2, iterations=3)
    assert fitted.users.count() == 6 and fitted.items.count() == 4
    assert used == [(2, idle + 1)]


def test_popular_places_are_hashed_not_met_by_a_sorted_history(spark):
    history = spark.createDataFrame([(u, b) for u in range(6) for b in range(u + 1)], "user_id long, business_id long")
    targets = history.select("user_id").distinct()
    threshold, seen = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    keep = c.keep_table
    c.keep_table = lambda df, label: seen.append(df._jdf.queryExecution().sparkPlan().toString()) or keep(df, label)
    try:
        got = rows(c.popularity_candidates(targets, history, 2), "user_id", "business_id", "cf_rank")
    finally:
        c.keep_table = keep
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(seen) == 1 and "ShuffledHashJoin" in seen[0]
    assert not [line for line in seen[0].splitlines() if "SortMergeJoin" in line and "item_id" in line]
    assert got == [(u, b, i) for u in range(6) for i, b in enumerate(range(u + 1, min(u + 3, 6)))]


def test_blocks_give_the_factors_of_sparks_als(spark, monkeypatch):
    """Same start, steps and objective, whatever the number of blocks; short, padded and long rows."""
    from pyspark.ml.recommendation import ALS

    from palate.operators import factorize

    monkeypatch.setattr(factorize, "BLOCK_RATINGS", 40)
    monkeypatch.setattr(factorize, "LONG_ROW", 12)
    monkeypatch.setattr(factorize, "BATCH_CELLS", 256)
    # numbers have gaps; user 0 rates everything, others from one item to many
    pairs = {(u, i) for u in range(0, 60, 2) for i in range(0, 40, 3) if u == 0 or (u * 7 + i * 5) % (2 + u % 5) == 0}
    ratings = spark.createDataFrame([(u, i, 0.5 + (u + i) % 4) for u, i in sorted(pairs)], "user_ix int, item_ix int, rating double")
    als_of = ALS(userCol="user_ix", itemCol="item_ix", ratingCol="rating", implicitPrefs=True, rank=6, maxIter=4, regParam=0.1, alpha=9.0, seed=5)
    model, start = als_of.fit(ratings), als_of.copy({als_of.maxIter: 0}).fit(ratings).userFactors
    found = factorize.fit_blocks(ratings, start, 4, 0.1, 9.0)
    for made, wanted in zip(found, (model.userFactors, model.itemFactors)):
        made, wanted = ({r["id"]: r["features"] for r in side.collect()} for side in (made, wanted))
        assert made.keys() == wanted.keys()
        assert all(abs(a - b) < 1e-5 for key in wanted for a, b in zip(made[key], wanted[key]))


def test_injected_positives_do_not_sort_the_candidates(spark):
    candidates = spark.createDataFrame([("u", "x", 0.5, 0), ("u", "x", 0.5, 1), (None, "y", 0.1, 0), ("v", "y", 0.3, 0)],
                                       "user_id string, business_id string, als_score double, cf_rank int")
    positives = spark.createDataFrame([("u", "x", 0.5), ("u", "y", 0.2), ("u", "y", 0.2), (None, "y", 0.1)], "user_id string, business_id string, als_score double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = c.inject_positives(candidates, positives, 9)
        plan = made._jdf.queryExecution().sparkPlan().toString()
        assert "ShuffledHashJoin" in plan and plan.count("SortMergeJoin") == 1  # positives and those found among the candidates
        assert rows(made) == sorted([("u", "x", 0.5, 0), ("u", "x", 0.5, 1), (None, "y", 0.1, 0), ("v", "y", 0.3, 0),
                                     ("u", "y", 0.2, 9), ("u", "y", 0.2, 9), (None, "y", 0.1, 9)], key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
