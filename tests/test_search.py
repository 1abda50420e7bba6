import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks.common import view
from palate.operators import corpus as c, encode, search as s, taste as t
from palate.operators.topk import topk_inner_product
from palate.plans.search import build_search, open_search
from palate.config import Settings


def vectors(spark, data, schema="review_id long, business_id string, embedding array<float>"):
    return spark.createDataFrame(data, schema)


def brute(q, x, k, excluded=frozenset()):
    out = []
    for i, a in q.items():
        best = sorted((-round(float(a @ b), 9), j) for j, b in x.items() if (i, j) not in excluded)[:k]
        out += [(i, j, r) for r, (_, j) in enumerate(best, start=1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("ids", ["long", "string"])
def test_both_strategies_equal_brute_force(spark, ids):
    rng = np.random.default_rng(0)
    name = (lambda p, i: f"{p}{i}") if ids == "string" else (lambda p, i: 2**60 + i)
    # small integers give many tied scores
    q = {name("q", i): rng.integers(-2, 3, 4).astype(float) for i in range(23)}
    x = {name("x", i): rng.integers(-2, 3, 4).astype(float) for i in range(150)}
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in q.items()], f"query_id {ids}, vec array<float>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], f"item_id {ids}, vec array<float>").repartition(5)
    expected = brute(q, x, 7)
    for how in ({"strategy": "broadcast"}, {"strategy": "items"}, {"strategy": "blocks", "block": 16}, {}):
        assert rows(topk_inner_product(queries, items, 7, **how), "query_id", "item_id", "rank") == expected
    one = name("q", 3)
    pairs = {(one, j) for j in list(x)[:148]} | {(i, name("x", 0)) for i in q} | {(name("q", 999), name("x", 1))}
    exclude = spark.createDataFrame(list(pairs), f"query_id {ids}, item_id {ids}")
    for how in ({"strategy": "items"}, {"strategy": "blocks", "block": 16}, {}):
        got = topk_inner_product(queries, items, 7, exclude=exclude, **how)
        assert rows(got, "query_id", "item_id", "rank") == brute(q, x, 7, pairs)


@pytest.mark.parametrize("spread", [0.0, 1.0, 3.0])
def test_length_order_prunes_without_loss(spark, monkeypatch, spread):
    """Lengths from equal to far apart, ties, zero vectors, more wanted than there are, huge exclusion lists."""
    from palate.operators import topk
    monkeypatch.setattr(topk, "LENGTH_BLOCK", 32)
    rng = np.random.default_rng(int(spread))
    x = {i: np.round(np.exp(spread * rng.normal()) * rng.normal(size=6), 2) for i in range(1200)}
    x.update({2000 + i: x[i] for i in range(40)})
    x.update({3000: np.zeros(6), 3001: np.zeros(6)})
    q = {i: np.round(rng.normal(size=6), 2) for i in range(40)} | {100: np.zeros(6)}
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in q.items()], "query_id long, vec array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], "item_id long, vec array<double>")
    pairs = {(3, i) for i in x if i != 7} | {(4, i) for i in range(0, 1200, 2)} | {(i, 5) for i in q} | {(999, 1)}
    exclude = spark.createDataFrame(list(pairs), "query_id long, item_id long")
    scored = spark.sparkContext.accumulator(0)
    for k in (1, 9, 2000):
        for left in (None, exclude):
            got = topk_inner_product(queries, items, k, exclude=left, strategy="items", scored=scored)
            expected = brute(q, x, k, pairs) if left is not None else brute(q, x, k)
            assert rows(got, "query_id", "item_id", "rank") == expected
    scored = spark.sparkContext.accumulator(0)
    topk_inner_product(queries.where("query_id < 100"), items, 9, strategy="items", scored=scored).collect()
    assert scored.value <= 40 * len(x) and (spread < 3 or scored.value < 0.3 * 40 * len(x))


@pytest.mark.parametrize("kind", ["clusters", "ties", "hot", "lengths"])
def test_cells_equal_brute_force(spark, tmp_path, kind):
    """Tight clusters, many equal scores, a third of the items one vector, lengths far apart; null vectors take no part."""
    from palate.operators.cells import build_cells, cell_topk
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(20, 6)) * 5
    x = {
        "clusters": {i: middles[i % 20] + rng.normal(size=6) * 0.05 for i in range(900)},
        "ties": {i: rng.integers(-2, 3, 6).astype(float) for i in range(900)},
        "hot": {i: middles[0] if i % 3 == 0 else middles[i % 20] + rng.normal(size=6) for i in range(900)},
        "lengths": {i: rng.normal(size=6) * np.exp(2 * rng.normal()) for i in range(900)},
    }[kind]
    q = {f"q{i}": middles[i % 20] * 0.1 + rng.normal(size=6) * (kind != "clusters") for i in range(60)} | {"zero": np.zeros(6)}
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in q.items()] + [("none", None)], "query_id string, vec array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()] + [(5000, None)], "item_id long, vec array<double>").repartition(4)
    folder = str(tmp_path / "index")
    build_cells(items, folder, cells=20, piece_rows=100)
    for k in (9, 1000) if kind == "hot" else (9,):
        scored = spark.sparkContext.accumulator(0)
        got = cell_topk(spark, queries, folder, k, block=32, scored=scored)
        assert rows(got, "query_id", "item_id", "rank") == brute(q, x, k)
        assert scored.value <= len(q) * len(x)
        if kind == "clusters":
            assert scored.value < 0.5 * len(q) * len(x)


def test_cells_of_empty_tables_and_few_items(spark, tmp_path):
    from palate.operators.cells import build_cells, cell_topk
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vec array<float>")
    for n in (0, 1, 3):
        folder = str(tmp_path / f"index{n}")
        build_cells(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(n)], "item_id long, vec array<float>"), folder, cells=8)
        assert rows(cell_topk(spark, queries, folder, 5), "item_id", "rank") == [(n - 1 - r, r + 1) for r in reversed(range(n))]
        assert cell_topk(spark, queries.where("false"), folder, 5).isEmpty()


def test_cells_read_only_their_folders(spark, tmp_path):
    """The scan of the items is pruned to the folders of the cells that are read."""
    from palate.operators import cells
    folder = str(tmp_path / "index")
    cells.build_cells(spark.range(400).selectExpr("id AS item_id", "array(double(id % 4) * 100, 1.0D) AS vec"), folder, cells=4)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vec array<double>")
    scored = spark.sparkContext.accumulator(0)
    found = cells.cell_topk(spark, queries, folder, 5, scored=scored)
    assert rows(found, "item_id") == [(i,) for i in sorted([3, 7, 11, 15, 19], key=lambda i: repr((i,)))]
    assert scored.value <= 200


def test_cells_have_partitions_of_their_own(spark):
    """One task per cell of the block strategy: no exchange after the one that places cells."""
    queries = spark.range(64).selectExpr("id AS query_id", "array(1.0D, id) AS vec")
    items = spark.range(64).selectExpr("id AS item_id", "array(id, 1.0D) AS vec")
    found = topk_inner_product(queries, items, 2, strategy="blocks", block=16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 1 and "hashpartitioning(part" not in plan and "hashpartitioning(qb" not in plan


def test_many_queries_stay_within_bounds(spark, monkeypatch):
    """50,000 queries: too many rows to keep per task for the broadcast strategy, so the items travel."""
    queries = spark.range(50_000).selectExpr("id AS query_id", "array(double(id % 7), 1.0D) AS vec")
    items = spark.range(300).selectExpr("id AS item_id", "array(1.0D, double(id % 11)) AS vec")
    with pytest.raises(ValueError):
        topk_inner_product(queries, items, 100, strategy="broadcast")
    got = topk_inner_product(queries, items, 100)
    assert got.where("rank = 1").count() == 50_000 and got.where("rank = 1 AND item_id <> 10").isEmpty()


def test_hot_business_does_not_crowd_out_others(spark):
    """The best 250 reviews belong to one business; k businesses come back all the same, in blocks or not."""
    schema = "review_id long, business_id string, text string, stars double, embedding array<float>"
    data = [(i, "hot", f"t{i}", 5.0, [1.0 - i / 1000]) for i in range(250)] + [(1000 + i, f"b{i}", "t", 4.0, [0.1 + i / 100]) for i in range(20)]
    corpus = spark.createDataFrame(data, schema).repartition(5)
    places = spark.createDataFrame([("hot", "H", "c", 4.5, "Thai")], "business_id string, name string, city string, stars double, categories string")
    query = spark.createDataFrame([(0, [1.0]), (1, [-1.0])], "query_id long, embedding array<float>")
    got = {(r.query_id, r.place): (r.business_id, r.n_hits, r.snippet) for r in s.search_businesses(query, corpus, places).collect()}
    assert got[0, 1] == ("hot", 250, "t0…") and [got[0, p][0] for p in range(2, 11)] == [f"b{i}" for i in range(19, 10, -1)]
    assert [got[1, p][0] for p in range(1, 11)] == [f"b{i}" for i in range(10)]
    assert s.search_businesses(query, corpus, places, pool=200).where("query_id = 0").count() == 1
    from palate.operators import topk
    old, topk.KEPT_ROWS = topk.KEPT_ROWS, 10
    try:
        again = {(r.query_id, r.place): (r.business_id, r.n_hits, r.snippet) for r in s.search_businesses(query, corpus, places).collect()}
    finally:
        topk.KEPT_ROWS = old
    assert again == got


def test_groups_of_many_queries_are_one_job(spark, monkeypatch):
    """50,000 queries: cells of bounded size instead of a pass and a broadcast per block; the same groups either way."""
    from palate.operators import topk
    rng = np.random.default_rng(4)
    items = spark.createDataFrame(
        [(i, f"g{i % 37 if i % 3 else 0}", rng.integers(-3, 4, 3).astype(float).tolist()) for i in range(400)], "item_id long, group_id string, vec array<float>")
    queries = spark.range(50_000).selectExpr("id AS query_id", "array(double(id % 7) - 3, double(id % 5) - 2, double(id % 3)) AS vec")
    some = queries.where("query_id < 105")
    scanned = rows(topk.best_groups(some, items, 5))
    monkeypatch.setattr(topk, "KEPT_ROWS", 100)
    monkeypatch.setattr(topk, "ITEM_BLOCK", 90)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4_000)
    assert rows(topk.best_groups(some, items, 5)) == scanned
    found = topk.best_groups(queries, items, 5)
    assert found._jdf.queryExecution().executedPlan().toString().count("FlatMapGroupsInPandas") == 1
    assert found.count() == 250_000
    # queries repeat with period 105, and so do their groups
    assert found.groupBy(F.expr("query_id % 105"), "rank").agg(F.count_distinct("group_id", "item_id").alias("n")).where("n > 1").isEmpty()
    brute_best = {}
    for r in items.collect():
        for q in some.collect():
            score = round(float(np.dot(q.vec, r.vec)), 9)
            best = brute_best.setdefault(q.query_id, {})
            if r.group_id not in best or (-score, r.item_id) < best[r.group_id]:
                best[r.group_id] = (-score, r.item_id)
    expected = [(q, g, i, -s, n) for q, best in brute_best.items() for n, (s, g, i) in enumerate(sorted((s, g, i) for g, (s, i) in best.items())[:5], 1)]
    assert scanned == sorted(expected, key=repr)


def test_text_scores_one_against_its_own_adapted_vector(spark, sf_dir, tmp_path):
    corpus = c.build_corpus(view(spark, sf_dir, "reviews"))
    index = build_search(corpus, Settings(encoder_dim=64, n_pairs=500), f"file://{tmp_path}/index")
    some = corpus.orderBy("review_id").limit(5)
    texts = some.select(F.col("review_id").alias("query_id"), "text")
    places = corpus.select("business_id").distinct().selectExpr("*", "business_id AS name", "'c' AS city", "4.0D AS stars", "'Food' AS categories")
    for opened in (index, open_search(index.vectors, f"file://{tmp_path}/index")):
        best = opened.reviews(texts, places, 1).collect()
        assert len(best) == 5 and all(abs(r.score - 1) < 1e-5 for r in best)
        found = opened.businesses(texts, places)
        assert found.where("place = 1 AND abs(match - 1) < 1e-5").count() == 5


def test_topk_of_nothing(spark):
    queries = spark.createDataFrame([], "query_id long, vec array<float>")
    items = spark.createDataFrame([(1, [1.0])], "item_id long, vec array<float>")
    for how in ("broadcast", "blocks"):
        assert topk_inner_product(queries, items, 3, strategy=how).count() == 0


def test_eval_retrieval_hit_and_rank(spark):
    data = [(1, "a", [1.0, 0.0]), (2, "a", [0.9, 0.43]), (3, "b", [0.0, 1.0])]
    own = spark.createDataFrame([(1,)], "review_id long")
    assert tuple(s.eval_retrieval(vectors(spark, data), own).first()) == (1.0, 1.0, 1)
    second = [(1, "a", [1.0, 0.0]), (2, "a", [0.0, 1.0]), (3, "b", [0.9, 0.43])]
    assert tuple(s.eval_retrieval(vectors(spark, second), own).first()) == (1.0, 0.5, 1)
    assert tuple(s.eval_retrieval(vectors(spark, second), own, k=1).first()) == (0.0, 0.0, 1)


def test_search_businesses_pools_hits(spark):
    schema = "review_id long, business_id string, text string, stars double, embedding array<float>"
    corpus = spark.createDataFrame([(1, "x", "best " * 50, 5.0, [0.9]), (2, "y", "mid", 4.0, [0.8]), (3, "x", "low", 3.0, [0.7])], schema)
    places = spark.createDataFrame([("x", "X", "c", 4.5, "Thai"), ("y", "Y", "d", 3.5, None)],
                                   "business_id string, name string, city string, stars double, categories string")
    query = spark.createDataFrame([(0, [1.0])], "query_id long, embedding array<float>")
    got = s.search_businesses(query, corpus, places).orderBy("place").collect()
    assert [(r.business_id, round(r.match, 6), r.n_hits) for r in got] == [("x", 0.9, 2), ("y", 0.8, 1)]
    assert got[0].snippet == ("best " * 50)[:160] + "…" and got[1].snippet == "mid…"
    reviews = s.search_reviews(query, corpus, places, k=2).orderBy("rank").collect()
    assert [(r.review_id, r.stars, r.review_stars) for r in reviews] == [(1, 4.5, 5.0), (2, 3.5, 4.0)]


def test_build_corpus_rules(spark):
    schema = "review_id long, business_id string, stars double, text string"
    long, short = "x" * 1600, "  a\n" + "b" * 37 + "  "
    df = spark.createDataFrame([(1, "b", 5.0, short), (2, "b", 5.0, long), (3, "other", 5.0, long)], schema)
    kept = spark.createDataFrame([("b",)], "business_id string")
    assert [len(r.text) for r in c.build_corpus(df, kept).collect()] == [1600]
    assert [len(r.text) for r in c.build_corpus(df, kept, max_chars=1500).collect()] == [1500]
    exact = spark.createDataFrame([(1, "b", 5.0, "  a\n" + "b" * 38 + " ")], schema)
    assert c.build_corpus(exact).first().text == "a " + "b" * 38


def test_build_corpus_samples(spark):
    df = spark.range(300).select(
        F.col("id").alias("review_id"), (F.col("id") % 2).cast("string").alias("business_id"),
        F.lit(5.0).alias("stars"), F.lit("w" * 60).alias("text"))
    by_business = {r.business_id: r["count"] for r in c.build_corpus(df, per_business=40).groupBy("business_id").count().collect()}
    assert by_business == {"0": 40, "1": 40}
    assert c.build_corpus(df, per_business=None, size=50).count() == 50


def test_split_and_pairs(spark):
    df = spark.range(400).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 41).cast("string").alias("business_id"))
    split = c.retrieval_split(df)
    roles = {r.role: r["count"] for r in split.groupBy("role").count().collect()}
    eligible = sum(roles.values())
    assert roles["eval"] == int(0.15 * eligible)
    train = split.where("role = 'train'")
    pairs = c.mine_pairs(df, train, 2000)
    owner = df.withColumnRenamed("business_id", "own")
    checked = (
        pairs.join(owner.withColumnRenamed("review_id", "anchor_id").withColumnRenamed("own", "a"), "anchor_id")
        .join(owner.withColumnRenamed("review_id", "positive_id").withColumnRenamed("own", "p"), "positive_id")
    )
    assert checked.where("a = business_id AND p = business_id AND anchor_id <> positive_id").count() == 2000
    assert pairs.join(train, "business_id", "left_semi").count() == 2000
    assert c.mine_pairs(df, train.limit(0), 10).count() == 0


def test_encoder_gives_unit_vectors(spark, sf_dir):
    corpus = c.build_corpus(view(spark, sf_dir, "reviews"), per_business=None, size=None)
    got = encode.fit_encoder(corpus, dim=64).encode(corpus).select("embedding").toPandas()
    norms = np.linalg.norm(np.stack(got.embedding), axis=1)
    assert np.allclose(norms, 1.0, atol=1e-5)


def test_adaptation_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = vectors(spark, [(i, str(i % 6), x[i].tolist()) for i in range(60)])
    pairs = spark.createDataFrame([(i, str(i % 6), i, (i + 6) % 60) for i in range(60)],
                                  "pair_id long, business_id string, anchor_id long, positive_id long")
    x = x.astype(np.float32).astype(float)
    diff = x - np.roll(x, -6, axis=0)
    cov = diff.T @ diff / 120
    assert np.allclose(encode.pair_covariance(pairs, df), cov)
    matrix = encode.adaptation_matrix(cov)
    assert np.allclose(matrix @ (cov + encode.RIDGE * np.trace(cov) / 5 * np.eye(5)) @ matrix, np.eye(5))
    moved = x @ matrix
    moved /= np.linalg.norm(moved, axis=1, keepdims=True)
    got = encode.adapt_embeddings(df, pairs, epochs=0).orderBy("review_id").toPandas()
    assert np.allclose(np.stack(got.embedding), moved, atol=1e-5)


def test_adaptation_helps_when_nuisance_dominates(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 3))
    rows_ = []
    for i in range(240):
        v = np.concatenate([centers[i % 12], 4 * rng.normal(size=3)])
        rows_.append((i, str(i % 12), (v / np.linalg.norm(v)).tolist()))
    report = build_search(vectors(spark, rows_), Settings(n_pairs=500, eval_share=0.5)).report
    got = {r.encoder: r for r in report.collect()}
    assert got["adapted"].mrr > got["base"].mrr and got["adapted"].mrr_lift_pct > 0 and got["base"].hit_lift_pct == 0


def test_liked_and_taste(spark):
    inter = spark.createDataFrame([("u", "x", 2.0), ("u", "y", 3.0), ("v", "x", 4.0), ("v", "y", 5.0), ("v", "z", 1.0), ("v", "x", 4.0)],
                                  "user_id string, business_id string, stars double")
    assert rows(t.liked(inter)) == [("u", "x", 2.0), ("u", "y", 3.0), ("v", "x", 4.0), ("v", "x", 4.0), ("v", "y", 5.0)]
    review = vectors(spark, [(1, "x", [1.0, 0.0]), (2, "y", [0.0, 2.0]), (3, "z", [0.0, 1.0]), (4, "w", [1.0, 1.0]), (5, "n", [0.0, 0.0])])
    places = t.business_vectors(review)
    assert {r.business_id for r in places.collect()} == {"w", "x", "y", "z"}
    taste = {r.user_id: r.vec for r in t.taste_vector(inter, places).collect()}
    assert np.allclose(taste["v"], [0.70710678, 0.70710678])
    details = spark.createDataFrame([("w", "W", "c", 3.0, "Thai"), ("z", "Z", "c", 4.0, None)],
                                    "business_id string, name string, city string, stars double, categories string")
    picks = t.recommend_by_taste(inter, places, details).orderBy("user_id", "rank").collect()
    assert [(r.user_id, r.business_id) for r in picks] == [("u", "w"), ("u", "z"), ("v", "w")]


@pytest.mark.parametrize("average, tone", [(3.4, "a tough grader"), (3.5, "a balanced reviewer"), (4.2, "an enthusiastic regular")])
def test_profile_text(spark, average, tone):
    stats = spark.createDataFrame([("u", 3, average, ["Thai", "Sushi"], "$$", ["c", "d", "e"], [])],
                                  "user_id string, n_reviews long, avg_stars double, top_categories array<string>, price_pref string, "
                                  "top_cities array<string>, favorites array<string>")
    assert t.profile_text(stats).first().profile == (
        f"You're {tone} who has reviewed 3 places, averaging {average}★. You gravitate toward Thai, Sushi, "
        "usually around $$ in c and d.")


def test_profile_stats(spark):
    inter = spark.createDataFrame([("u", "x", 4.0), ("u", "x", 5.0), ("u", "y", 5.0), ("u", "q", 1.0), ("v", "q", 2.0)],
                                  "user_id string, business_id string, stars double")
    places = spark.createDataFrame([
        ("x", "X", "b", "Thai, Food, ", {"RestaurantsPriceRange2": "2"}), ("y", "Y", "a", "Sushi,Bars", {"RestaurantsPriceRange2": "1"}),
        ("q", None, "c", "Pizza", None)], "business_id string, name string, city string, categories string, attributes map<string,string>")
    got = {r.user_id: r for r in t.profile_stats(inter, places).collect()}
    u, v = got["u"], got["v"]
    assert (u.n_reviews, u.avg_stars, u.top_categories, u.price_pref, u.top_cities, u.favorites) == (
        4, 3.75, ["Thai", "Sushi"], "$$", ["b", "a"], ["X", "Y"])
    assert (v.n_reviews, v.top_categories, v.price_pref, v.favorites) == (1, [], "n/a", [])


def test_block_strategy_copies_rows_by_tasks_not_by_block(spark, monkeypatch):
    """Small blocks: no more cells than tasks are wanted; ties, repeated query ids and pairs to leave out as by brute force."""
    from palate.operators import topk
    dealt, deal = [], topk._celled
    monkeypatch.setattr(topk, "_celled", lambda asked, held, qb, ib, more=None: dealt.append(qb * ib) or deal(asked, held, qb, ib, more))
    rng = np.random.default_rng(8)
    q = {i: rng.integers(-2, 3, 4).astype(float) for i in range(900)}
    x = {i: rng.integers(-2, 3, 4).astype(float) for i in range(700)}
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in q.items()], "query_id long, vec array<float>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], "item_id long, vec array<float>").repartition(5)
    pairs = {(i, j) for i in range(0, 900, 7) for j in range(0, 700, 3)} | {(5, j) for j in range(698)}
    exclude = spark.createDataFrame(list(pairs), "query_id long, item_id long")
    found = topk_inner_product(queries, items, 6, exclude=exclude, strategy="blocks", block=8)
    assert rows(found, "query_id", "item_id", "rank") == brute(q, x, 6, pairs)
    assert dealt[0] <= 4 * spark.sparkContext.defaultParallelism
    twice = topk_inner_product(queries.unionAll(queries), items, 6, strategy="blocks", block=8)
    assert twice.groupBy("query_id").count().where("count <> 6").isEmpty()


def test_cells_copy_rows_by_units_not_by_pieces(spark, tmp_path, monkeypatch):
    """Small pieces and blocks: a cell is still one unit, so every item is sent once a round."""
    from palate.operators import cells
    rng = np.random.default_rng(9)
    x = {i: rng.integers(-2, 3, 4).astype(float) for i in range(600)}
    q = {i: rng.normal(size=4) for i in range(200)}
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in q.items()], "query_id long, vec array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], "item_id long, vec array<double>").repartition(3)
    folder, plans, read = str(tmp_path / "index"), [], cells._cut
    cells.build_cells(items, folder, cells=4, piece_rows=20)
    monkeypatch.setattr(cells, "_cut", lambda hits, k: plans.append(hits) or read(hits, k))
    assert rows(cells.cell_topk(spark, queries, folder, 5, block=8), "query_id", "item_id", "rank") == brute(q, x, 5)
    assert plans[0].rdd.getNumPartitions() <= 4


def test_running_top_scores_in_single_precision_first(monkeypatch):
    """Exact results where singles cannot tell items apart, where they overflow, and with pairs left out; doubles only where needed."""
    from palate.operators import topk

    whole, exact = [], topk.RunningTop._exact
    monkeypatch.setattr(topk.RunningTop, "_exact", lambda self, *args: whole.append(1) or exact(self, *args))
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 16))
    for scale, few in ((1.0, True), (1e25, False)):
        queries = np.concatenate([base, np.zeros((1, 16))]) * scale
        # many items within 1e-8 of each other, below the steps of singles near their scores
        items = np.concatenate([rng.normal(size=(300, 16)), 3 * base[rng.integers(0, 6, 200)] + rng.normal(size=(200, 16)) * 1e-8])
        rng.shuffle(items)
        gone = np.array([0, 0, 3, 6]), np.array([5, 120, 333, 1])
        best = topk.RunningTop(queries, 10)
        whole.clear()
        for first in range(0, len(items), 50):
            here = (gone[1] >= first) & (gone[1] < first + 50)
            best.meet(items[first:first + 50].T, first, (gone[0][here], gone[1][here] - first), 4)
        best.finish()
        scores = np.round(queries @ items.T, topk.SCORE_DIGITS)
        scores[gone] = -np.inf
        wanted = np.argsort(-scores, axis=1, kind="stable")[:, :10]
        assert np.allclose(best.scores, np.take_along_axis(scores, wanted, axis=1), rtol=1e-14, atol=2e-9)
        if few:
            assert (best.items == wanted).all() and len(whole) < 8
