"""The learnt encoder and the contrastive adaptation against brute force, finite differences and planted structure."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.config import Settings
from palate.operators import contrast, encode, search, wordvec
from palate.operators.corpus import eval_query_ids, mine_pairs, retrieval_split
from palate.plans.search import build_search, open_search
from palate.session import cut_lineage, keep_table

TEXTS = ["Salt and pepper, salt!", "Pepper and salt", "", None, "one", "über-salt über pepper 42"]


def brute_contexts(texts, window):
    import re
    counts = Counter()
    for text in texts:
        tokens = re.findall(r"[^\W_]+", (text or "").lower())
        for i, a in enumerate(tokens):
            for b in tokens[i + 1:i + 1 + window]:
                counts[a, b] += 1
                counts[b, a] += 1
    return counts


@pytest.mark.parametrize("window", [1, 3])
def test_contexts_and_information_equal_brute_force(spark, window):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    counts = brute_contexts(TEXTS, window)
    found = wordvec.context_counts(df, "text", window)
    assert {(r.word, r.context): r.n for r in found.collect()} == counts
    margin = Counter()
    for (word, _), n in counts.items():
        margin[word] += n
    values = {p: math.log(n * sum(margin.values()) / (margin[p[0]] * margin[p[1]])) - math.log(1.5) for p, n in counts.items()}
    got = {(r.word, r.context): r.value for r in wordvec.shifted_information(found, 1.5).collect()}
    assert got.keys() == {p for p, v in values.items() if v > 0} and all(abs(got[p] - values[p]) < 1e-9 for p in got)


def test_factors_equal_the_leading_eigenvectors(spark):
    rng = np.random.default_rng(3)
    base = rng.random((30, 4))
    matrix = base @ np.diag([9, 5, 3, 1.0]) @ base.T
    words = [f"w{i}" for i in range(30)]
    table = spark.createDataFrame(
        [(words[i], words[j], float(matrix[i, j])) for i in range(30) for j in range(30)], "word string, context string, value double")
    made = wordvec.factors(table, words, 4)
    assert np.allclose(made @ made.T, matrix, rtol=1e-3, atol=1e-3)
    assert wordvec.factors(table, words, 40).shape == (30, 40)


def letters(number):
    return chr(97 + number // 8) + chr(97 + number % 8)


def topical(spark, n=480, seed=5):
    """Reviews of a business share its topic, not its words: two of a topic's many synonyms stand in each, among common words."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        topic = i % 12
        own = [f"topic{chr(97 + topic)}{letters(w)}word" for w in rng.choice(40, 2, replace=False)]
        text = " ".join([*own, *[f"common{chr(97 + w)}" for w in rng.choice(20, 6)]])
        rows.append((i, f"b{topic}", 4.0, text))
    return keep_table(spark.createDataFrame(rows, "review_id long, business_id string, stars double, text string"), "topical")


def test_learnt_vectors_find_what_shares_no_word(spark):
    corpus = topical(spark)
    queries = cut_lineage(corpus.select("review_id", "business_id"))
    hashed = encode.fit_encoder(corpus, dim=1024).encode(corpus)
    learnt = wordvec.fit_word_encoder(corpus, dim=16, buckets=1 << 12)
    words = keep_table(learnt.encode(corpus), "learnt")
    assert search.eval_retrieval(words, queries).first().mrr > search.eval_retrieval(keep_table(hashed, "hashed"), queries).first().mrr + 0.03

    def cosine(a, b):
        a, b = learnt.of_word(a), learnt.of_word(b)
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    seen = [w for w in learnt.words if w.startswith("topica")]
    assert len(seen) > 20 and "topicahhword" not in learnt.words
    # a word never seen takes the side of those it shares parts with
    assert cosine(seen[0], "topicahhword") > cosine(seen[0], "topicehhword")
    assert learnt.of_word("commonzzz").any() and not learnt.of_word("qq").any()
    norms = np.linalg.norm(np.stack(words.toPandas().embedding), axis=1)
    assert np.allclose(norms, 1, atol=1e-5)


def test_encoder_of_awkward_texts_and_its_copy(spark, tmp_path):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, "salt " * 20_000, "neversaltseen"]], "text string")
    learnt = wordvec.fit_word_encoder(df, dim=8, buckets=512)
    again = encode.load_encoder(encode.save_encoder(learnt, f"file://{tmp_path}/encoder"))
    first, second = ({r.text: r.embedding for r in e.encode(df).collect()} for e in (learnt, again))
    assert first == second and not any(first[None]) and not any(first[""]) and any(first["neversaltseen"])
    nothing = wordvec.fit_word_encoder(df.where("text = ''"), dim=8, buckets=16)
    assert nothing.words == [] and [len(r.embedding) for r in nothing.encode(df).collect()] == [8] * df.count()
    hashed = encode.load_encoder(encode.save_encoder(encode.fit_encoder(df, dim=32), f"file://{tmp_path}/hashed"))
    assert isinstance(hashed, encode.TextEncoder)


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(1)
    anchors, positives = rng.normal(size=(2, 7, 5))
    anchors[3] = 0  # a zero vector pulls at nothing
    owners, matrix = np.array(list("abcadee"), object), rng.normal(size=(5, 5))
    loss, gradient = contrast.group_loss(matrix, anchors, positives, owners, 4.0)
    for i in range(5):
        for j in range(5):
            step = np.zeros((5, 5))
            step[i, j] = 1e-6
            up, down = (contrast.group_loss(matrix + s, anchors, positives, owners, 4.0)[0] for s in (step, -step))
            assert abs((up - down) / 2e-6 - gradient[i, j]) < 1e-6
    brute = 0.0
    for i in range(7):
        def cosine(j):
            a, b = anchors[i] @ matrix, positives[j] @ matrix
            return a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) if np.linalg.norm(a) else 0.0
        brute += math.log(sum(math.exp(4 * cosine(j)) for j in range(7) if i == j or owners[i] != owners[j])) - 4 * cosine(i)
    assert abs(loss - brute) < 1e-9


def test_distributed_sums_equal_one_pass(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 4))
    vectors = spark.createDataFrame([(i, x[i].tolist()) for i in range(50)], "review_id long, embedding array<double>")
    drawn = [(p, f"b{p % 9}", int(rng.integers(50)), int(rng.integers(50))) for p in range(83)]
    pairs = spark.createDataFrame(drawn, "pair_id long, business_id string, anchor_id long, positive_id long").repartition(5)
    loss, count, gradient = contrast.summed_loss(contrast.pair_groups(pairs, vectors, 20), np.eye(4))
    parts = [contrast.group_loss(np.eye(4), x[[r[2] for r in g]], x[[r[3] for r in g]], np.array([r[1] for r in g], object))
             for g in (drawn[at:at + 20] for at in range(0, 83, 20))]
    assert count == 83 and np.isclose(loss, sum(p[0] for p in parts)) and np.allclose(gradient, sum(p[1] for p in parts))


def test_contrastive_steps_beat_the_closed_form(spark):
    """Held-out businesses of two nuisance-ridden clusters; the returned matrix is never worse on the held-out pairs."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(60, 4))
    rows = [(i, f"b{i % 60}", np.concatenate([centres[i % 60] + 0.3 * rng.normal(size=4), np.exp(rng.normal(size=8)) * rng.normal(size=8)]).tolist())
            for i in range(900)]
    df = keep_table(spark.createDataFrame(rows, "review_id long, business_id string, embedding array<double>"), "rows")
    split = keep_table(retrieval_split(df, 0.3), "split")
    queries = keep_table(eval_query_ids(df, split), "queries")
    pairs = keep_table(mine_pairs(df, split.where("role = 'train'"), 3_000), "pairs")
    closed, trained = (search.eval_retrieval(keep_table(encode.adapt_embeddings(df, pairs, epochs=e), "moved"), queries).first().mrr for e in (0, 3))
    assert trained >= closed
    judged = contrast.pair_groups(pairs.where("pair_id < 256"), df)
    start = encode.adapted_matrix(df, pairs, epochs=0)
    moved = contrast.contrastive_matrix(df, pairs, start)
    assert contrast.summed_loss(judged, moved)[0] <= contrast.summed_loss(judged, start)[0]


def test_search_runs_with_either_encoder(spark, tmp_path):
    corpus = topical(spark, 120)
    for kind, dim in (("learnt", 16), ("hashed", 64)):
        settings = Settings(encoder=kind, encoder_dim=dim, n_pairs=300, eval_share=0.3, adapt_epochs=1)
        index = build_search(corpus, settings, f"file://{tmp_path}/{kind}")
        again = open_search(index.vectors, f"file://{tmp_path}/{kind}")
        businesses = corpus.select("business_id").distinct().selectExpr("business_id", "'x' AS name", "'c' AS city", "1.0D AS stars", "'k' AS categories")
        asked = spark.createDataFrame([(1, "topicaaaword topicaabword")], "query_id long, text string")
        first = index.reviews(asked, businesses, 5).select("review_id", F.round("score", 6)).collect()
        assert len(first) == 5 and sorted(first) == sorted(again.reviews(asked, businesses, 5).select("review_id", F.round("score", 6)).collect())


def test_contexts_are_shuffled_once(spark):
    """One exchange of counts, both ways round; with the vocabulary given only its pairs are counted."""
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    found = wordvec.context_counts(df, "text", 3)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    counts = brute_contexts(TEXTS, 3)
    some = sorted({a for a, _ in counts})[::2]
    only = wordvec.context_counts(df, "text", 3, some)
    assert {(r.word, r.context): r.n for r in only.collect()} == {p: n for p, n in counts.items() if p[0] in some and p[1] in some}


def test_unknown_words_are_put_together_at_once(monkeypatch):
    """Sums over a text's unknown words equal word by word; the known words' n-grams are not sorted again for each."""
    monkeypatch.setattr(wordvec, "PART_WORDS", 3)
    monkeypatch.setattr(np, "isin", None)
    rng = np.random.default_rng(2)
    parts, seen = rng.normal(size=(64, 5)), np.unique(np.concatenate([wordvec.gram_hashes(w) for w in ("salted", "water")]))
    words = ["salty", "qqq", "waters", "a", "", "unsalted", "salty"]
    wanted = sum(parts[wordvec.gram_hashes(w) % 64].mean(axis=0) for w in ("salty", "waters", "unsalted", "salty"))
    assert np.allclose(wordvec._sum_of_parts(words, parts, seen), wanted)
    assert np.allclose(wordvec._from_parts("waters", parts, seen), parts[wordvec.gram_hashes("waters") % 64].mean(axis=0))
    assert not wordvec._from_parts("qqq", parts, seen).any() and not wordvec._sum_of_parts([], parts, seen).any()
    assert not wordvec._from_parts("salty", parts, seen[:0]).any()
