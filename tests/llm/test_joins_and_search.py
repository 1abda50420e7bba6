"""Jaccard join, nearest neighbours and decontamination against brute force."""

import collections
import os
import pathlib
import random
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.llm import ann_hnsw, decontaminate, jaccard_join
from tests.llm.cases import WORDS, awkward, no_rows

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = SPLIT.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                parent[root(a)] = root(b)
    ids = {}
    for at, (key, _) in enumerate(rows):
        if key is not None:
            ids[root(at)] = min(key, ids.get(root(at), key))
    return sorted(((key, len(sets[at]), ids.get(root(at)) if sets[at] else key) for at, (key, _) in enumerate(rows)), key=repr)


def check_components(df):
    got = sorted(map(tuple, jaccard_join.jaccard_components(df).collect()), key=repr)
    assert got == brute_components([(r.doc_id, r.text) for r in df.collect()])


def edited(rng, words, share):
    return [rng.choice(WORDS) if rng.random() < share else w for w in words]


def test_components_match_brute_force(spark, sf_dir):
    """Given documents, awkward ones, and families of near copies around the threshold, with shared passages."""
    rng = random.Random(3)
    passage = [rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(60)]
    rows = []
    for family in range(12):
        words = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(rng.randrange(6, 160))]
        rows += [" ".join(edited(rng, words, rng.choice((0, 0.01, 0.02, 0.04)))) for _ in range(12)]
    rows += [" ".join([*passage, *(rng.choice(WORDS) + str(rng.randrange(999)) for _ in range(rng.randrange(5, 40)))]) for _ in range(60)]
    rows += ["a b c d", "A b  c\td", "a b c d e", "a b c", "a b c d e f"] * 2
    made = spark.createDataFrame([(1_000_000 + i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    check_components(docs.union(made).union(awkward(spark).select("doc_id", "text")))


def test_components_of_one_large_family(spark):
    """Many near copies in one bucket: links go through the pivot and, for those it misses, through size classes."""
    rng = random.Random(8)
    words = [f"{rng.choice(WORDS)}{i}" for i in range(70)]
    rows = []
    for i in range(150):
        own = list(words)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(12)}"
        rows.append((i, " ".join(own[:len(own) - rng.randrange(0, 9)])))
    check_components(spark.createDataFrame(rows, "doc_id long, text string"))


def test_components_of_edge_tables(spark):
    check_components(no_rows(spark))
    check_components(spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string"))


def test_connected_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 301), (301, 302), (302, 300), (7, 7)]
    got = dict(map(tuple, jaccard_join.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 300: 300, 301: 300, 302: 300}


def test_neighbours_recall_and_exact_scores(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    table = rows.toPandas()
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    got = ann_hnsw.nearest_neighbours(rows, rows.where("vec_id % 20 = 0"), shard_rows=120).toPandas()
    hits = 0
    for query, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        distances = np.sqrt(((vectors - vectors[ids == query]) ** 2).sum(axis=1))
        assert part["rank"].tolist() == list(range(1, 11)) and query not in part["vec_id"].tolist()
        assert np.allclose([distances[ids == v][0] for v in part["vec_id"]], part["score"], rtol=1e-12)
        assert sorted(zip(part["score"], part["vec_id"])) == list(zip(part["score"], part["vec_id"]))
        distances[ids == query] = np.inf
        hits += len(set(ids[np.lexsort((ids, distances))[:10]]) & set(part["vec_id"]))
    assert hits >= 0.95 * 10 * got["query_id"].nunique()


def test_neighbours_of_awkward_vectors(spark):
    """Copies tie to smaller ids; bad vectors take no part; few candidates all come back; lengths do not mix."""
    rows = [(i, [1.0, 2.0]) for i in range(100, 140)] + [(1, [1.0, 2.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (9, [1.0, 2.0, 3.5]), (1, [1.0, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS shard", "'x' AS v", "2 AS key")
    got = sorted(map(tuple, ann_hnsw.nearest_neighbours(df, df.where("vec_id in (1, 2, 4, 8, 105)"), k=10).collect()))
    assert [g for g in got if g[0] == 1] == [(1, i + 1, 100 + i, 0.5) for i in range(10)]
    assert [g for g in got if g[0] == 105] == [(105, i + 1, v, 0.0) for i, v in enumerate([100, 101, 102, 103, 104, 106, 107, 108, 109, 110])]
    assert [g for g in got if g[0] == 8] == [(8, 1, 9, 0.5)] and {g[0] for g in got} == {1, 8, 105}
    empty = df.limit(0)
    assert ann_hnsw.nearest_neighbours(empty, empty).count() == 0


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_common_length_is_the_textbook_one():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 70))] for _ in range(2))
        assert decontaminate.common_length(np.array(a, np.uint64), np.array(b, np.uint64)) == subsequence(a, b)


def test_svd_finds_the_leading_space(spark):
    rng = np.random.default_rng(0)
    dense = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 40)) + 0.01 * rng.standard_normal((60, 40))
    rows = spark.createDataFrame([(list(range(40)), row.tolist()) for row in dense], "terms array<int>, weights array<double>").repartition(3)
    axes = decontaminate.randomised_svd(rows, 40, 5)
    exact = np.linalg.svd(dense)[2][:5].T
    assert np.allclose(np.linalg.svd(axes.T @ exact)[1], 1, atol=1e-3)


def test_leaks_are_exactly_the_planted_ones(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    word = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    items = {r.item_id: " ".join(word.findall(r.text.lower())) for r in benchmark.collect()}
    held = {r.doc_id: f" {' '.join(word.findall(r.text.lower()))} " for r in docs.collect()}
    planted = {(d, i) for d, text in held.items() for i, item in items.items() if f" {item} " in text}
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert planted and got == planted


def test_paraphrases_and_edges(spark):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in WORDS for b in ("", "ing", "er", "est")]
    def speak(n):
        return [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(speak(rng.randrange(18, 60))) + ". The answer is " + " ".join(speak(4)) + ".") for i in range(30)]
    items += [(50, None), (51, ""), (52, " ".join(speak(300)))]
    docs = [(i, " ".join(speak(rng.randrange(50, 400)))) for i in range(100)]
    def around(words):
        return " ".join([*speak(90), *words, *speak(90)])
    expected = set()
    for i in range(30):
        words = items[i][1].split()
        dropped = [w for n, w in enumerate(words) if n % 8 or n > len(words) - 8]  # an eighth of the words gone, the answer left
        docs.append((1000 + i, around(dropped).upper()))
        expected.add((1000 + i, i))
    docs.append((2000, around(items[32][1].split()[100:200])))
    expected.add((2000, 52))
    frame = spark.createDataFrame(docs, "doc_id long, text string").union(awkward(spark).select("doc_id", "text")).selectExpr("*", "'x' AS item_id", "1 AS key")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame, benchmark).collect()}
    assert got == expected
    assert decontaminate.find_leaks(no_rows(spark), benchmark).count() == 0
    assert decontaminate.find_leaks(frame, benchmark.limit(0)).count() == 0


def test_blocks_of_passages_give_the_same_leaks(spark, sf_dir, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK", 40)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()} == whole


def test_document_frequencies_count_every_word(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.lower("text").alias("_text"))
    counts = collections.Counter(w for r in docs.collect() for w in set(decontaminate.hashes_of(r[0] or "").tolist()))
    whole = decontaminate.document_frequencies(docs, 1 << 20)
    assert whole.least == 0 and dict(zip(whole.words.tolist(), whole.counts.tolist())) == counts
    cut = decontaminate.document_frequencies(docs, 50)
    table = dict(zip(cut.words.tolist(), cut.counts.tolist()))
    assert 0 < len(table) <= 50 and table == {w: n for w, n in counts.items() if n > cut.least}
    assert (cut.idf(whole.words) <= whole.idf(whole.words) + 1e-9).all()


@pytest.mark.parametrize("scale", [1, 40])
def test_leaks_of_common_words_stay_as_the_corpus_grows(spark, scale):
    """Verbatim and reworded items of common words, among words that no item holds but documents do."""
    rng = random.Random(9)
    asked, other = ([f"{a}{b}" for a in WORDS for b in ends] for ends in (("", "s"), ("ing", "er", "est")))
    items = [(i, " ".join(rng.choice(asked) for _ in range(10))) for i in range(12)]
    docs = [" ".join(rng.choice(asked + other) for _ in range(120)) for _ in range(60)]
    expected = set()
    for i, text in items:
        words = text.split()
        for place, held in ((0, words), (1, words[:3] + [rng.choice(other)] + words[4:])):
            expected.add((1000 + 2 * i + place, i))
            docs.append((1000 + 2 * i + place, " ".join([*rng.choices(other, k=83), *held, *rng.choices(other, k=90)])))
    rows = [d if isinstance(d, tuple) else (n, d) for n, d in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    grown = frame.crossJoin(spark.range(scale).withColumnRenamed("id", "copy")).select(
        F.when(F.col("copy") == 0, F.col("doc_id")).otherwise(-1).alias("doc_id"), "text")
    found = decontaminate.find_leaks(grown, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.where("doc_id >= 1000").collect()}
    assert expected <= got


def test_reworded_items_are_found(spark):
    """Rewordings that keep the operator's own rule (share in order, answer) among whole documents: nearly all are found."""
    rng = random.Random(12)
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    fillers = [w for _, text in docs[:200] for w in text.split()]
    units = decontaminate.units_of([(r.item_id, r.text) for r in benchmark.collect()], False)
    texts = {r.item_id: r.text.split() for r in benchmark.collect()}
    planted, expected = [], set()
    for number in range(240):
        item = rng.choice(sorted(texts))
        changed, rate = [], rng.uniform(0.1, 0.38)
        for word in texts[item]:
            move = rng.choice(("drop", "replace", "insert")) if rng.random() < rate else "keep"
            changed += {"drop": [], "replace": [rng.choice(fillers)], "insert": [word, rng.choice(fillers)], "keep": [word]}[move]
        around = rng.choice(docs)[1].split()[:300]
        cut = rng.randrange(len(around) + 1)
        key = 10_000_000 + number
        planted.append((key, " ".join([*around[:cut], *changed, *around[cut:]])))
        region = decontaminate.hashes_of(" ".join(changed))
        for own, words, answer in zip(units.items, units.words, units.answers):
            if own == item:
                share = decontaminate.common_length(words, region) / len(words)
                answered = decontaminate.common_length(answer, region) >= decontaminate.ANSWER * len(answer)
                if share >= decontaminate.SURE or share >= decontaminate.POSSIBLE and answered:
                    expected.add((key, item))
    frame = spark.createDataFrame(docs + planted, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame, benchmark).where("doc_id >= 10000000").collect()}
    assert len(expected) > 100 and len(expected & got) >= 0.98 * len(expected)


def test_block_vocabulary_is_weighed_by_exact_frequencies(spark):
    docs = spark.createDataFrame([(f"common word{n % 7} rare{n}",) for n in range(50)], "_text string")
    frequencies = decontaminate.document_frequencies(docs, 3)  # the table holds few of the words
    words = np.unique(np.concatenate([decontaminate.hashes_of(t) for t in ("common word3 rare4 nowhere",)]))
    exact = dict(zip(words.tolist(), frequencies.exact(spark, words)))
    for word, count in (("common", 50), ("word3", 7), ("rare4", 1), ("nowhere", 0)):
        assert exact[int(decontaminate.hashes_of(word)[0])] == pytest.approx(np.log(51 / (count + 1)) + 1e-3)


def test_lookup_finds_every_hash():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 50, 5_000):
        table = np.unique(rng.integers(0, 2 ** 64, size, np.uint64, endpoint=False))
        table = np.unique(np.concatenate([table, table[:20] + np.uint64(1)]))  # some share all their top bits
        asked = np.concatenate([table, rng.integers(0, 2 ** 64, 1_000, np.uint64, endpoint=False), np.array([0, 2 ** 64 - 1], np.uint64)])
        place = {int(h): n for n, h in enumerate(table)}
        assert decontaminate.Lookup(table)(asked).tolist() == [place.get(int(h), len(table)) for h in asked]


ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from palate.session import get_session
import corpus_pipeline
from palate.llm import queries
spark = get_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
print("rows", *[queries.QUERIES[name](spark, {data!r}).count() for name in {names!r}], corpus_pipeline.run(spark, {data!r}).count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path, sf_dir):
    """The driver alone finds the package: workers start in another folder, without a Python path."""
    root = str(pathlib.Path(__file__).resolve().parents[2])
    names = ["op5_decontamination", "op11_winnowing", "op12_merkle_manifest", "op13_jacobi_davidson"]
    script = tmp_path / "elsewhere.py"
    script.write_text(ELSEWHERE.format(root=root, data=sf_dir, names=names))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=900)
    assert "rows" in done.stdout, done.stderr[-3000:]
