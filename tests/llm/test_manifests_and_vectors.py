"""Fingerprints, the Merkle manifest and embedding whitening against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.llm import merkle, queries, whitening, winnowing
from palate.llm.common import BASE
from tests.llm.cases import awkward, no_rows

WORD = 2 ** 64


def brute_hash(codes):
    value = 0
    for code in codes:
        value = (value * int(BASE) + code + 1) % WORD
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        value = (value ^ value >> shift) * factor % WORD
    return min(value ^ value >> 31, WORD - 2)


def brute_winnow(text, gram, window):
    codes = [ord(c) for c in text]
    if not codes:
        return []
    hashes = [brute_hash(codes[i:i + gram]) for i in range(max(1, len(codes) - gram + 1))]
    chosen = set()
    for begin in range(max(1, len(hashes) - window + 1)):
        part = hashes[begin:begin + window]
        chosen.add(begin + max(i for i, h in enumerate(part) if h == min(part)))
    return [(hashes[p], p) for p in sorted(chosen)]


def winnowed(texts, gram, window):
    raw = "".join(texts).encode()
    bounds = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    codes, _, starts = winnowing.code_points(np.frombuffer(raw, np.uint8), bounds)
    hashes, positions, cuts = winnowing.winnow(codes, starts, gram, window)
    return [list(zip(hashes[a:b].tolist(), positions[a:b].tolist())) for a, b in zip(cuts, cuts[1:])], (hashes, positions, cuts)


@pytest.mark.parametrize("gram, window", [(1, 1), (3, 4), (8, 16), (5, 7)])
def test_winnowing_equals_brute_force(gram, window):
    rng = random.Random(gram)
    texts = ["", "a", "é", "", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "日本語🙂 " * 9]
    texts += ["".join(rng.choice(rng.choice(["ab", "abcdefgh ", "aé🙂"])) for _ in range(rng.randrange(70))) for _ in range(120)]
    got, arrays = winnowed(texts, gram, window)
    want = [brute_winnow(t, gram, window) for t in texts]
    assert got == want
    assert winnowing.printed(*arrays).to_pylist() == [",".join(f"{h:016x}:{p:08x}" for h, p in row) for row in want]


def test_shared_runs_share_a_fingerprint():
    rng = random.Random(2)
    least = winnowing.GRAM + winnowing.WINDOW - 1
    for _ in range(200):
        shared = "".join(rng.choice("abcd ") for _ in range(least))
        pair = ["".join(rng.choice("wxyz ") for _ in range(rng.randrange(60))) + shared + "".join(rng.choice("wxyz ") for _ in range(rng.randrange(60)))
                for _ in range(2)]
        (one, other), _ = winnowed(pair, winnowing.GRAM, winnowing.WINDOW)
        assert {h for h, _ in one} & {h for h, _ in other}


def brute_sequence(rows):
    """(key, text) rows by descending key, null last, then by digest; equal rows share a place."""
    order = sorted({(k is not None, k, hashlib.md5((t or "").encode()).hexdigest(), t or "") for k, t in rows}, reverse=True)
    out = {}
    for place, (_, key, _, text) in enumerate(order):
        after, half = order[(place + 1) % len(order)][3], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        prints = [brute_winnow(t, winnowing.GRAM, winnowing.WINDOW) for t in (text, edited, after)]
        sets = [{h for h, _ in p} for p in prints]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        shown = [",".join(f"{h:016x}:{p:08x}" for h, p in row) for row in prints[:2]]
        out[key, text] = (key, len(text), hashlib.sha256(edited.encode()).hexdigest(), *shown, *near)
    return sorted((out[k, t or ""] for k, t in rows), key=repr)


def sequence_rows(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=repr)


def test_sequence_equals_brute_force(spark, sf_dir):
    odd = awkward(spark)
    assert sequence_rows(winnowing.fingerprint_sequence(odd)) == brute_sequence([(r.doc_id, r.text) for r in odd.collect()])
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3, 500, -7]), "".join(rng.choice("abc ") for _ in range(rng.randrange(40)))) for _ in range(60)]
    rows += [(9, "the same row again")] * 700 + [(None, None)] * 5  # equal rows: one place, all of them answered
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sequence_rows(winnowing.fingerprint_sequence(docs)) == brute_sequence(rows)
    named = docs.where("doc_id = 2").selectExpr("concat('k', doc_id) AS doc_id", "text")
    assert sequence_rows(winnowing.fingerprint_sequence(named)) == brute_sequence([("k2", t) for k, t in rows if k == 2])
    assert winnowing.fingerprint_sequence(no_rows(spark)).collect() == []
    assert queries.fingerprint_query(spark, sf_dir).where("near_edited > near_next").count() >= 190  # of 200


def test_fingerprints_of_documents(spark):
    odd = awkward(spark)
    got = winnowing.fingerprint_documents(odd, odd.columns)
    assert got.count() == 12
    for r in got.collect():
        want = brute_winnow(r["row"].text or "", winnowing.GRAM, winnowing.WINDOW)
        assert r.n_chars == len(r["row"].text or "") and [(h % WORD, p) for h, p in zip(r.hashes, r.positions)] == want
    assert winnowing.fingerprint_documents(no_rows(spark), ["doc_id"]).count() == 0


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return H(field(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text"))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, place):
    steps = []
    for level in levels[:-1]:
        first = place // 8 * 8
        steps.append((level[first:place], level[place + 1:first + 8]))
        place //= 8
    return steps


def brute_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    trees = []
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        members = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append((members, levels_of([leaf(r) for r in members])))
    top = levels_of([tree[-1][0] for _, tree in trees])
    out = []
    for number, (members, tree) in enumerate(trees):
        for place, row in enumerate(members):
            steps = path(tree, place) + path(top, number)
            shown = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                shown["text"] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row["text"])
            value = leaf(shown)
            for left, right in steps:
                value = H([*left, value, *right])
            proof = H(d for left, right in steps for d in left + right)
            out.append((row["doc_id"], tree[0][place], tree[-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def checked(docs):
    """The registered query's columns over any rows."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.manifest(docs, presented={"text": text}).select(*COLUMNS).collect()), key=repr)


def test_manifest_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute_manifest([r.asDict() for r in docs.collect()])
    assert sorted((tuple(r) for r in queries.manifest_query(spark, sf_dir).collect()), key=repr) == want
    assert {row[-1] for row in want} == {True, False}
    odd = awkward(spark)
    assert checked(odd) == brute_manifest([r.asDict() for r in odd.collect()])
    assert merkle.manifest(no_rows(spark)).collect() == []


@pytest.mark.parametrize("langs", ["cast(null as string)", "'en'", "case when id % 50 = 0 then concat('l', id) else 'en' end"])
def test_manifest_of_tall_trees(spark, langs):
    """More leaves than a sweep's block, more languages than a run, a lone language."""
    docs = spark.range(5000).selectExpr("id + 1 AS doc_id", "concat('Text ', id) AS text", f"{langs} AS lang", "'s' AS source", "id AS n_chars").repartition(5)
    assert checked(docs) == brute_manifest([r.asDict() for r in docs.collect()])


def test_manifest_of_one_row_and_of_equal_rows(spark):
    row = (1, "Only", "en", "a", 4)
    one = spark.createDataFrame([row], "doc_id long, text string, lang string, source string, n_chars long")
    assert checked(one) == brute_manifest([r.asDict() for r in one.collect()])
    many = spark.createDataFrame([row] * 300, one.schema).repartition(3)
    assert checked(many) == brute_manifest([r.asDict() for r in many.collect()])


def test_proofs_fold_to_the_root(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "'x' AS text", "cast(id % 3 AS string) AS lang", "'s' AS source", "1 AS n_chars")
    for r in merkle.manifest(docs, proofs=True).collect():
        assert r.verified and merkle.folded(r.leaf, r.proof) == r.root and merkle.siblings_digest(r.proof) == r.proof_sha256
        assert merkle.folded("0" * 64, r.proof) != r.root


def brute_white(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    count, sums = len(x), x.sum(axis=0)
    centred = (count * x - sums) / count
    values, axes = np.linalg.eigh(centred.T @ centred / count)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return centred @ (axes / np.sqrt(values)), ((count * x - sums) ** 2).sum(axis=1), values / np.trace(centred.T @ centred / count)


def test_whitening_equals_numpy(spark):
    for sf in ("sf0.001", "sf0.01"):
        rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        got = queries.whitening_query(spark, f"/root/testdata/{sf}").toPandas().sort_values(["vec_id", "component"])
        source = sorted(rows.collect(), key=lambda r: r.vec_id)
        white, deviation, explained = brute_white([r.embedding for r in source])
        mine = got.whitened.to_numpy().reshape(-1, 8)
        signs = np.sign((mine * white).sum(axis=0))
        assert np.abs(mine - white * signs).max() < 1e-9 and got.identity_error.max() < 1e-10
        assert got.deviation.tolist() == np.repeat(deviation, 8).tolist() and set(got.n) == {len(source)}
        assert np.allclose(got.explained.to_numpy()[:8], explained, rtol=1e-12) and got.component.tolist() == [*range(1, 9)] * len(source)


def test_whitening_of_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(5).tolist(), "clash", 1.0) for i in range(40)]
    bad = [(100, None, "x", 0.0), (101, [1.0, None, 2.0, 3.0, 4.0], "x", 0.0), (102, [float("nan")] * 5, "x", 0.0), (103, [float("inf")] * 5, "x", 0.0),
           (104, [], "x", 0.0), (105, [1.0, 2.0], "x", 0.0), (106, [1e300] * 5, "x", 0.0)]
    repeated = [good[0], (None, [0.0] * 5, "x", 0.0)]
    schema = "vec_id long, embedding array<double>, component string, whitened double"
    df = spark.createDataFrame(good + bad + repeated, schema).repartition(4)
    got = whitening.whiten(df).toPandas()
    white, deviation, _ = brute_white([r[1] for r in good + repeated])
    assert len(got) == 42 * 5 and sorted(set(got.vec_id.dropna())) == list(range(40)) and got.vec_id.isna().sum() == 5
    assert got.identity_error.max() < 1e-10 and sorted(got.deviation[got.component == 1]) == sorted(deviation)
    one = got[got.component == 1].sort_values("vec_id").whitened.abs().to_numpy()
    want = np.abs(np.concatenate([white[[0, 40]], white[1:40], white[41:]])[:, 0])
    assert np.allclose(np.sort(one), np.sort(want), atol=1e-9)
    for rows in ([], bad, [good[0]], [good[0]] * 6):  # nothing, nothing usable, no variance
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    far = spark.createDataFrame([(1, [2.0 ** 40, 0.0]), (2, [-(2.0 ** 40), 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(far).collect()} >= {None}  # beyond 64 bits
    assert whitening.whiten(far).where("component = 1 AND abs(identity_error) < 1e-4").count() == 3


@pytest.mark.parametrize("case", ["random", "decay", "equal", "rank", "clustered", "wide"])
def test_jacobi_davidson_reaches_double_precision(case):
    rng = np.random.default_rng(7)
    turn, _ = np.linalg.qr(rng.standard_normal((90, 90)))
    spectrum = {
        "random": np.sort(rng.random(90))[::-1], "decay": np.logspace(0, -12, 90), "equal": np.r_[np.full(12, 5.0), np.ones(78)],
        "rank": np.r_[np.ones(3), np.zeros(87)], "clustered": 1 + 1e-7 * np.arange(90)[::-1], "wide": np.r_[1e12, np.arange(89)[::-1] + 1.0]}[case]
    matrix = turn * spectrum @ turn.T
    matrix = (matrix + matrix.T) / 2
    calls = []

    def product(vectors):
        calls.append(vectors.shape[1])
        return matrix @ vectors

    values, axes = whitening.jacobi_davidson(product, 90, 8)
    assert np.abs(values - spectrum[:8]).max() < 1e-13 * spectrum[0]
    assert np.linalg.norm(matrix @ axes - axes * values, axis=0).max() < 1e-12 * spectrum[0]
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-13 and len(calls) < 120
