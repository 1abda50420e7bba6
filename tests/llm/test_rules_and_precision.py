"""Random patterns, SQL on awkward fixtures, extreme vectors and the importance draw against brute force."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.llm import ann_hnsw, common, importance, license_scan, oracles, pii, queries, secrets
from tests.llm.cases import WORDS, awkward


def random_pattern(rng, depth=0):
    """A pattern and a function that draws a text it matches."""
    kind = rng.choice(["literal", "set", "branch", "repeat", "optional", "sequence", "sequence"]) if depth < 3 else rng.choice(["literal", "set"])
    if kind == "literal":
        word = "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4)))
        return word, lambda: word
    if kind == "set":
        letters = "".join(sorted({rng.choice("xyzuvw0123") for _ in range(rng.randint(2, 9))}))
        return f"[{letters}]", lambda: rng.choice(letters)
    if kind in ("optional", "repeat"):
        pattern, draw = random_pattern(rng, depth + 1)
        if kind == "optional":
            return f"(?:{pattern})?", lambda: draw() if rng.random() < 0.5 else ""
        least = rng.randint(0, 3)
        most = rng.choice([least, least + 2, None])
        return f"(?:{pattern}){{{least},{'' if most is None else most}}}", lambda: "".join(
            draw() for _ in range(rng.randint(least, least + 3 if most is None else most)))
    parts = [random_pattern(rng, depth + 1) for _ in range(rng.randint(2, 4))]
    if kind == "branch":
        return "(" + "|".join(p for p, _ in parts) + ")", lambda: rng.choice(parts)[1]()
    return "".join(p for p, _ in parts), lambda: "".join(draw() for _, draw in parts)


def test_trigram_queries_of_random_patterns_lose_no_match():
    rng, asking = random.Random(3), 0
    cases = [random_pattern(rng) for _ in range(3_000)]
    cases += [("(a|bb)?(ab|cd){2}(de|f){3}[xy]", lambda: "cdcdfdedex"), ("(alpha|beta|gamma)[xy]{5}def", lambda: "gammaxyxyxdef")]
    for pattern, draw in cases:
        clauses = secrets.trigram_query(pattern)
        asking += clauses != secrets.ANY
        for _ in range(5):
            text = draw()
            assert re.search(pattern, text) and any(all(t in text for t in clause) for clause in clauses), (pattern, text)
    assert asking > 500


def test_secrets_keep_columns_of_any_name(spark):
    odd = awkward(spark).selectExpr("*", "5 AS `start`", "'x' AS _kept")
    kept = [c for c in odd.columns]
    got = secrets.scan_secrets(odd, kept)
    assert sorted(got.columns) == sorted(kept) and dict(got.dtypes)["spans"].startswith("array")
    plain = sorted((repr(r.doc_id), repr(r.spans)) for r in secrets.scan_secrets(odd, ["doc_id"]).collect())
    assert sorted((repr(r.doc_id), repr(r.spans)) for r in got.collect()) == plain
    assert {(r.rules, r._row, r.word) for r in got.collect()} == {("rules", "_row", "word")}


def both_ways(df, query, sql, tmp_path):
    """Rows of a registered query and of its SQL over the given documents."""
    df.write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    mine = query(df.sparkSession, str(tmp_path))
    columns = sorted(mine.columns)
    theirs = connection.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    return sorted(map(tuple, mine.select(*columns).collect()), key=repr), sorted(theirs, key=repr)


def test_license_sql_on_wrapped_notices(spark, tmp_path):
    rng, rows = random.Random(1), []
    notices = ["all rights reserved", "gnu general public license version 2", "distributed on an \"as is\" basis, without warranties or conditions of any kind",
               "this is free and unencumbered software released into the public domain", "creative commons attribution 4.0 international", "mit license"]
    for number in range(90):
        text = rng.choice(notices)
        for gap in ("\n * ", "  ", "\t", "\n# ", " "):
            text = text.replace(" ", rng.choice(["\n * ", gap, " "]), rng.randrange(1, 4))
        rows.append((number, f"{' '.join(rng.sample(WORDS, 4))} {text}. {' '.join(rng.sample(WORDS, 3))}".upper() if number % 3 else text))
    df = spark.createDataFrame(rows, "doc_id long, text string").union(awkward(spark).where("doc_id is null or doc_id <> 7").select("doc_id", "text"))
    mine, theirs = both_ways(df, queries.license_query, oracles.license_sql(), tmp_path)
    assert mine == theirs
    assert license_scan.scan_licenses(df, ["doc_id"]).where("labels like '%all-rights-reserved%'").count() > 5


def test_personal_data_sql_on_far_and_touching_terms(spark, tmp_path):
    """Whole texts: terms near, far from and touching entities, shared by few and many documents."""
    rng = random.Random(8)
    names = ["Zanzibar", "quokka", "Ämter", "treasurer", "secret1", "note"]
    entities = ["anna@bank.example", "+49 (30) 123-4567", "4111 1111 1111 1111", "10.0.0.7", "bob@x.example"]
    rows = []
    for number in range(60):
        filler = [rng.choice(WORDS) for _ in range(rng.choice([3, 60]))]
        parts = [*filler, *rng.sample(names, rng.randrange(4)), *[rng.choice(entities) for _ in range(rng.randrange(3))]]
        rng.shuffle(parts)
        rows.append((number, rng.choice([" ", "", ", "] if len(parts) < 9 else [" "]).join(parts)))
    rows += [(100 + n, t) for n, (_, t) in enumerate(rows[:10])] + [(200, "abcd10.0.0.7efgh abcd 10.0.0.7"), (201, "abcd10.0.0.7 abcd")]
    df = spark.createDataFrame(rows, "doc_id long, text string").union(awkward(spark).where("doc_id is null or doc_id <> 7").select("doc_id", "text"))
    mine, theirs = both_ways(df, queries.pii_query, oracles.PERSONAL, tmp_path)
    assert mine == theirs and any("term:" in repr(row) for row in mine)


def brute_terms(rows):
    """(text, term) pairs that disclose, from the definition: information shared against the entity's own."""
    found = {}
    for _, text in rows:
        spans = [(k, m) for k, pattern, keep in ENTITIES for m in pattern.finditer(text) if keep(m)]
        blank = list(text)
        for _, m in spans:
            blank[m.start():m.end()] = " " * (m.end() - m.start())
        values = {k + ":" + (m[0].lower() if k == "email" else m[0] if k == "ip" else re.sub("[^0-9]", "", m[0])) for k, m in spans}
        found[text] = values, {w.lower() for w in TERM.findall("".join(blank))} if values else set(), {w.lower() for w in TERM.findall(text)}
    total = len(rows)
    holders, with_term, pairs, texts = Counter(), Counter(), Counter(), Counter()
    for _, text in rows:
        values, near, words = found[text]
        holders.update(values)
        with_term.update(words)
        pairs.update((e, t) for e in values for t in near)
    for values, near, _ in found.values():
        texts.update((e, t) for e in values for t in near)
    bad = {(e, t) for (e, t), n in pairs.items() if texts[e, t] >= pii.SUPPORT and holders[e] < total and
           math.log(n * total / (with_term[t] * holders[e])) / math.log(total / holders[e]) >= pii.DISCLOSURE}
    return {(text, t) for text, (values, near, _) in found.items() for t in near if any((e, t) in bad for e in values)}


TERM = re.compile(r"[A-Za-zÄ-ü][A-Za-zÄ-ü0-9]{3,}")
ENTITIES = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
)


def test_disclosing_terms_equal_brute_force(spark):
    rng = random.Random(4)
    names, entities = [f"name{n:02d}" for n in range(25)], ["anna@bank.example", "+49 (30) 123-4567", "carl@x.example", "dora@y.example"]
    rows = []
    for number in range(120):
        entity = rng.choice([*entities, ""])
        tied = [names[3 * entities.index(entity) + k] for k in range(3) if rng.random() < 0.8] if entity else []
        rows.append((number, " ".join([*tied, *rng.sample(names, 2), *rng.choices(WORDS, k=rng.choice([2, 50])), entity])))
    rows += [(500 + n, rows[n][1]) for n in range(0, 30, 3)]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ["text"]).collect()
    got = {(r.text, s.found) for r in found for s in r.spans if s.kind == "term"}
    assert got == brute_terms(rows) and len(got) > 20


def recall(vectors, asked, spark, shard_rows):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = ann_hnsw.nearest_neighbours(df, df.where(F.col("vec_id") % asked == 0), shard_rows=shard_rows).collect()
    hits, count = 0, 0
    for query in range(0, len(vectors), asked):
        # differences scaled by a power of two, so that their squares neither vanish nor overflow
        apart = vectors - vectors[query]
        scale = 2.0 ** -float(np.frexp(np.abs(apart).max())[1])
        distances = np.sqrt(((apart * scale) ** 2).sum(axis=1)) / scale
        distances[query] = np.inf
        mine = {r.vec_id: r.score for r in got if r.query_id == query}
        assert len(mine) == 10 and all(np.isclose(distances[v], s, rtol=1e-9) for v, s in mine.items())
        hits += sum(distances[v] <= np.sort(distances)[9] * (1 + 1e-12) for v in mine)
        count += 10
    return hits / count


@pytest.mark.parametrize("scale, offset", [(1e-25, 0), (1e25, 0), (1e-150, 0), (1e150, 0), (1e-4, 1), (1.0, 1e6)])
def test_neighbours_at_extreme_scales_and_offsets(spark, scale, offset):
    vectors = np.random.default_rng(6).standard_normal((500, 16)) * scale + offset
    assert recall(vectors, 20, spark, 250) >= 0.95


def test_neighbours_in_tight_clusters(spark):
    rng = np.random.default_rng(2)
    vectors = np.repeat(rng.standard_normal((60, 16)), 20, axis=0) + 1e-5 * rng.standard_normal((1200, 16))
    assert recall(vectors, 25, spark, 1200) >= 0.9


def test_few_candidates_are_all_returned(spark):
    rng = np.random.default_rng(3)
    far = np.concatenate([rng.standard_normal((40, 4)), 1e6 + rng.standard_normal((40, 4)), -1e9 + rng.standard_normal((20, 4))])
    assert recall(far, 5, spark, 4096) == 1.0


def bucket(word):
    return int(common.word_hashes(np.frombuffer(word.encode(), np.uint8), np.array([0]), np.array([len(word.encode())]))[0])


def brute_features(text):
    tokens = re.findall(r"[0-9a-z\x80-\U0010ffff]+|[^\s0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text), re.ASCII)
    words = [bucket(t) for t in tokens]
    pairs = [int(common.mix(np.array([(a * 3 + b) % 2 ** 64], np.uint64))[0]) for a, b in zip(words, words[1:])]
    return [value >> 48 for value in words + pairs]


@pytest.mark.parametrize("per_features", [None, 40.0])
def test_importance_sample_equals_brute_force(spark, per_features):
    """Counts, ratios, weights, draw and sample of the whole query, from the definition."""
    rng = random.Random(5)
    rows = [(f"k{n}", " ".join(rng.choice(WORDS if n % 3 else WORDS[:6]) + rng.choice(["", ",", "!"]) for _ in range(rng.randrange(60)))) for n in range(150)]
    rows += [("k7", rows[7][1]), (None, "no key"), ("empty", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    labels = spark.createDataFrame([(f"k{n}", int(n % 3 == 0)) for n in range(100)] + [(None, 1)], "doc_id string, quality int")
    got = importance.resample(docs, labels, share=0.3, per_features=per_features)
    good = {r.doc_id for r in labels.collect() if r.quality and r.doc_id}
    held = [brute_features(t or "") for _, t in rows]
    raw, target = np.zeros(1 << 16), np.zeros(1 << 16)
    for (key, _), values in zip(rows, held):
        np.add.at(raw, values, 1)
        if key in good:
            np.add.at(target, values, 1)
    ratio = np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    noise = {(r.doc_id, r.text): r.noise for r in docs.withColumn("noise", F.xxhash64("doc_id", "text", F.lit(11))).collect()}
    want = []
    for (key, text), values in zip(rows, held):
        weight = float(ratio[values].sum()) if values else 0.0
        uniform = (noise[key, text] % (1 << 52) + 0.5) / 2 ** 52
        scale = 1 if per_features is None else per_features / max(1, len(values))
        want.append((key, len(values), weight, weight * scale - math.log(-math.log(uniform))))
    cut = sorted((w[3] for w in want), reverse=True)[int(len(rows) * 0.3) - 1]
    mine = sorted(((r.doc_id or "", r.n_features, r.log_weight, r.gumbel_key, r.selected) for r in got.collect()))
    theirs = sorted(((k or "", n, w, g, g >= cut - 1e-9) for k, n, w, g in want))
    assert [m[:2] + m[4:] for m in mine] == [t[:2] + t[4:] for t in theirs]
    assert np.allclose([m[2:4] for m in mine], [t[2:4] for t in theirs], rtol=1e-9, atol=1e-9)
