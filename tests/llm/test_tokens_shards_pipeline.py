"""Byte-level BPE against the tiktoken library, shards, importance resampling, and the pipeline by stages."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from palate.llm import bpe, importance, queries, sharding
from tests.llm.cases import SCHEMA, awkward, no_rows
from tests.llm.test_joins_and_search import brute_components
from tests.llm.test_text_scans import brute_secrets

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as file:
        return bpe.Encoder(file.read(), public_tokenizers.PATTERN)


def test_pattern_is_the_public_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_encoder_equals_library_on_random_text(library, encoder):
    rng = random.Random(1)
    ranges = [(32, 127), (0, 0x300), (0x2000, 0x2100), (0x1F600, 0x1F700), (0x900, 0x980), (0x4E00, 0x4F00), (97, 100), (32, 33)]
    for _ in range(1500):
        picks = rng.sample(ranges, 3)
        text = "".join(chr(rng.randrange(*rng.choice(picks))) for _ in range(rng.randrange(60)))
        ids = " ".join(encoder.pieces(text))
        assert list(map(int, ids.split())) == library.encode_ordinary(text), text


def test_long_pre_tokens(library, encoder):
    rng = random.Random(4)
    for text in ("a" * 5_000, "ab" * 3_000, "é" * 4_000, " " * 5_000 + "x", "".join(rng.choice("abcde") for _ in range(8_000)), "!?" * 3_000):
        assert list(map(int, " ".join(encoder.pieces(text)).split())) == library.encode_ordinary(text)
    assert len(" ".join(encoder.pieces("abc" * 100_000)).split()) > 1_000  # near-linear: would not end otherwise


def test_documents_encode_and_decode(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.bpe_query(spark, sf_dir).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    odd = bpe.encode_documents(awkward(spark), RANKS, public_tokenizers.PATTERN, ["doc_id", "text"])
    back = bpe.decode_documents(odd, RANKS, ["doc_id", "text", "ids", "n_tokens", "round_trip"]).collect()
    assert len(back) == 12 and all(r.round_trip and r.decoded == (r.text or "") and len(r.ids) == r.n_tokens for r in back)
    assert all(list(r.ids) == library.encode_ordinary(r.text or "") for r in back)
    assert bpe.encode_documents(no_rows(spark), RANKS, public_tokenizers.PATTERN, ["doc_id"]).count() == 0


@pytest.mark.parametrize("total", [1, 2, 3, 16, 17, 1000, 4096, 5000])
def test_feistel_is_a_permutation(total):
    places = sharding.feistel(np.arange(total), total, 7)
    assert sorted(places) == list(range(total))
    one_by_one = [int(sharding.feistel(np.array([i]), total, 7)[0]) for i in range(min(total, 50))]
    assert one_by_one == places[:50].tolist()
    if total >= 1000:
        assert abs(np.corrcoef(np.arange(total), places)[0, 1]) < 0.1 and (sharding.feistel(np.arange(total), total, 8) != places).mean() > 0.9


def test_shards_are_even_gapless_and_repeatable(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    df = docs.union(awkward(spark).select("doc_id", "text"))
    rows = sharding.shard_documents(df, shards=16).collect()
    texts = sorted((zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 1, str(r.doc_id)) for r in df.collect())
    assert sorted((r.text_crc32, r.size, str(r.doc_id)) for r in rows) == texts
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(16)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shard_documents(df.repartition(7), shards=16).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert sharding.shard_documents(no_rows(spark)).count() == 0


def test_written_shards_hold_whole_rows(spark, tmp_path):
    rows = [(1, "same", "a"), (1, "same", "b"), (1, "same", "b"), (None, None, "c"), (None, "", "d"), (None, None, "c")]
    rows += [(i, f"text {i}", "e") for i in range(10, 60)] + [(7, "hot", "f")] * 300 + [(8, "warm", str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    held = sharding.write_shards(df, str(tmp_path / "shards"), shards=4).collect()
    assert sorted(map(repr, (tuple(r["_doc"]) for r in held))) == sorted(map(repr, rows))
    assert sorted(r.row_no for r in held) == list(range(len(rows))) and len({(r.shard, r.slot) for r in held}) == len(rows)
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={n}" for n in range(4)]
    digests = {(r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.row_no) for r in sharding.shard_documents(df, shards=4).collect()}
    assert digests == {(r["_doc"].doc_id, len((r["_doc"].text or "").encode()) + 1, zlib.crc32((r["_doc"].text or "").encode()),
                        r.shard, r.slot, r.row_no) for r in held}


def auc(scores, labels):
    good, bad = ([s for s, label in zip(scores, labels) if label == value] for value in (1, 0))
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_importance_separates_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    fit = labels.where("doc_id % 2 = 0")
    rows = importance.resample(docs, fit, share=0.3).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert auc([r.score for r in rows], [r.quality for r in rows]) > 0.95


def test_importance_weights_and_sample(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = importance.resample(docs, labels, share=0.25).collect()
    chosen = [r.gumbel_key for r in rows if r.selected]
    assert len(rows) == docs.count() and len(chosen) == len(rows) // 4
    assert min(chosen) > max(r.gumbel_key for r in rows if not r.selected)
    counts = {}
    for value in ("b b a", "a"):
        raw = np.frombuffer(value.encode(), np.uint8)
        counts[value] = np.bincount(importance.features(raw, np.array([0, len(raw)]))[1], minlength=importance.BUCKETS)
    assert counts["b b a"].sum() == 5 and counts["a"].sum() == 1
    ratio = importance.log_ratio(counts["b b a"] + counts["a"], counts["a"])
    brute = np.log((counts["a"] + 1) / (1 + importance.BUCKETS)) - np.log((counts["b b a"] + counts["a"] + 1) / (6 + importance.BUCKETS))
    assert np.allclose(ratio, brute)
    odd = importance.resample(awkward(spark).drop("label"), labels.limit(0)).collect()
    assert len(odd) == 12 and all(r.score == 0.5 for r in odd if r.n_features == 0)
    assert importance.resample(no_rows(spark), labels).count() == 0


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Each stage against brute force on its own input, which holds awkward rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").union(awkward(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "secret_scan", "byte_bpe"]

    kept = stages["language_id"](spark, docs, sf_dir).cache()
    gone = [r.text for r in docs.exceptAll(kept).collect()]
    wordless = [r.text for r in docs.collect() if not any(map(str.isalpha, r.text or ""))]
    assert kept.columns == docs.columns and sorted(map(repr, gone)) == sorted(map(repr, [*wordless, "x" * 50_000]))  # in no language

    single = stages["jaccard_join"](spark, kept, sf_dir).cache()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    keyed = brute_components([(i, t) for i, (_, t) in enumerate(rows)])
    group = {i: c for i, _, c in keyed}
    found = {}
    for r in single.collect():
        found.setdefault(group[rows.index((r.doc_id, r.text))], []).append(r)
    assert set(found) == set(group.values()) and all(len(v) == 1 for v in found.values()) and single.columns == docs.columns

    clean = stages["decontamination"](spark, single, sf_dir).cache()
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = [r for r in single.collect() if any(i in r.text for i in items)]
    assert leaked and sorted(map(repr, single.exceptAll(clean).collect())) == sorted(map(repr, leaked))

    safe = stages["secret_scan"](spark, clean, sf_dir).cache()
    assert safe.columns == docs.columns and safe.count() == clean.count()
    before, after = ({r.doc_id: r for r in df.collect()} for df in (clean, safe))
    for key, row in after.items():
        assert brute_secrets(row.text) == "" and (row == before[key]) == (brute_secrets(before[key].text) == "")
        assert "[SECRET:" not in row.text or row.n_chars == len(row.text)

    tokens = stages["byte_bpe"](spark, safe, sf_dir)
    assert tokens.count() == safe.count() and tokens.where("not round_trip").isEmpty()


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
