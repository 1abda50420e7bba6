"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField

from palate.llm.common import ALNUM, LOWER, VISIBLE, fields_and, map_batches, mix, text_slices, word_bounds, word_hashes, written

# Buckets of the hashed unigrams and bigrams, and the count every bucket starts with.
BUCKETS = 1 << 16
SMOOTHING = 1.0
# Bound of the labelled sample that the target model is fitted on; models and weights cover all documents.
TARGET_ROWS = 20_000
# Features of a text whose mean log ratio the score is the logistic of.
TYPICAL = 64.0

MARKS = VISIBLE & ~ALNUM  # what is neither white space nor part of a word


def features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every token and of every pair of neighbours in the rows; tokens are words and runs of marks."""
    raw = LOWER[raw]
    starts, ends, _ = (np.concatenate(parts) for parts in zip(word_bounds(raw, bounds, ALNUM), word_bounds(raw, bounds, MARKS)))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    firsts = np.searchsorted(starts, bounds)
    words = word_hashes(raw, starts, ends)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(firsts))
    inner = np.flatnonzero(rows[1:] == rows[:-1])
    pairs = mix(words[inner] * np.uint64(3) + words[inner + 1])
    buckets = np.concatenate([words, pairs]) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    return np.concatenate([rows, rows[inner]]), buckets.astype(np.int64)


def hashed(key: Column) -> Column:
    """A number for keys of any type; equal keys of different types, such as 7 and '7', are the same key."""
    return F.xxhash64(key.cast("string"))


def target_rows(labels: DataFrame, key: str, label: str) -> np.ndarray:
    """Keys (hashed) of at most about TARGET_ROWS rows labelled 1, chosen by that hash: what the target model is fitted on."""
    good = labels.where((labels[label] == 1) & labels[key].isNotNull()).select(hashed(labels[key]).alias("key"))
    steps = 1 << 30
    share = min(1.0, TARGET_ROWS / max(1, good.count()))
    chosen = good.where(F.pmod("key", F.lit(steps)) < int(steps * share)).distinct()
    return np.sort(chosen.toPandas()["key"].to_numpy(np.int64))


def bucket_counts(docs: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every bucket over all documents (columns key, _text), and over those whose key is in `keys`."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def count(batches):
        keys = shared.value
        raw_total, target_total = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids = np.array([-1 if k is None else k for k in batch.column(0).to_pylist()], np.int64)
            wanted = np.isin(ids, keys) & ~np.asarray(batch.column(0).is_null())
            for first, last, raw, bounds in text_slices(batch.column(1)):
                rows, buckets = features(raw, bounds)
                raw_total += np.bincount(buckets, minlength=BUCKETS)
                target_total += np.bincount(buckets[wanted[first:last][rows]], minlength=BUCKETS)
        met = np.flatnonzero(raw_total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int64()), pa.array(raw_total[met]), pa.array(target_total[met])], names=["bucket", "raw", "target"])

    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    sums = map_batches(docs, count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    for row in sums.collect():  # BUCKETS rows at most
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket log p_target - log p_raw, both smoothed."""
    def log_share(counts):
        return np.log((counts + SMOOTHING) / (counts.sum() + SMOOTHING * BUCKETS))

    return log_share(target) - log_share(raw)


def importance_weights(docs: DataFrame, ratio: np.ndarray, key: str, text: str) -> DataFrame:
    """key, n_features, log_weight (sum of the ratios of the text's features) and mean_ratio per row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    schema = fields_and([StructField("key", docs.schema[key].dataType)], "n_features long, log_weight double, mean_ratio double")

    def run(batches):
        for batch in batches:
            counts, sums = [], []
            for _, _, raw, bounds in text_slices(batch.column(1)):
                rows, buckets = features(raw, bounds)
                counts.append(np.bincount(rows, minlength=len(bounds) - 1))
                sums.append(np.bincount(rows, shared.value[buckets], minlength=len(bounds) - 1))
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            sums = np.concatenate(sums) if sums else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.float64()),
                 pa.array(sums / np.maximum(counts, 1), pa.float64())], names=["key", "n_features", "log_weight", "mean_ratio"])

    return map_batches(docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("_text")), run, schema)


def resample(
    docs: DataFrame, labels: DataFrame, share: float = 0.5, seed: int = 11, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_features: float | None = None,
) -> DataFrame:
    """Every row's importance for text like the target's, and whether a sample of `share` of the rows holds it.

    Returns key, n_features, log_weight, score (0 to 1: logistic of TYPICAL mean log ratios), gumbel_key and selected.
    Raw counts cover all documents; the target's are of at most about TARGET_ROWS labelled rows. The sample is the top
    k of log_weight, the log ratio of the two models' probabilities of the text, plus Gumbel noise: a draw without
    replacement by importance. With `per_features` every text counts as if it had so many features, so that length does not
    decide. The noise is a hash of key, text and seed. Its cut is found from counts, so k is met up to ties, which stay together.
    Null texts and those of white space have weight 0 and score 0.5, repeated rows share their draw, null keys match no
    label, without labelled rows the target is uniform, an empty table gives no rows; other columns are ignored, keys may
    have any type that casts to a string. A very long text takes memory in proportion to its own length.
    """
    body = F.coalesce(docs[text], F.lit(""))
    keyed = docs.select(F.when(docs[key].isNotNull(), hashed(docs[key])).alias("key"), body.alias("_text"))
    raw, target = bucket_counts(keyed, target_rows(labels, key, label))
    marked = docs.select(docs[key], docs[text]).withColumn("_both", F.struct(
        docs[key], F.xxhash64(docs[key], docs[text], F.lit(seed)).alias("noise")))
    weights = importance_weights(marked, log_ratio(raw, target), "_both", text)
    uniform = (F.pmod(F.col("key.noise"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weight = F.col("log_weight") if per_features is None else F.col("mean_ratio") * per_features
    scored = weights.withColumn("gumbel_key", weight - F.log(-F.log(uniform)))
    scored = written(scored, "weights")
    total = scored.count()
    cut = smallest_kept(scored, "gumbel_key", int(total * share), total)
    return scored.select(
        F.col(f"key.{key}").alias(key), "n_features", "log_weight", (1 / (1 + F.exp(-F.col("mean_ratio") * TYPICAL))).alias("score"),
        "gumbel_key", (F.col("gumbel_key") >= F.lit(cut)).alias("selected"))


def smallest_kept(df: DataFrame, column: str, wanted: int, total: int) -> float:
    """The value of the `wanted`-th largest row: histograms of ever narrower ranges, none larger than 1,024 cells."""
    if wanted <= 0 or not total:
        return float("inf")
    low, high = df.agg(F.min(column), F.max(column)).first()
    cells, above = 1024, 0
    while True:
        width = (high - low) / cells
        if width <= 0 or low + width <= low:
            return low
        cell = F.least(F.floor((F.col(column) - low) / width), F.lit(cells - 1))
        counts = {r["cell"]: (r["n"], r["least"], r["most"]) for r in df.where(F.col(column).between(low, high)).groupBy(
            cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("least"), F.max(column).alias("most")).collect()}
        for number in sorted(counts, reverse=True):
            n, least, most = counts[number]
            if above + n >= wanted:
                break
            above += n
        if above + n == wanted or least == most:
            return least
        low, high = least, most
