"""A reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from palate.llm.common import has_map, mix, row_hash, sized_broadcast, written
from palate.session import scratch_path

ROUNDS = 6
CELL_DIGITS = 3  # hex digits of a hash that form a cell: 4,096 cells
RUN = 4_096  # copies of a row that one task's step deals out


def feistel(numbers: np.ndarray, total: int, seed: int) -> np.ndarray:
    """A permutation of 0 .. total - 1, computable for any number on its own.

    A balanced Feistel network permutes 0 .. 4^h - 1, the smallest such range that holds `total` (under
    4 * total); numbers that fall outside are sent through again until they come back inside (cycle walking).
    """
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & low
        for round_ in range(ROUNDS):
            key = np.uint64((seed * ROUNDS + round_ + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            left, right = right, left ^ (mix(right + key) & low)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= np.uint64(total)]
    return out.astype(np.int64)


def number_ranges(docs: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """Distinct `keys` with the first of the numbers 0 .. n - 1 that their rows take (`first`), and n.

    Equal rows are counted before the shuffle and share a range of numbers. Numbers run inside cells of a
    hash of the keys and are shifted by the sizes of the earlier cells, so no cell holds a hot value's rows:
    its copies are one row with a count. The order is (cell, keys), the same in every run.
    """
    celled = (
        docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_cell", F.substring(F.md5(F.concat_ws("|", *keys)), 1, CELL_DIGITS))
    )
    earlier = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        celled.groupBy("_cell").agg(F.sum("_copies").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    )
    sizes = offsets.collect()  # one row per cell
    total = sum(row["_n"] for row in sizes)
    shifts = docs.sparkSession.createDataFrame([(row["_cell"], row["_offset"]) for row in sizes], "_cell string, _offset long")
    inside = Window.partitionBy("_cell").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    last = F.sum("_copies").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = (
        celled.withColumn("_last", last)
        .join(F.broadcast(shifts), "_cell")
        .select(*keys, (F.col("_offset") + F.col("_last") - F.col("_copies")).alias("first"))
    )
    return numbered, total


def dealt_out(rows: DataFrame, run: int = RUN) -> DataFrame:
    """A row per copy: `_doc` with row_no from `first` on, `copies` times; other columns go.

    Copies are cut into runs of at most `run` numbers, and the runs are spread by their number before they are dealt out, so
    neither an array nor a task holds all copies of a hot row.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / F.lit(run)))
    runs = (
        rows.select("_doc", "first", "copies", F.explode(starts).alias("run"))
        .select("_doc", (F.col("first") + F.col("run") * run).alias("from"), (F.col("first") + F.col("copies") - 1).alias("end"))
        .repartition(F.col("from"))
    )
    upto = F.least(F.col("from") + F.lit(run - 1), F.col("end"))
    return runs.select("_doc", F.explode(F.sequence("from", upto)).alias("row_no"))


def placed_rows(docs: DataFrame, shards: int, seed: int, key: str, text: str) -> DataFrame:
    """Every whole row as `_doc`, with shard, slot and row_no."""
    body = F.coalesce(docs[text], F.lit(""))
    keys = ["doc_id", "size", "crc", "hash"]
    rows = docs.select(
        docs[key].alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("crc"),
        row_hash(docs).alias("hash"), F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    first, total = number_ranges(rows.select(*keys[:3]), keys[:3])
    # one number range per (doc_id, size, crc); inside it rows of different content by their hash, in slices, so that no
    # task holds a hot key's rows
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).withColumn("slice", F.pmod("hash", F.lit(4096)))
    slices = counted.groupBy(*keys[:3], "slice").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy(*keys[:3]).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy(*keys[:3], "slice").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))

    def same(left, right, names):
        return functools.reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])

    starts = (
        slices.join(first, same(slices, first, keys[:3])).select(*[slices[k] for k in keys[:3]], "slice", (F.col("first") + F.col("before")).alias("base")))
    starts = counted.join(starts, same(counted, starts, [*keys[:3], "slice"])).select(
        *[counted[k] for k in keys], "copies", (F.col("base") + F.col("inside")).alias("start"))
    starts = written(starts, "starts")
    once, more = starts.where("copies = 1"), starts.where("copies > 1")
    single = rows.join(once, same(rows, once, keys)).select("_doc", F.col("start").alias("row_no"))
    # equal rows are counted before they are dealt out; rows that only share the hash follow each other
    kept = rows.join(sized_broadcast(more), same(rows, more, keys)).groupBy("_doc", "start").agg(F.count(F.lit(1)).alias("copies"))
    # maps have no order of their own
    order = F.to_json("_doc") if has_map(rows.schema["_doc"].dataType) else F.col("_doc")
    upto = Window.partitionBy("start").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    repeated = dealt_out(kept.withColumn("first", F.col("start") + F.sum("copies").over(upto) - F.col("copies")))

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(feistel(numbers.to_numpy(), total, seed))

    return single.union(repeated).withColumn("_place", place("row_no")).select(
        "_doc", (F.col("_place") % shards).cast("int").alias("shard"), F.floor(F.col("_place") / shards).cast("long").alias("slot"), "row_no")


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The shards as Parquet under `path`, a folder per shard, of whole rows (`_doc`) with slot and row_no; read again."""
    placed = placed_rows(docs, shards, seed, key, text)
    placed.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the shards, which are written with whole rows: place p of a row's number in the shuffle gives shard
    p mod shards, slot p div shards.

    Returns key, size (UTF-8 bytes + 1), text_crc32, law 'rows', shard, slot, row_no, derived from the written texts. Row
    counts of shards differ by one at most and slots have no gaps. Null texts count as empty in size and checksum, null ids
    are a value like any other, equal rows take different places, an empty table gives no rows.
    """
    held = write_shards(docs, scratch_path(docs.sparkSession, "shards"), shards, seed, key, text)
    body = F.coalesce(F.col("_doc")[text], F.lit(""))
    return held.select(
        F.col("_doc")[key].alias(key), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", "row_no")
