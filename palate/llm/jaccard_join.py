"""Exact n-gram Jaccard join and its components: a grouped prefix join that never lists all pairs of a group."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField

from palate.llm.common import BASE, LOWER, VISIBLE, fields_and, map_batches, mix, release_model, sized_broadcast, text_slices, word_bounds, word_hashes, written

# Counts of shingles are kept per cell of this many hash bits; the twice-seen filter takes 2^CELL_BITS / 8 bytes (32 MB).
CELL_BITS = 28
RANGES = 1024
# Only so many cells, the fullest, travel with their counts (12 bytes each) to order shingles.
FULL_CELLS = 1 << 19


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """Per row the sorted distinct 64-bit hashes of its word shingles: all runs of `width` words, or its few words as one."""
    raw = LOWER[raw]
    starts, ends, firsts = word_bounds(raw, bounds, VISIBLE)
    words = word_hashes(raw, starts, ends)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for place in range(width):
        rolled = rolled * BASE + mix(words[place:place + len(rolled)])
    rolled = mix(rolled)
    out = []
    for first, last in zip(firsts[:-1], firsts[1:]):
        if last - first >= width:
            out.append(np.unique(rolled[first:last - width + 1]))
        elif last > first:
            value = np.array([last - first], np.uint64)
            for word in range(first, last):
                value = mix(value * BASE + words[word:word + 1])
            out.append(value)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def cell_counts(docs: DataFrame, text: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents per cell of the shingle hash, over all documents: a packed filter of the cells seen twice or more, and the
    fullest cells with their counts.

    Tasks send sorted cell numbers as byte deltas, one row per range of cells; ranges are counted apart from each
    other. What comes back has a fixed size. Both are hints only: the join is exact for any counts.
    """
    shift = np.uint64(64 - CELL_BITS)
    span = (1 << CELL_BITS) // RANGES

    def send(parts):
        cells = np.sort(np.concatenate(parts))
        cuts = np.searchsorted(cells, np.arange(RANGES + 1) * span)
        ranges, kinds, blobs = [], [], []
        for number in np.flatnonzero(np.diff(cuts)):
            deltas = np.diff(cells[cuts[number]:cuts[number + 1]] - number * span, prepend=0)
            kind = "u1" if deltas.max() < 256 else "u2" if deltas.max() < 65536 else "u4"
            ranges.append(int(number))
            kinds.append(kind)
            blobs.append(deltas.astype(kind).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(ranges, pa.int32()), pa.array(kinds, pa.string()), pa.array(blobs, pa.binary())], names=["number", "kind", "deltas"])

    def scan(batches):
        release_model()
        parts, held = [], 0
        for batch in batches:
            for _, _, raw, bounds in text_slices(batch.column(0)):
                sets = shingle_sets(raw, bounds, width)
                parts.append((np.concatenate(sets) >> shift).astype(np.int64))
                held += len(parts[-1])
                if held > 2_000_000:
                    yield send(parts)
                    parts, held = [], 0
        if held:
            yield send(parts)

    def count(rows):
        number = int(rows["number"].iloc[0])
        counts = np.zeros(span, np.int64)
        for kind, deltas in zip(rows["kind"], rows["deltas"]):
            np.add.at(counts, np.cumsum(np.frombuffer(deltas, kind).astype(np.int64)), 1)
        full = np.flatnonzero(counts >= 8)
        seen = np.packbits(counts >= 2).tobytes()
        return pd.DataFrame({"number": [number], "seen": [seen], "cells": [(full + number * span).tolist()], "counts": [counts[full].tolist()]})

    counted = written(
        map_batches(docs.select(docs[text].alias("_text")), scan, "number int, kind string, deltas binary")
        .groupBy("number").applyInPandas(count, "number int, seen binary, cells array<long>, counts array<long>"), "cells")
    seen = np.zeros((RANGES, span // 8), np.uint8)
    for row in counted.select("number", "seen").collect():
        seen[row["number"]] = np.frombuffer(row["seen"], np.uint8)
    pairs = counted.select(F.explode(F.arrays_zip("cells", "counts")).alias("p")).select("p.cells", "p.counts")
    # the smallest count that leaves FULL_CELLS cells at most
    least, total = 1 << 62, 0
    by_size = pairs.groupBy(F.least("counts", F.lit(1 << 16)).alias("size")).count().collect()
    for row in sorted(by_size, key=lambda r: -r["size"]):
        total += row["count"]
        if total > FULL_CELLS:
            break
        least = row["size"]
    full = pairs.where(F.col("counts") >= least).toPandas().sort_values("cells")
    return seen.ravel(), full["cells"].to_numpy(np.int64), full["counts"].to_numpy(np.int64)


def minimum_overlap(first: Column, second: Column, percent: int) -> Column:
    """The least intersection with which sets of these sizes link."""
    return F.ceil((first + second) * F.lit(percent) / F.lit(100.0 + percent) - F.lit(1e-9)).cast("long")


def sizes_fit(first: Column, second: Column, percent: int) -> Column:
    return F.least(first, second) * 100 >= F.greatest(first, second) * percent


def prefix_table(docs: DataFrame, text: str, key: str, width: int, percent: int) -> DataFrame:
    """Per document: n (set size), uid (hash of the set), gid (hash of size and prefix), tokens and their places.

    Shingles are ordered by the count of their cell, rare ones first, then by hash. Two sets that link share a
    shingle among the first n - ceil(percent * n / 100) + 1 of each. Shingles of cells seen once match nothing and
    are left out of the tokens.
    """
    seen, full, counts = cell_counts(docs, text, width)
    model = docs.sparkSession.sparkContext.broadcast((seen, full, counts))
    shift, bits = np.uint64(64 - CELL_BITS), np.uint64(24)

    def run(batches):
        seen, full, counts = model.value
        for batch in batches:
            sizes, uids, gids, tokens, places, lengths = [], [], [], [], [], []
            for _, _, raw, bounds in text_slices(batch.column(2)):
                for shingles in shingle_sets(raw, bounds, width):
                    n = len(shingles)
                    sizes.append(n)
                    if not n:
                        uids.append(None)
                        gids.append(None)
                        lengths.append(0)
                        continue
                    cells = (shingles >> shift).astype(np.int64)
                    weights = np.zeros(n, np.int64)
                    if len(full):
                        found = np.minimum(np.searchsorted(full, cells), len(full) - 1)
                        weights = np.where(full[found] == cells, counts[found], 0)
                    order = np.argsort(weights, kind="stable")[:n - -(-percent * n // 100) + 1]
                    prefix = shingles[order]
                    uids.append(int(mix(mix(shingles ^ BASE).sum(keepdims=True) + np.uint64(n)).view(np.int64)[0]))
                    gids.append(int(mix(mix(prefix).sum(keepdims=True) * BASE + np.uint64(n)).view(np.int64)[0]))
                    cells = cells[order]
                    shared = np.flatnonzero(seen[cells >> 3] >> (7 - (cells & 7)) & 1)
                    tokens.append((prefix[shared] >> bits).astype(np.int64))
                    places.append(shared.astype(np.int32))
                    lengths.append(len(shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(uids, pa.int64()), pa.array(gids, pa.int64()),
                 list_array(lengths, tokens, np.int64), list_array(lengths, places, np.int32)],
                names=["key", "tk", "n", "uid", "gid", "tokens", "places"])

    schema = fields_and([StructField("key", docs.schema[key].dataType)], "tk long, n long, uid long, gid long, tokens array<long>, places array<int>")
    rows = docs.select(docs[key].alias("key"), F.xxhash64(docs[text]).alias("tk"), docs[text].alias("_text"))
    table = written(map_batches(rows, run, schema), "prefixes")
    model.destroy()  # nothing reads it again: the table is written
    return table


def list_array(lengths: list[int], parts: list[np.ndarray], kind) -> pa.ListArray:
    """Arrow lists of these lengths from their concatenated parts."""
    values = np.concatenate(parts) if parts else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values.astype(kind)))


def set_table(docs: DataFrame, keys: DataFrame, text: str, width: int) -> DataFrame:
    """uid and sorted shingle hashes of the texts whose key (xxhash64) is in `keys`."""
    def run(batches):
        for batch in batches:
            uids, sets, lengths = [], [], []
            for _, _, raw, bounds in text_slices(batch.column(0)):
                for shingles in shingle_sets(raw, bounds, width):
                    if len(shingles):
                        uids.append(int(mix(mix(shingles ^ BASE).sum(keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0]))
                        sets.append(shingles.view(np.int64))
                        lengths.append(len(shingles))
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), list_array(lengths, sets, np.int64)], names=["uid", "shingles"])

    texts = docs.select(docs[text].alias("_text"), F.xxhash64(docs[text]).alias("tk"))
    chosen = texts.join(sized_broadcast(keys), "tk", "left_semi").select("_text")
    return map_batches(chosen, run, "uid long, shingles array<long>").groupBy("uid").agg(F.first("shingles").alias("shingles"))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of uids whose sets link."""
    left, right = sets.select(F.col("uid").alias("a"), F.col("shingles").alias("sa")), sets.select(
        F.col("uid").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(
        common * (100 + percent) >= (F.size("sa") + F.size("sb")) * percent).select("a", "b")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of `edges` (a, b).

    Alternating large and small stars: every round is two shuffled aggregates and joins, hubs are never gathered.
    """
    def oriented(pairs):
        return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(table):
        row = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    current = written(oriented(edges), "edges")
    before = None
    while (now := state(current)) != before and now[0]:
        before = now
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = oriented(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        current = written(oriented(small), "edges")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.union(stars.select(F.col("label").alias("node"), "label").distinct())


def jaccard_components(
    docs: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """key, n_shingles and component_id of every row; rows link at `percent` Jaccard or more of their shingle sets.

    1. Documents with the same size and prefix form a group; groups that share a prefix shingle (a bucket) meet.
    2. Groups expand to their distinct sets. In every bucket the set with the fewest rare shingles is the pivot; the
       others are verified against it, if sizes and places allow a link.
    3. What that leaves apart meets again: of each bucket only sets outside the pivot's component, only size classes
       and places that allow a link, only pairs of different components. So every link joins two sets of one
       component, while a group of n copies costs about n pairs.
    Words are what lies between space, \\t \\n \\v \\f \\r, with A-Z lowered; a text of fewer than `width` words is one shingle.
    Rows without words or text have n_shingles 0 and their own key as component. component_id is the smallest key of
    the component; repeated rows and copies share it; null keys are ignored in it; an empty table gives no rows; other
    columns are ignored. Shingles and sets are compared by 64-bit hashes.
    """
    table = prefix_table(docs, text, key, width, percent)
    some = table.where("n > 0")
    groups = some.groupBy("gid", "n").agg(F.first(F.struct("tokens", "places")).alias("p"))
    tokens = groups.select("gid", "n", F.explode(F.arrays_zip("p.tokens", "p.places")).alias("t")).select(
        "gid", "n", F.col("t.tokens").alias("token"), (F.col("n") - F.col("t.places")).alias("rest"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    members = written(some.groupBy("uid", "gid", "n").agg(F.min("key").alias("least"), F.min("tk").alias("tk")), "members")
    crowded = members.groupBy("gid").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gid")
    entries = written(
        tokens.join(shared, "token").join(members.select("gid", "uid"), "gid").select("token", "uid", "n", "rest")
        .union(members.join(crowded, "gid").select(F.col("gid").bitwiseOR(F.lit(-1 << 63)).alias("token"), "uid", "n", F.col("n").alias("rest"))),
        "entries")

    # size classes of a bucket that may hold links: sizes n and n2, at least `need` shingles from the shared one on
    classes = entries.groupBy("token", "n").agg(F.count(F.lit(1)).alias("c"), F.max("rest").alias("most"))
    other = classes.select("token", F.col("n").alias("n2"), F.col("c").alias("c2"), F.col("most").alias("most2"))
    need = minimum_overlap(F.col("n"), F.col("n2"), percent)
    fits = written(
        classes.join(other, "token").where(sizes_fit(F.col("n"), F.col("n2"), percent)).withColumn("need", need)
        .where("least(most, most2) >= need and (n <> n2 or c > 1)").select("token", "n", "n2", "need"), "classes")
    hopeful = fits.groupBy("token", "n").agg(F.min("need").alias("need"))
    entries = written(entries.join(hopeful, ["token", "n"]).where("rest >= need").select("token", "uid", "n", "rest"), "hopeful")
    keys = members.select("uid", "tk").join(entries.select("uid").distinct(), "uid").select("tk").distinct()
    sets = written(set_table(docs, written(keys, "keys"), text, width), "sets")

    pivots = entries.groupBy("token").agg(F.min(F.struct((F.col("n") - F.col("rest")).alias("place"), "uid", "n", "rest")).alias("p")).select(
        "token", F.col("p.uid").alias("pivot"), F.col("p.n").alias("n2"), F.col("p.rest").alias("rest2"))
    first = written(
        entries.join(pivots, "token").where("uid <> pivot").where(sizes_fit(F.col("n"), F.col("n2"), percent))
        .where(F.least("rest", "rest2") >= need).select(F.greatest("uid", "pivot").alias("a"), F.least("uid", "pivot").alias("b"))
        .distinct(), "first")
    edges = written(linked(first, sets, percent), "links")
    labels = connected_components(edges)

    placed = entries.join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    placed = written(placed, "placed")
    at = placed.select("token", F.col("uid").alias("pivot"), F.col("label").alias("home"))
    outside = placed.join(pivots.join(at, ["token", "pivot"]).select("token", "home"), "token").where("label <> home")
    partners = placed.select("token", F.col("n").alias("n2"), F.col("uid").alias("uid2"), F.col("rest").alias("rest2"), F.col("label").alias("label2"))
    second = (
        outside.join(fits, ["token", "n"]).where("rest >= need").join(partners, ["token", "n2"])
        .where("rest2 >= need and label <> label2")
        .select(F.greatest("uid", "uid2").alias("a"), F.least("uid", "uid2").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    )
    more = written(linked(second, sets, percent), "links")
    if more.isEmpty():
        final = labels
    else:
        final = connected_components(edges.union(more))

    units = members.select("uid", "least").join(final.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    smallest = units.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = units.join(smallest, "label").select("uid", "component_id")
    return table.join(ids, "uid", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))
