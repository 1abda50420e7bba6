"""Merkle manifest of a dataset: child digests travel to parents in label order, then proof suffixes back to the leaves."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from palate.llm.common import fields_and, map_batches, release_model, sized_broadcast, written

# Children of a node; levels that one sweep climbs inside a block of FAN ** BAND nodes.
FAN, BAND = 8, 4
BLOCK = FAN ** BAND
CELL_ROWS = 50_000


def digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def levels_in(leaves: int, done: int) -> int:
    """Levels that a sweep from level `done` climbs in a tree of so many leaves."""
    return max(0, min(BAND, height(leaves) - done))


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    """H of the columns' values with their UTF-8 byte counts; '-' stands for null."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `idx`, the place 0, 1, ... inside their group by `order` (nulls first).

    Rows are dealt into cells by range of (group, order), and equal rows spread by a row number, so a hot group or value takes
    many cells; places inside a cell are shifted by the sizes of the group's earlier cells.
    """
    spark = rows.sparkSession
    cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // CELL_ROWS)
    sort = [F.col(c).asc_nulls_first() for c in [*order, "_tie"]]
    dealt = written(
        rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(cells, F.col(group).asc_nulls_first(), *sort)
        .withColumn("_cell", F.spark_partition_id()), "cells")
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # at most a row per cell
    shifts = dealt.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(group).alias("_group"), F.col("_cell").alias("_from"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*sort)) - 1
    placed = dealt.withColumn("_inside", inside).join(
        sized_broadcast(written(shifts, "shifts")), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_cell") == F.col("_from")))
    return placed.select(*rows.columns, (F.col("_inside") + F.col("_shift")).cast("long").alias("idx"))


def rows_of(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def packed(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 1024) -> Iterator[pa.RecordBatch]:
    held = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held), kinds)], names=names)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def climb(nodes: list[tuple[int, str]], levels: int) -> list[dict[int, list[str]]]:
    """Per level the children's digests of every parent: the time-forward sweep over one block's nodes.

    Nodes leave a priority queue in the order of their labels (level, index); each sends its digest to the queue under
    its parent's label, so that a parent comes up when all its children have been met.
    """
    queue = [((0, idx), value) for idx, value in nodes]
    heapq.heapify(queue)
    runs: list[dict[int, list[str]]] = [{} for _ in range(levels)]
    while queue:
        (level, idx), value = heapq.heappop(queue)
        if level == levels:
            continue
        run = runs[level].setdefault(idx // FAN, [])
        run.append(value)
        if not queue or queue[0][0][0] > level or queue[0][0][1] // FAN != idx // FAN:
            heapq.heappush(queue, ((level + 1, idx // FAN), digest(run)))
    return runs


def sweep_up(nodes: DataFrame, done: int) -> DataFrame:
    """The nodes `BAND` levels above (tree, leaves, idx, digest) at level `done`, those of finished trees at their root."""
    blocks = nodes.withColumn("_block", F.floor(F.col("idx") / BLOCK)).repartition("tree", "_block").sortWithinPartitions("tree", "_block", "idx")

    def parents(batches):
        for (tree, leaves, block), rows in groupby(rows_of(batches), key=lambda r: (r[0], r[1], r[4])):
            run = [(r[2], r[3]) for r in rows]
            levels = levels_in(leaves, done)
            if levels == 0:
                yield tree, leaves, run[0][0], run[0][1]
            else:
                (idx, children), = climb(run, levels)[-1].items()
                yield tree, leaves, idx, digest(children)

    def run(batches):
        release_model()
        yield from packed(parents(batches), ["tree", "leaves", "idx", "digest"], [pa.int64(), pa.int64(), pa.int64(), pa.string()])

    return map_batches(blocks.select("tree", "leaves", "idx", "digest", "_block"), run, "tree long, leaves long, idx long, digest string")


def proofs_of(nodes: list[tuple[int, str]], levels: int, suffix: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(index, proof) of a block's nodes: one string per level, the place in the run and the siblings' digests."""
    runs = climb(nodes, levels)
    for idx, _ in nodes:
        steps, place = [], idx
        for level in range(levels):
            run = runs[level][place // FAN]
            steps.append(f"{place % FAN}{''.join(run[:place % FAN] + run[place % FAN + 1:])}")
            place //= FAN
        yield idx, steps + suffix


def siblings_digest(proof: list[str]) -> str:
    return digest(step[1:] for step in proof)


def folded(leaf: str, proof: list[str]) -> str:
    """The root that a leaf and its proof give."""
    for step in proof:
        cut = 1 + 64 * int(step[0])
        leaf = digest((step[1:cut], leaf, step[cut:]))
    return leaf


def sweep_down(nodes: DataFrame, suffixes: DataFrame, done: int, work, schema: StructType) -> DataFrame:
    """`work` on every block's (tree, rows, levels, suffix): the reversed sweep from block roots to the nodes below.

    A block's message, the proof suffix of its root, sorts before its nodes, so it is at hand when they come up.
    """
    extra = [c for c in nodes.columns if c not in ("tree", "leaves", "idx", "digest")]
    below = nodes.select("tree", F.floor(F.col("idx") / BLOCK).alias("_block"), F.lit(1).alias("_kind"), "leaves", "idx", "digest",
                         F.lit(None).cast("array<string>").alias("suffix"), *extra)
    above = suffixes.select("tree", F.col("idx").alias("_block"), F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("leaves"),
                            F.lit(None).cast("long").alias("idx"), F.lit(None).cast("string").alias("digest"), "suffix",
                            *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in extra])
    names, kinds = schema.names, [to_arrow_type(f.dataType) for f in schema.fields]
    met = below.unionByName(above).repartition("tree", "_block").sortWithinPartitions("tree", "_block", "_kind", "idx")

    def blocks(batches):
        for (tree, _), rows in groupby(rows_of(batches), key=lambda r: r[:2]):
            message, rows = next(rows), list(rows)
            yield from work(tree, [r[4:6] + r[7:] for r in rows], levels_in(rows[0][3], done), message[6])

    def run(batches):
        release_model()
        yield from packed(blocks(batches), names, kinds)

    return map_batches(met, run, schema)


MESSAGE = StructType([StructField("tree", LongType()), StructField("idx", LongType()), StructField("suffix", ArrayType(StringType()))])


def passed_on(tree, rows, levels, suffix):
    for idx, proof in proofs_of([r[:2] for r in rows], levels, suffix):
        yield tree, idx, proof


def deliver(bands: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    """(tree, idx, suffix) of the nodes that are the lowest band's block roots, from those of the trees' roots."""
    for number in range(len(bands) - 1, 0, -1):
        # trees that ended below this band are in it with their root alone, which hands its message on
        suffixes = written(sweep_down(bands[number], suffixes, BAND * number, passed_on, MESSAGE), "suffixes")
    return suffixes


def grow(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes that each sweep starts from, and the roots, of trees over (tree, leaves, idx, digest)."""
    bands, most = [], leaves.agg(F.max("leaves")).first()[0]
    nodes, done = leaves.select("tree", "leaves", "idx", "digest"), 0
    while done == 0 or done < height(most):
        bands.append(nodes)
        nodes = written(sweep_up(nodes, done), "nodes")
        done += BAND
    return bands, nodes


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    presented: dict[str, Column] | None = None, proofs: bool = False,
) -> DataFrame:
    """key, group, leaf, subroot, root, proof_sha256, folded_root, verified of every row [, proof array<string>].

    A row's leaf is H, the hexadecimal SHA-256, of its `columns`. Per group leaves ascend by key (null first, then by
    digest); every FAN consecutive nodes become their H until one remains, the group's subroot; the subroots, ordered by
    group (null first, bytewise), likewise give the root. The proof of a row are the other nodes of its runs, level by
    level from the leaf to the root; `proof` has one string per level, the row's place in the run and the others' digests.
    `presented` are columns to verify in place of the stored ones: folded_root is recomputed from them and the proof.

    Null values are part of the digest, equal rows take places of their own, empty and very long texts are values like
    any other, one row alone is root and leaf, an empty table gives no rows; other columns are ignored.

    Digests leave the texts once; from then on rows are a few hundred bytes. Blocks of FAN ** BAND nodes are swept side by
    side; Spark's sorted shuffle takes messages from block to block, a queue inside the block from node to node.
    """
    presented = presented or {}
    shown = leaf_digest([presented.get(c, docs[c]) for c in columns]) if presented else F.lit(None).cast("string")
    leaves = written(docs.select(
        docs[key].alias("_key"), docs[group].cast("string").alias("_lang"), leaf_digest([docs[c] for c in columns]).alias("digest"),
        shown.alias("shown")), "leaves")
    groups = leaves.groupBy("_lang").agg(F.count(F.lit(1)).alias("leaves")).withColumn("_all", F.lit(0))
    trees = written(numbered(groups, "_all", ["_lang"]).select(F.col("_lang").alias("_own"), "leaves", F.col("idx").alias("tree")), "trees")
    total = trees.count()
    if not total:
        digests = [F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        empty = docs.limit(0).select(docs[key], docs[group].cast("string").alias(group), *digests, F.lit(True).alias("verified"))
        return empty.withColumn("proof", F.array(F.lit(""))) if proofs else empty
    placed = written(
        numbered(leaves, "_lang", ["_key", "digest"]).join(sized_broadcast(trees), F.col("_lang").eqNullSafe(F.col("_own")))
        .select("tree", "leaves", "idx", "digest", F.struct(F.col("_key").alias("key"), F.col("_lang").alias("lang")).alias("row"), "shown"), "placed")
    bands, roots = grow(placed)
    crowns = written(roots.select(F.lit(0).cast("long").alias("tree"), F.lit(total).cast("long").alias("leaves"), F.col("tree").alias("idx"), "digest"), "crowns")
    top, root = grow(crowns)
    root = root.first()["digest"]
    start = docs.sparkSession.createDataFrame([(0, 0, [])], "tree long, idx long, suffix array<string>")

    def crown(tree, rows, levels, suffix):  # a group's message: the proof of its subroot, then the subroot
        for (idx, value), (_, proof) in zip(rows, proofs_of(rows, levels, suffix)):
            yield idx, 0, [*proof, value]

    # the subroot stays the last entry of every suffix on its way down
    messages = deliver(bands, written(sweep_down(crowns, deliver(top, start), 0, crown, MESSAGE), "subroots"))

    def leaf(tree, rows, levels, suffix):
        for row, (_, proof) in zip(rows, proofs_of([r[:2] for r in rows], levels, suffix[:-1])):
            yield (row[2], row[1], suffix[-1], root, siblings_digest(proof), folded(row[3] or row[1], proof), *([proof] if proofs else []))

    result = fields_and([placed.schema["row"]], "leaf string, subroot string, root string, proof_sha256 string, folded_root string"
                        + (", proof array<string>" if proofs else ""))
    swept = sweep_down(placed, messages, 0, leaf, result)
    return swept.select(
        F.col("row.key").alias(key), F.col("row.lang").alias(group), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), *(["proof"] if proofs else []))
