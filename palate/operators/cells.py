"""Exact inner-product top-k through cells of items: the triangle inequality decides which cells a query reads.

Items lie in k-means cells. With centre c and radius r of a cell (its farthest item's distance), every item x of it has
q.x = q.c + q.(x - c), at most q.c + |q| r. A query first reads the cells of best centre score until they hold k items; its
k-th score there is a floor, and of the other cells only those whose bound reaches the floor are read. The centres only steer
what is read: the answer is that of `topk_inner_product` whatever they are.

The centres are fitted on a hash sample of at most FIT_ROWS items a cell; every item is indexed. Centres and radii take at
most BROADCAST_BYTES, by fewer cells if need be. A crowded cell (copies of one vector, say) is cut into pieces of bounded
size, and the queries that read a cell into blocks: a task meets one piece and one block, so neither side need be small.
Items and queries without a vector take no part; more results than items, empty tables and equal vectors are defined cases.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from palate.functions.sampling import hash_sample
from palate.operators.topk import (
    BROADCAST_BYTES, CHUNK, ITEM_BLOCK, MAX_TASKS, QUERY_BLOCK, SCORE_DIGITS, _best, _block, _cut, _matrix, _output_schema)
from palate.session import keep_table

# Items that a cell holds on average, and items per cell that the centres are fitted on.
CELL_ROWS = 4096
FIT_ROWS = 64
FIT_ROUNDS = 10
# What a task takes on at most: scores that it computes, rows that it receives (beyond the tasks that MAX_TASKS allows: more).
TASK_SCORES = QUERY_BLOCK * ITEM_BLOCK // 4
TASK_ROWS = 4 * ITEM_BLOCK
# Items and queries of a unit, whatever the sizes of pieces and blocks: the larger a unit, the less often its rows are copied.
UNIT_ROWS = ITEM_BLOCK


def build_cells(items: DataFrame, folder: str, cells: int | None = None, piece_rows: int = ITEM_BLOCK, seed: int = 42) -> None:
    """Write the index of items (item_id unique, vec): `items` partitioned by cell, and `cells` with centre, radius and size."""
    items = items.select("item_id", "vec").where("vec IS NOT NULL")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    wanted = max(1, min(cells or math.ceil(size.n / CELL_ROWS), BROADCAST_BYTES // (8 * (size.dim or 1))))
    placed = keep_table(_placed(items, _centres(items, size.n, size.dim or 0, wanted, seed)), "placed")
    summary = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"), F.first("centre").alias("centre"),
    ).withColumn("pieces", F.ceil(F.col("n") / piece_rows).cast("int"))
    summary.write.mode("overwrite").parquet(f"{folder}/cells")
    known = placed.sparkSession.read.parquet(f"{folder}/cells").select("cell", "pieces")
    pieces = placed.join(F.broadcast(known), "cell").withColumn("piece", _block("item_id", F.col("pieces")))
    writer = pieces.select("item_id", "vec", "piece", "cell").repartition("cell", "piece").write.mode("overwrite")
    # an empty table has no folders: its one file keeps the schema
    (writer.partitionBy("cell") if size.n else writer).parquet(f"{folder}/items")


def _centres(items: DataFrame, n: int, dim: int, wanted: int, seed: int) -> np.ndarray:
    if n == 0 or wanted == 1:
        return np.zeros((1, dim))
    sample = hash_sample(items, "item_id", wanted * FIT_ROWS, seed)
    # k-means needs more different points than centres; else the points are the centres
    different = sample.select(F.col("vec").cast("array<double>").alias("vec")).distinct()
    few = different.limit(wanted + 1).toPandas()
    if len(few) <= wanted:
        return _matrix(few["vec"])
    points = different.select(array_to_vector("vec").alias("features"))
    return np.array(KMeans(k=wanted, initMode="random", seed=seed, maxIter=FIT_ROUNDS).fit(points).clusterCenters())


def _placed(items: DataFrame, centres: np.ndarray) -> DataFrame:
    """Every item with the cell of its nearest centre, that centre, and the distance to it."""
    shared = items.sparkSession.sparkContext.broadcast(centres)
    schema = T.StructType([*items.schema.fields]).add("cell", T.IntegerType()).add("distance", T.DoubleType()).add(
        "centre", T.ArrayType(T.DoubleType()))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        squares = (held * held).sum(axis=1)
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.iloc[start:start + CHUNK]
                vectors = _matrix(part["vec"])
                cell = (squares - 2 * vectors @ held.T).argmin(axis=1)
                yield part.assign(
                    cell=cell.astype(np.int32), distance=np.linalg.norm(vectors - held[cell], axis=1), centre=list(held[cell]))

    return items.mapInPandas(place, schema)


def cell_topk(spark: SparkSession, queries: DataFrame, folder: str, k: int, block: int = QUERY_BLOCK, scored=None) -> DataFrame:
    """For every query (query_id, vec) the k items of the index with the largest inner product: query_id, item_id, score, rank.

    `scored`, an accumulator of the session, adds up the scores that were computed.
    """
    items = spark.read.parquet(f"{folder}/items")
    # at most one row a cell, whose bytes build_cells has bounded
    cells = spark.read.parquet(f"{folder}/cells").orderBy("cell").toPandas()
    queries = queries.select("query_id", "vec").where("vec IS NOT NULL")
    schema = _output_schema(queries, items)
    if cells.empty:
        return spark.createDataFrame([], schema.add("rank", T.IntegerType()))
    shared = spark.sparkContext.broadcast((
        cells["cell"].to_numpy(np.int32), np.stack(cells["centre"].to_numpy()), cells["radius"].to_numpy(), cells["n"].to_numpy()))
    numbers = T.ArrayType(T.IntegerType())
    asked = keep_table(queries.mapInPandas(_homes(shared, k), T.StructType([*queries.schema.fields]).add("home", numbers)), "asked")
    first = asked.select("query_id", "vec", F.lit(float("-inf")).alias("floor"), F.explode("home").alias("cell"))
    near = keep_table(_cut(_read(first, items, cells, k, block, schema, scored), k), "near")
    floors = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    open_cells = asked.join(floors, "query_id", "left").mapInPandas(
        _others(shared), T.StructType([*queries.schema.fields]).add("floor", T.DoubleType()).add("more", numbers))
    # a query is kept once, with the list of its cells
    visits = keep_table(open_cells, "visits")
    second = visits.select("query_id", "vec", "floor", F.explode("more").alias("cell"))
    far = _read(second, items, cells, k, block, schema, scored)
    return _cut(near.drop("rank").unionByName(far), k)


def _homes(shared, k: int) -> Callable:
    """Adds the cells of best centre score that together hold k items."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, centres, _, sizes = shared.value
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.iloc[start:start + CHUNK]
                order = np.argsort(-(_matrix(part["vec"]) @ centres.T), axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                yield part.assign(home=[names[o[b < k]] for o, b in zip(order, before)])

    return choose


def _others(shared) -> Callable:
    """Replaces the cells read so far by those whose bound reaches the query's floor (all, if it found fewer than k)."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, centres, radii, _ = shared.value
        reach = np.linalg.norm(centres, axis=1) + radii
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.iloc[start:start + CHUNK]
                vectors, floor = _matrix(part["vec"]), part["floor"].to_numpy(np.float64)
                floor = np.where(np.isnan(floor), -np.inf, floor)
                lengths = np.linalg.norm(vectors, axis=1)[:, None]
                # the margin covers rounding of the scores and of this bound
                bound = vectors @ centres.T + lengths * radii + 1e-9 * lengths * reach + 2 * 10.0 ** -SCORE_DIGITS
                wanted = ~(bound < floor[:, None])  # a bound beyond doubles is no bound
                more = [names[w & ~np.isin(names, h)] for w, h in zip(wanted, part["home"])]
                yield part[["query_id", "vec"]].assign(floor=floor, more=more)

    return choose


def _read(visits: DataFrame, items: DataFrame, cells: pd.DataFrame, k: int, block: int, schema: T.StructType, scored) -> DataFrame:
    """The k best items per query and unit that reach the query's floor; a unit is some pieces of a cell and some blocks of its queries."""
    spark = visits.sparkSession
    wanted = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a cell
    units, total, scores, moved = [], 0, 0, 0
    for cell, n, pieces in zip(cells["cell"].tolist(), cells["n"].tolist(), cells["pieces"].tolist()):
        if cell in wanted:
            # pieces and blocks are put together up to UNIT_ROWS rows, so that rows are copied less often
            joint = max(1, UNIT_ROWS * pieces // n)
            groups = math.ceil(pieces / joint)
            blocks = math.ceil(wanted[cell] / max(block, UNIT_ROWS))
            units.append((cell, joint, groups, blocks, total))
            total += groups * blocks
            scores += n * wanted[cell]
            moved += n * blocks + wanted[cell] * groups
    if not units:
        return spark.createDataFrame([], schema)
    plan = F.broadcast(spark.createDataFrame(units, "cell int, joint long, groups int, blocks int, before long"))
    no_query, no_item = (
        F.lit("" if isinstance(schema[c].dataType, T.StringType) else 0).cast(schema[c].dataType).alias(c) for c in ("query_id", "item_id"))
    vector, unit = items.schema["vec"].dataType, F.col("before") + F.col("group") * F.col("blocks") + F.col("qb")
    asked = visits.join(plan, "cell").select(
        "*", _block("query_id", F.col("blocks")).alias("qb"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"),
    ).select(unit.alias("unit"), F.lit(0).alias("kind"), "query_id", no_item, F.col("vec").cast(vector).alias("vec"), "floor")
    # only the folders of the cells that some query reads
    held = items.where(F.col("cell").isin([u[0] for u in units])).join(plan, "cell").select(
        "*", F.expr("piece div joint").alias("group"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("qb"),
    ).select(unit.alias("unit"), F.lit(1).alias("kind"), no_query, "item_id", "vec", F.lit(0.0).alias("floor"))
    # small units share a task
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(scores / TASK_SCORES), math.ceil(moved / TASK_ROWS))
    parts = min(total, tasks, MAX_TASKS)
    spread = asked.unionByName(held).withColumn("part", (F.col("unit") % parts).cast("int")).repartitionById(parts, "part")

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        ask, have = rows[rows["kind"] == 0], rows[rows["kind"] == 1].sort_values("item_id")
        if ask.empty or have.empty:
            return pd.DataFrame({"query_id": ask["query_id"][:0], "item_id": have["item_id"][:0], "score": np.zeros(0)})
        left, right, floors, found = _matrix(ask["vec"]), _matrix(have["vec"]).T, ask["floor"].to_numpy(), []
        chunk = min(block, CHUNK)
        for start in range(0, len(ask), chunk):
            scores = np.round(left[start:start + chunk] @ right, SCORE_DIGITS)
            if scored is not None:
                scored.add(scores.size)
            scores[scores < floors[start:start + chunk, None]] = -np.inf
            r, c = _best(scores, k)
            found.append((r + start, c, scores[r, c]))
        r, c, score = (np.concatenate(parts) for parts in zip(*found))
        return pd.DataFrame({"query_id": ask["query_id"].to_numpy()[r], "item_id": have["item_id"].to_numpy()[c], "score": score})

    return spread.groupBy("part", "unit").applyInPandas(solve, schema)
