"""Exact inner-product top-k between two tables of vectors.

Three physical strategies give the same answer:

* broadcast: the query matrix is small (its size and the k rows kept per query are checked), so it travels to the
  corpus. The corpus is scanned in place, each task keeps k rows per query, and only those are shuffled.
* items: the item matrix is small (its size is checked), so it travels to the queries, which meet their
  exclusions (item numbers, at most as many as there are items) and are answered in place. Items are scored by falling
  length until none of those left can reach the k-th best score.
* blocks: neither side may be broadcast. Both are hashed into blocks, and a task meets one (query block, item
  block) cell: it holds the queries (of bounded size) with their k best so far, while the items stream by in id order, `block`
  of them at a time. How often a row is copied depends on the tasks, not on `block`. Pairs to leave out are hashed to the cell
  they fall in and masked there; more query blocks are made if their number per block would be large.

Scores are rounded to SCORE_DIGITS decimals; equal scores are ordered by corpus id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SCORE_DIGITS = 9
BROADCAST_BYTES = 64 * 1024 * 1024
# A cell holds at most about QUERY_BLOCK x ITEM_BLOCK scores, computed CHUNK queries at a time.
QUERY_BLOCK = 2048
ITEM_BLOCK = 16384
CHUNK = 256
# Block strategy: bytes of the queries and their k best that a task holds, pairs to leave out that it holds, scores of
# a task beyond which more tasks are made, items that it meets at once.
BLOCK_BYTES = 128 * 1024 * 1024
BLOCK_PAIRS = 4_000_000
TASK_SCORES = 1 << 36
TILE = 2048
# Items by falling length that are scored before a query is asked whether it is done.
LENGTH_BLOCK = 512
MAX_TASKS = 50_000
# Rows that a task of the broadcast strategy may keep: queries * k.
KEPT_ROWS = 250_000
# Query blocks of a cell of groups: the more, the less often an item is copied.
GROUP_BLOCKS = 4


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every row's k best finite scores; columns are in id order, so early ties win."""
    keep = np.isfinite(scores)
    width = scores.shape[1]
    if width > k:
        kth = np.partition(scores, width - k, axis=1)[:, width - k, None]
        above = scores > kth
        tied = scores == kth
        wanted = k - above.sum(axis=1, keepdims=True)
        keep &= above | (tied & (np.cumsum(tied, axis=1) <= wanted))
    return np.nonzero(keep)


def _cut(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _output_schema(queries: DataFrame, items: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("item_id", items.schema["item_id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _broadcast_topk(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    # the caller has checked the size of this table against BROADCAST_BYTES
    table = queries.orderBy("query_id").toPandas()
    schema = _output_schema(queries, items)
    if table.empty:
        return queries.sparkSession.createDataFrame([], schema.add("rank", T.IntegerType()))
    shared = queries.sparkSession.sparkContext.broadcast((table["query_id"].to_numpy(), _matrix(table["vec"])))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix = shared.value
        kept: pd.DataFrame | None = None
        for batch in batches:
            if batch.empty:
                continue
            batch = batch.sort_values("item_id", kind="stable")
            item_ids, item_matrix = batch["item_id"].to_numpy(), _matrix(batch["vec"]).T
            parts = []
            for start in range(0, len(matrix), CHUNK):
                scores = np.round(matrix[start:start + CHUNK] @ item_matrix, SCORE_DIGITS)
                r, c = _best(scores, k)
                parts.append(pd.DataFrame({"q": r + start, "item_id": item_ids[c], "score": scores[r, c]}))
            found = pd.concat(parts)
            merged = found if kept is None else pd.concat([kept, found])
            # a task never holds more than k rows per query
            kept = (
                merged.sort_values(["q", "score", "item_id"], ascending=[True, False, True])
                .groupby("q", sort=False).head(k)
            )
        if kept is not None:
            yield pd.DataFrame({"query_id": ids[kept["q"].to_numpy()], "item_id": kept["item_id"], "score": kept["score"]})

    return _cut(items.select("item_id", "vec").mapInPandas(scan, schema), k)


class OrderedItems:
    """Items by falling length, in blocks: a query is done once its length times that of the next item cannot reach its k-th score.

    Scores are inner products, at most the product of both lengths; a margin covers rounding. What is left out can neither
    enter the k best nor tie with them.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        lengths = np.linalg.norm(matrix, axis=1)
        self.order = np.argsort(-lengths, kind="stable")  # `ids` come sorted: equal lengths stay in id order
        self.ids, self.matrix, self.lengths = ids[self.order], matrix[self.order].T.copy(), lengths[self.order]
        self.place = np.empty(len(ids), np.int64)
        self.place[self.order] = np.arange(len(ids))

    def best(self, queries: np.ndarray, left_out: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(row, place, score) of every query's k best items, and how many scores were computed; `left_out` are item numbers."""
        gone = [self.place[n] for n in left_out]
        own = np.repeat(np.arange(len(queries)), [len(g) for g in gone])
        at = np.concatenate(gone) if gone else np.zeros(0, np.int64)
        by_place = np.argsort(at, kind="stable")
        own, at = own[by_place], at[by_place]
        lengths = np.linalg.norm(queries, axis=1)
        rows, top = np.arange(len(queries)), np.full((len(queries), k), -np.inf)  # the k best scores so far
        kth = np.full(len(queries), -np.inf)
        kept, computed, first = [], 0, 0
        while len(rows) and first < len(self.ids):
            last = min(first + LENGTH_BLOCK, len(self.ids))
            block = queries[rows] @ self.matrix[:, first:last]
            computed += block.size
            lo, hi = np.searchsorted(at, [first, last])
            if hi > lo:
                where = np.full(len(queries), -1)
                where[rows] = np.arange(len(rows))
                here = where[own[lo:hi]]
                block[here[here >= 0], at[lo:hi][here >= 0] - first] = -np.inf
            # only scores that can still be among the k best are rounded, kept and merged
            r, c = np.nonzero(block >= np.maximum(kth[rows] - 10.0 ** -SCORE_DIGITS, np.finfo(float).min)[:, None])
            values = np.round(block[r, c], SCORE_DIGITS)
            kept.append((rows[r], c + first, values))
            counts = np.bincount(r, minlength=len(rows))
            fresh = np.full((len(rows), int(counts.max(initial=0))), -np.inf)
            fresh[r, np.arange(len(r)) - np.repeat(np.cumsum(counts) - counts, counts)] = values
            both = np.concatenate([top[rows], fresh], axis=1)
            top[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            kth[rows] = top[rows].min(axis=1)
            first = last
            if first < len(self.ids):
                reach = lengths[rows] * self.lengths[first]
                rows = rows[kth[rows] <= reach * (1 + 1e-9) + 2 * 10.0 ** -SCORE_DIGITS]
        if not kept:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0
        r, c, values = (np.concatenate(parts) for parts in zip(*kept))
        final = values >= kth[r]
        r, c, values = r[final], c[final], values[final]
        # by query, falling score, id: of those equal to the k-th the smallest ids stay
        order = np.lexsort((self.order[c], -values, r))
        r, c, values = r[order], c[order], values[order]
        starts = np.searchsorted(r, np.arange(len(queries)))
        within = np.arange(len(r)) - starts[r] < k
        return r[within], c[within], values[within], computed


def _items_topk(queries: DataFrame, items: DataFrame, k: int, exclude: DataFrame | None, scored=None) -> DataFrame:
    # the caller has checked the size of the item table
    table = items.orderBy("item_id").toPandas()
    schema = _output_schema(queries, items)
    schema.add("rank", T.IntegerType())
    if table.empty:
        return queries.sparkSession.createDataFrame([], schema)
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((table["item_id"].to_numpy(), _matrix(table["vec"])))
    if exclude is None:
        asked = queries.withColumn("left_out", F.lit(None).cast("array<int>"))
    else:
        # items by number: a query's list is at most as long as the checked item table
        numbers = spark.createDataFrame(
            [(i, n) for n, i in enumerate(table["item_id"].tolist())], T.StructType([items.schema["item_id"], T.StructField("number", T.IntegerType())]))
        known = exclude.join(F.broadcast(numbers), "item_id")
        asked = queries.join(known.groupBy("query_id").agg(F.collect_set("number").alias("left_out")), "query_id", "left")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = OrderedItems(*shared.value)
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.iloc[start:start + CHUNK]
                gone = [np.zeros(0, np.int64) if g is None else np.asarray(g, np.int64) for g in part["left_out"]]
                r, c, scores, computed = items.best(_matrix(part["vec"]), gone, k)
                if scored is not None:
                    scored.add(computed)
                rank = np.arange(len(r)) - np.searchsorted(r, r) + 1
                yield pd.DataFrame({
                    "query_id": part["query_id"].to_numpy()[r], "item_id": items.ids[c], "score": scores, "rank": rank.astype(np.int32)})

    return asked.select("query_id", "vec", "left_out").mapInPandas(answer, schema)


def best_groups(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """For every query the k groups with the best item: query_id, group_id, item_id (the best one), score, rank.

    items: item_id, group_id, vec. Each part of the items keeps the best k groups per query, each with its best item; a
    group among the best k overall is among the best k of the part that holds its best item, so nothing is lost. Few
    queries (size checked) travel to the items, whose parts are the scan's tasks; else both sides are dealt into cells of
    bounded size, one job for any number of queries. Equal groups go by id.
    """
    queries, items = queries.select("query_id", "vec"), items.select("item_id", "group_id", "vec")
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("group_id", items.schema["group_id"].dataType),
        T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("score", T.DoubleType())])
    if size.n * (size.dim or 0) * 8 <= BROADCAST_BYTES and size.n * k <= KEPT_ROWS:
        found = _scanned_groups(queries, items, k, schema)
    else:
        found = _celled_groups(queries, items, k, schema, size.n)
    best = found.groupBy("query_id", "group_id").agg(F.min(F.struct((-F.col("score")).alias("score"), "item_id")).alias("b")).select(
        "query_id", "group_id", F.col("b.item_id").alias("item_id"), (-F.col("b.score")).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "group_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _grouped(batch: pd.DataFrame, matrix: np.ndarray, k: int) -> pd.DataFrame:
    """(q, group_id, item_id, score): the best k groups of the batch's items for every query row, with their best items."""
    batch = batch.sort_values(["group_id", "item_id"], kind="stable")
    groups, item_ids = batch["group_id"].to_numpy(), batch["item_id"].to_numpy()
    first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    ends = np.append(first[1:], len(groups))
    item_matrix, parts = _matrix(batch["vec"]).T, []
    for start in range(0, len(matrix), CHUNK):
        scores = np.round(matrix[start:start + CHUNK] @ item_matrix, SCORE_DIGITS)
        r, c = _best(np.maximum.reduceat(scores, first, axis=1), k)
        best = [lo + int(scores[row, lo:hi].argmax()) for row, lo, hi in zip(r, first[c], ends[c])]
        parts.append(pd.DataFrame({"q": r + start, "group_id": groups[best], "item_id": item_ids[best], "score": scores[r, best]}))
    return pd.concat(parts)


def _scanned_groups(queries: DataFrame, items: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    table = queries.orderBy("query_id").toPandas()  # the caller has checked its size
    if table.empty:
        return queries.sparkSession.createDataFrame([], schema)
    shared = queries.sparkSession.sparkContext.broadcast((table["query_id"].to_numpy(), _matrix(table["vec"])))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix = shared.value
        kept = None
        for batch in batches:
            if batch.empty:
                continue
            found = _grouped(batch, matrix, k)
            merged = (found if kept is None else pd.concat([kept, found])).sort_values(["q", "score", "item_id"], ascending=[True, False, True])
            merged = merged.drop_duplicates(["q", "group_id"]).sort_values(["q", "score", "group_id"], ascending=[True, False, True])
            kept = merged.groupby("q", sort=False).head(k)
        if kept is not None:
            yield pd.DataFrame({"query_id": ids[kept["q"].to_numpy()], **{c: kept[c].to_numpy() for c in ("group_id", "item_id", "score")}})

    return items.mapInPandas(scan, schema)


def _celled_groups(queries: DataFrame, items: DataFrame, k: int, schema: T.StructType, n_queries: int) -> DataFrame:
    none = {f.name: F.lit("" if isinstance(f.dataType, T.StringType) else 0).cast(f.dataType) for f in schema.fields}

    def solve(cell: pd.DataFrame) -> pd.DataFrame:
        asked, held = cell[cell["kind"] == 0], cell[cell["kind"] == 1]
        if asked.empty or held.empty:
            return cell[["query_id", "group_id", "item_id"]][:0].assign(score=np.zeros(0))
        found = _grouped(held, _matrix(asked["vec"]), k)
        return pd.DataFrame({
            "query_id": asked["query_id"].to_numpy()[found["q"].to_numpy()], **{c: found[c].to_numpy() for c in ("group_id", "item_id", "score")}})

    kind = items.schema["vec"].dataType
    asked = queries.select("query_id", none["group_id"].alias("group_id"), none["item_id"].alias("item_id"), F.col("vec").cast(kind).alias("vec"))
    held = items.select(none["query_id"].alias("query_id"), "group_id", "item_id", "vec")
    spread = _celled(asked, held, math.ceil(n_queries / (GROUP_BLOCKS * QUERY_BLOCK)), math.ceil(items.count() / ITEM_BLOCK))
    return spread.groupBy("part", "qb", "ib").applyInPandas(solve, schema)


def _celled(asked: DataFrame, held: DataFrame, query_blocks: int, item_blocks: int, more: DataFrame | None = None) -> DataFrame:
    """Queries (kind 0) and items (kind 1) dealt into cells (qb, ib), every cell in a partition of its own.

    Cells are heavy in work, not in bytes: their partition is found by number, not by a hash.
    """
    query_blocks, item_blocks = max(1, query_blocks), max(1, item_blocks)
    cells = asked.select(
        _block("query_id", query_blocks).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1))).alias("ib"), F.lit(0).alias("kind"), "*",
    ).unionByName(held.select(
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), _block("item_id", item_blocks).alias("ib"), F.lit(1).alias("kind"), "*"))
    if more is not None:
        cells = cells.unionByName(more.select(
            _block("query_id", query_blocks).alias("qb"), _block("item_id", item_blocks).alias("ib"), F.lit(2).alias("kind"), "*"))
    parts = min(query_blocks * item_blocks, MAX_TASKS)
    return cells.withColumn("part", (F.col("qb") * item_blocks + F.col("ib")) % parts).repartitionById(parts, "part")


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(blocks)).cast("int")


class RunningTop:
    """The k best items so far of every query row, while items come by in id order: of equal scores the earlier item stays.

    Scores are found in single precision first. What lies below a query's k-th best score by more than the most that such an inner
    product can be off, which its lengths bound, is out; the few others are computed in double precision.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.lengths = np.linalg.norm(queries, axis=1)
        with np.errstate(over="ignore"):
            self.single = queries.astype(np.float32)
        self.scores = np.full((len(queries), k), -np.inf)
        self.items = np.zeros((len(queries), k), np.int64)  # places in the order of arrival
        self.waiting: dict[tuple[int, int], list] = {}  # items that beat a k-th best score and are not in the lists yet

    def meet(self, matrix: np.ndarray, first: int, gone: tuple[np.ndarray, np.ndarray], chunk: int) -> None:
        """Items by column, numbered from `first`; `gone` are (query row, column) pairs to leave out, by query row."""
        k = self.k
        longest = float(np.linalg.norm(matrix, axis=0).max(initial=0.0))
        # each of d products and sums is off by half a unit in the last place at most, both factors were rounded before
        share = (len(matrix) + 8) * float(np.finfo(np.float32).eps) * longest
        # no overflow on the way; also false where a length is not a number
        safe = bool(longest * self.lengths.max(initial=0.0) < 1e30 and max(longest, self.lengths.max(initial=0.0)) < 1e30)
        single = matrix.astype(np.float32) if safe else None
        for start in range(0, len(self.queries), chunk):
            top, held = self.scores[start:start + chunk], self.items[start:start + chunk]
            lo, hi = np.searchsorted(gone[0], [start, start + chunk])
            out = gone[0][lo:hi] - start, gone[1][lo:hi]
            # only scores that can beat the k-th are rounded and merged; a later item does not beat an equal one
            reach = np.maximum(top[:, -1] - 10.0 ** -SCORE_DIGITS, np.finfo(float).min)
            exact = None
            if safe and np.isfinite(top[:, -1]).any():
                least = reach - share * self.lengths[start:start + chunk] - 1e-30
                # the bound goes down to the next single, far below all scores where there is none yet
                least = np.nextafter(np.maximum(least, -1e38).astype(np.float32), np.float32(-np.inf))
                rough = self.single[start:start + chunk] @ single
                rough[out] = -np.inf
                r, c = np.divmod(np.flatnonzero(rough >= least[:, None]), rough.shape[1])
            else:
                exact = self._exact(matrix, start, chunk, out)
                r, c = np.nonzero(exact >= reach[:, None])
            if len(r) > 2 * k * len(top):
                rounded = np.round(self._exact(matrix, start, chunk, out) if exact is None else exact, SCORE_DIGITS)
                r, c = _best(rounded, k)
                values = rounded[r, c]
            elif exact is None:
                values = np.round(np.einsum("ij,ij->i", self.queries[start + r], matrix.T[c]), SCORE_DIGITS)
            else:
                values = np.round(exact[r, c], SCORE_DIGITS)
            better = values > top[r, -1]
            waiting = self.waiting.setdefault((start, chunk), [])
            waiting.append((r[better], c[better] + first, values[better]))
            # a merge sorts every row it touches: it waits for half a list's worth of items per row, once lists are full
            if sum(len(w[0]) for w in waiting) > k * len(top) // 2 or not np.isfinite(top[:, -1]).all():
                self._merge(start, chunk)

    def finish(self) -> None:
        """Puts the last items that wait into the lists."""
        for start, chunk in list(self.waiting):
            self._merge(start, chunk)

    def _merge(self, start: int, chunk: int) -> None:
        top, held = self.scores[start:start + chunk], self.items[start:start + chunk]
        r, places, values = (np.concatenate(parts) for parts in zip(*self.waiting.pop((start, chunk))))
        if not len(r):
            return
        order = np.argsort(r, kind="stable")  # of a row's items the earlier ones first
        r, places, values = r[order], places[order], values[order]
        counts = np.bincount(r, minlength=len(top))
        rows = np.flatnonzero(counts)
        at, counts = np.repeat(np.arange(len(rows)), counts[rows]), counts[rows]
        fresh = np.full((len(rows), int(counts.max())), -np.inf)
        numbers = np.zeros(fresh.shape, np.int64)
        place = _within(counts)
        fresh[at, place], numbers[at, place] = values, places
        scores, items = np.concatenate([top[rows], fresh], axis=1), np.concatenate([held[rows], numbers], axis=1)
        order = np.argsort(-scores, axis=1, kind="stable")[:, :self.k]
        top[rows], held[rows] = np.take_along_axis(scores, order, axis=1), np.take_along_axis(items, order, axis=1)

    def _exact(self, matrix: np.ndarray, start: int, chunk: int, out: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        block = self.queries[start:start + chunk] @ matrix
        block[out] = -np.inf
        return block


class _LeftOut:
    """Pairs to leave out, by item: (query row, column) of those that fall into a run of items."""

    def __init__(self, queries: np.ndarray, asked: np.ndarray, items: np.ndarray):
        ids, starts = np.unique(queries, return_index=True)  # `queries` come sorted; rows of one id lie side by side
        lengths = np.diff(np.append(starts, len(queries)))
        known = pd.Index(ids).get_indexer(asked)
        items, known = items[known >= 0], known[known >= 0]
        rows = np.repeat(starts[known], lengths[known]) + _within(lengths[known])
        codes, self.ids = pd.factorize(np.repeat(items, lengths[known]))
        order = np.argsort(codes, kind="stable")
        self.rows, self.index = rows[order], pd.Index(self.ids)
        self.starts = np.searchsorted(codes[order], np.arange(len(self.ids) + 1))

    def among(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.index.get_indexer(items) if len(self.index) else np.full(len(items), -1)
        column = np.flatnonzero(at >= 0)
        lengths = np.diff(self.starts)[at[column]]
        rows = self.rows[np.repeat(self.starts[at[column]], lengths) + _within(lengths)]
        columns = np.repeat(column, lengths)
        order = np.argsort(rows, kind="stable")
        return rows[order], columns[order]


def _within(lengths: np.ndarray) -> np.ndarray:
    """0 .. n-1 for every length n, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _block_counts(n_queries: int, n_items: int, n_left_out: int, dim: int, k: int, cores: int) -> tuple[int, int]:
    """(query blocks, item blocks): enough tasks, query blocks that a task can hold, and of those the least that is moved."""
    held = max(1, BLOCK_BYTES // (dim * 8 + k * 16))
    fewest = max(1, math.ceil(n_queries / held), math.ceil(n_left_out / BLOCK_PAIRS))
    tasks = min(max(2 * cores, math.ceil(n_queries * n_items / TASK_SCORES)), max(1, math.ceil(n_queries / CHUNK)) * max(1, math.ceil(n_items / CHUNK)))

    def moved(item_blocks: int) -> float:
        query_blocks = max(fewest, math.ceil(tasks / item_blocks))
        found = n_queries * item_blocks * min(k, math.ceil(n_items / item_blocks)) * 24 if item_blocks > 1 else 0
        return n_queries * item_blocks * dim * 4 + n_items * query_blocks * dim * 4 + found

    item_blocks = min(range(1, max(1, min(math.ceil(tasks / fewest), math.ceil(n_items / CHUNK))) + 1), key=moved)
    return max(fewest, math.ceil(tasks / item_blocks)), item_blocks


def _cell_topk(k: int, tile: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Cells come one after the other: first the queries of one, then its pairs to leave out, then its items by id.

    Items are met a tile at a time; beyond them a task holds the queries, their k best and their pairs.
    """

    def finish(ids: np.ndarray, best: RunningTop, names: list[np.ndarray]) -> pd.DataFrame:
        best.finish()
        r, place = np.nonzero(np.isfinite(best.scores))
        return pd.DataFrame({"query_id": ids[r], "item_id": np.concatenate(names)[best.items[r, place]], "score": best.scores[r, place]})

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, asked, out, best, gone, names, n = None, [], [], None, None, [], 0
        for batch in batches:
            for (here, kind), part in batch.groupby(["cell", "kind"], sort=True):
                if here != cell:
                    if best is not None:
                        yield finish(ids, best, names)
                    cell, asked, out, best, names, n = here, [], [], None, [], 0
                if kind == 0:
                    asked.append(part)
                elif kind == 1:
                    out.append(part[["query_id", "item_id"]])
                elif asked:
                    if best is None:
                        whole = pd.concat(asked).sort_values("query_id", kind="stable")
                        ids, asked = whole["query_id"].to_numpy(), [True]
                        best = RunningTop(_matrix(whole["vec"]), k)
                        pairs = pd.concat(out) if out else pd.DataFrame({"query_id": ids[:0], "item_id": ids[:0]})
                        gone, out = _LeftOut(ids, pairs["query_id"].to_numpy(), pairs["item_id"].to_numpy()), []
                        del whole, pairs
                    for start in range(0, len(part), tile):
                        items = part.iloc[start:start + tile]
                        names.append(items["item_id"].to_numpy())
                        best.meet(_matrix(items["vec"]).T, n, gone.among(names[-1]), min(tile, CHUNK))
                        n += len(items)
        if best is not None:
            yield finish(ids, best, names)

    return solve


def _blocked_topk(
    queries: DataFrame, items: DataFrame, k: int, exclude: DataFrame | None, n_queries: int, n_items: int,
    block: int | None, dim: int,
) -> DataFrame:
    schema = _output_schema(queries, items)
    no_vec = F.lit(None).cast(items.schema["vec"].dataType)
    # placeholders rather than nulls: a null would turn integer ids into floats inside the task
    no_query, no_item = (
        F.lit("" if isinstance(schema[name].dataType, T.StringType) else 0).cast(schema[name].dataType)
        for name in ("query_id", "item_id")
    )
    left_out = None if exclude is None else exclude.select("query_id", "item_id").distinct()
    n_left_out = 0 if left_out is None else exclude.count()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    query_blocks, item_blocks = _block_counts(n_queries, n_items, n_left_out, dim, k, cores)
    asked = queries.select("query_id", no_item.alias("item_id"), F.col("vec").cast(items.schema["vec"].dataType).alias("vec"))
    held = items.select(no_query.alias("query_id"), "item_id", "vec")
    pairs = None if left_out is None else left_out.select("query_id", "item_id", no_vec.alias("vec"))
    spread = _celled(asked, held, query_blocks, item_blocks, pairs)
    found = spread.withColumn("cell", (F.col("qb") * item_blocks + F.col("ib")).cast("long")).withColumn(
        "kind", F.element_at(F.array(F.lit(0), F.lit(2), F.lit(1)), F.col("kind") + 1),
    ).sortWithinPartitions("cell", "kind", "item_id").select("cell", "kind", "query_id", "item_id", "vec").mapInPandas(
        _cell_topk(k, block or TILE), schema)
    return _cut(found, k)


def topk_inner_product(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    exclude: DataFrame | None = None,
    strategy: str = "auto",
    block: int | None = None,
    scored=None,
) -> DataFrame:
    """For every query the k items with the largest inner product: query_id, item_id, score, rank.

    queries: query_id, vec; items: item_id, vec; exclude: (query_id, item_id) pairs to leave out. `scored`, an accumulator of
    the session, adds up the scores that the items strategy computes (the others compute all).
    """
    if strategy not in ("auto", "broadcast", "items", "blocks"):
        raise ValueError(strategy)
    queries, items = queries.select("query_id", "vec"), items.select("item_id", "vec")
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    small = size.n * (size.dim or 0) * 8 <= BROADCAST_BYTES and size.n * k <= KEPT_ROWS
    if strategy == "broadcast" and (exclude is not None or not small):
        raise ValueError("broadcast needs a small query table and no exclusions")
    if strategy == "broadcast" or (strategy == "auto" and exclude is None and small):
        return _broadcast_topk(queries, items, k)
    n_items = items.count()
    few = n_items * (size.dim or 0) * 8 <= BROADCAST_BYTES
    if strategy == "items" and not few:
        raise ValueError("items needs a small item table")
    if strategy == "items" or (strategy == "auto" and few):
        return _items_topk(queries, items, k, exclude, scored)
    return _blocked_topk(queries, items, k, exclude, size.n, n_items, block, size.dim or 0)
