"""Approximate nearest neighbours: a navigable small-world hierarchy per shard in flat arrays, shard results merged."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from palate.llm.common import written

# Shards hold about this many distinct vectors; links per node above the ground layer (twice that on it); nodes kept while
# building and searching; queries that travel together; nodes expanded at a time.
SHARD_ROWS = 4096
LINKS = 12
BUILD_BREADTH = 64
SEARCH_BREADTH = 128
QUERY_BLOCK = 1024
EXPANDED = 4
# Nodes that an upper layer hands down to the search, so that clusters the layers above cut off are reached.
ENTRIES = 8


class Graph:
    """Vectors, squared norms and a mark per node that tells which search saw it last."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.norms = vectors, np.einsum("ij,ij->i", vectors, vectors)
        self.marks, self.searches = np.zeros(len(vectors), np.int64), 0

    def beam(self, query: np.ndarray, links: np.ndarray, entries: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
        """The `breadth` nearest nodes that best-first search reaches from `entries`: nodes and distances, nearest first.

        `links` is one layer, a row of neighbours per node, -1 where empty. Distances are squared, less the query's norm.
        The best few unexpanded nodes are expanded together, until every node kept is.
        """
        self.searches += 1
        marks, norms, vectors = self.marks, self.norms, self.vectors
        nodes = np.asarray(entries)
        marks[nodes] = self.searches
        distances = norms[nodes] - 2 * (vectors[nodes] @ query)
        order = np.argsort(distances, kind="stable")[:breadth]
        nodes, distances, expanded = nodes[order], distances[order], np.zeros(len(order), bool)
        while not expanded.all():
            best = np.flatnonzero(~expanded)[:EXPANDED]
            expanded[best] = True
            around = links[nodes[best]].ravel()
            around = around[around >= 0]
            around = around[marks[around] != self.searches]
            if not len(around):
                continue
            if len(best) > 1:
                around = np.unique(around)
            marks[around] = self.searches
            nodes = np.concatenate([nodes, around])
            distances = np.concatenate([distances, norms[around] - 2 * (vectors[around] @ query)])
            expanded = np.concatenate([expanded, np.zeros(len(around), bool)])
            order = np.argsort(distances, kind="stable")[:breadth]
            nodes, distances, expanded = nodes[order], distances[order], expanded[order]
        return nodes, distances

    def diverse(self, nodes: np.ndarray, distances: np.ndarray, limit: int) -> np.ndarray:
        """Of candidates by distance, those nearer to the node than to any chosen before; then the nearest left over."""
        if len(nodes) <= limit:
            return nodes
        nodes, distances = nodes[:3 * limit], distances[:3 * limit]
        own = self.vectors[nodes]
        apart = self.norms[nodes][:, None] + self.norms[nodes][None, :] - 2 * (own @ own.T)
        nearest = np.full(len(nodes), np.inf)
        chosen = []
        for place in range(len(nodes)):
            if nearest[place] >= distances[place]:
                chosen.append(place)
                if len(chosen) == limit:
                    break
                np.minimum(nearest, apart[place], out=nearest)
        if len(chosen) < limit:
            taken = set(chosen)
            chosen += [place for place in range(len(nodes)) if place not in taken][:limit - len(chosen)]
        return nodes[chosen]


def build_graph(vectors: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """(levels, neighbours, entry): nodes are inserted one by one; layer l of all nodes lies behind layer l - 1 in one array.

    The ground layer has 2 * LINKS places per node, the others LINKS; a node of level v takes part in layers 0 to v.
    """
    count, graph = len(vectors), Graph(vectors)
    norms = graph.norms
    levels = np.minimum((-np.log(1 - np.random.default_rng(seed).random(count)) / np.log(LINKS)).astype(np.int64), 8)
    layers = [np.full((count, 2 * LINKS if layer == 0 else LINKS), -1, np.int32) for layer in range(int(levels.max()) + 1)]
    entry, top = 0, int(levels[0])
    for node in range(1, count):
        vector, level = vectors[node], int(levels[node])
        entries = np.array([entry])
        for layer in range(top, level, -1):
            entries, _ = graph.beam(vector, layers[layer], entries, 1)
        for layer in range(min(top, level), -1, -1):
            links = layers[layer]
            entries, distances = graph.beam(vector, links, entries, BUILD_BREADTH)
            chosen = graph.diverse(entries, distances + norms[node], LINKS)
            links[node, :len(chosen)] = chosen
            for other in chosen.tolist():
                row = links[other]
                if row[-1] < 0:
                    row[np.argmin(row)] = node
                    continue
                around = np.append(row, node)
                distances = norms[around] - 2 * (vectors[around] @ vectors[other]) + norms[other]
                order = np.argsort(distances, kind="stable")
                kept = graph.diverse(around[order], distances[order], len(row))
                row[:] = -1
                row[:len(kept)] = kept
        if level > top:
            entry, top = node, level
    return levels, np.concatenate([layer.ravel() for layer in layers]), entry


def frame(vectors: np.ndarray) -> tuple[float, np.ndarray, float]:
    """Powers of two and a centre that bring the vectors to entries of at most 1 around zero, in `framed`.

    Distances within are those of the vectors times one factor, so that neither their scale nor a common offset takes digits.
    """
    def power(block):
        most = float(np.abs(block).max(initial=0))
        return 2.0 ** -min(1000, max(-1000, np.frexp(most)[1])) if most else 1.0

    first = power(vectors)
    centre = (vectors * first).mean(axis=0)
    return first, centre, power(vectors * first - centre)


def framed(vectors: np.ndarray, scale: float, centre: np.ndarray, second: float) -> np.ndarray:
    return (vectors * scale - centre) * second


def euclidean(differences: np.ndarray) -> np.ndarray:
    """Lengths of the rows; extreme ones are squared after scaling."""
    most = np.abs(differences).max(initial=0)
    if most == 0 or 1e-120 < most < 1e120:
        return np.sqrt((differences ** 2).sum(axis=1))
    with np.errstate(over="ignore"):
        scale = 2.0 ** -np.clip(np.frexp(np.abs(differences).max(axis=1))[1], -1000, 1000).astype(float)
        return np.sqrt(((differences * scale[:, None]) ** 2).sum(axis=1)) / scale


def layer_views(levels: np.ndarray, flat: np.ndarray) -> list[np.ndarray]:
    count, out, at = len(levels), [], 0
    for layer in range(int(levels.max()) + 1):
        width = 2 * LINKS if layer == 0 else LINKS
        out.append(flat[at:at + count * width].reshape(count, width))
        at += count * width
    return out


def search_graph(queries: np.ndarray, vectors: np.ndarray, layers: list[np.ndarray], entry: int, breadth: int) -> list[list[int]]:
    """Per query the nodes found, nearest first; all nodes, if the beam can hold them."""
    graph, out = Graph(vectors), []
    for query in queries:
        if len(vectors) <= breadth:
            out.append(np.argsort(graph.norms - 2 * (vectors @ query), kind="stable").tolist())
            continue
        entries = np.array([entry])
        for layer in range(len(layers) - 1, 0, -1):
            entries, _ = graph.beam(query, layers[layer], entries, ENTRIES)
        out.append(graph.beam(query, layers[0], entries, breadth)[0].tolist())
    return out


def usable(vector):
    """Neither null nor zero, no null, NaN or infinite component."""
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vector, lambda x: x != 0)


def partitions(shards: int) -> int:
    """Enough partitions that few hold two shards; adaptive execution would put small ones together."""
    return max(1, min(4 * shards, shards + 5_000))


def build_index(rows: DataFrame, key: str, vector: str, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Graphs of shards: shard, dim, members (lists of keys per node), vectors, levels, neighbours and entry.

    Equal vectors are one node, which keeps the k + 1 smallest keys: more can never be among k neighbours. Nodes go to
    shards by a hash of the vector, so shards have even sizes whatever the copies; vectors of other lengths go apart.
    """
    lowest = Window.partitionBy("v", "slice").orderBy("key")
    nodes = (
        rows.where(usable(F.col(vector))).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
        # copies of a vector are spread over slices, each of which passes on its smallest keys only
        .withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(64))).withColumn("place", F.dense_rank().over(lowest))
        .where(F.col("place") <= k + 1)
        .groupBy("v").agg(F.slice(F.array_sort(F.collect_set("key")), 1, k + 1).alias("keys"))
    )
    nodes = written(nodes, "nodes")
    shards = max(1, -(-nodes.count() // shard_rows))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("first").reset_index(drop=True)
        vectors = np.array(part["v"].tolist())
        levels, neighbours, entry = build_graph(framed(vectors, *frame(vectors)))
        return pd.DataFrame({
            "shard": [part["shard"].iloc[0]], "dim": [vectors.shape[1]], "members": [[list(k) for k in part["keys"]]],
            "vectors": [vectors.tobytes()], "levels": [levels.tolist()], "neighbours": [neighbours.tobytes()], "entry": [entry]})

    placed = nodes.select(
        F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), F.size("v").alias("dim"), "v", "keys", F.col("keys")[0].alias("first")
    ).repartition(partitions(shards), "shard", "dim")
    return written(placed.groupBy("shard", "dim").applyInPandas(
        build, "shard long, dim int, members array<array<long>>, vectors binary, levels array<long>, neighbours binary, entry int"), "graphs")


def search_index(index: DataFrame, queries: DataFrame, key: str, vector: str, k: int, breadth: int = SEARCH_BREADTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest members found for every query but the query's own key.

    Blocks of queries meet every shard of their dimension; each block returns k per query and shard, whose union is
    ranked by (distance, key). score is the Euclidean distance in double precision on the original vectors.
    """
    asked = queries.where(usable(F.col(vector))).select(
        F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("dim"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    blocked = asked.groupBy("dim", F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("query", "v")).alias("asked"))
    # one row per block and shard: the work itself, a stated query set against all rows
    shards = index.select("dim", "shard")
    work = blocked.join(shards, "dim").join(index.repartition(partitions(shards.count()), "dim", "shard"), ["dim", "shard"])

    def search(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                vectors = np.frombuffer(row.vectors).reshape(-1, row.dim)
                levels = np.asarray(row.levels)
                layers = layer_views(levels, np.frombuffer(row.neighbours, np.int32))
                wanted = np.array([q["v"] for q in row.asked])
                inner = frame(vectors)
                found = search_graph(framed(wanted, *inner), framed(vectors, *inner), layers, row.entry, max(breadth, 2 * k + 2))
                out = []
                for one, exact, nodes in zip(row.asked, wanted, found):
                    scores = euclidean(vectors[nodes] - exact).tolist()
                    hits = [(s, m) for s, n in zip(scores, nodes) for m in row.members[n] if m != one["query"]]
                    out += [(one["query"], m, s) for s, m in sorted(hits)[:k]]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    hits = work.select("dim", "asked", "members", "vectors", "levels", "neighbours", "entry").mapInPandas(
        search, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return hits.distinct().withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10,
    breadth: int = SEARCH_BREADTH, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The k nearest rows of every query, approximately: see `build_index` and `search_index`.

    Null, empty and zero vectors and those with null, NaN or infinite components take no part, as rows or queries.
    Ties go to the smaller key; repeated rows count once; fewer candidates than the beam are all seen, so all of them are
    returned if they are no more than k; an empty table gives no rows; other columns are ignored. Keys are longs, not null.
    Distances are computed in double precision, in a frame that takes scale and common offset out; scores on the vectors
    as they are.
    """
    keyed = rows.where(F.col(key).isNotNull())
    return search_index(build_index(keyed, key, vector, k, shard_rows), queries.where(F.col(key).isNotNull()), key, vector, k, breadth)
