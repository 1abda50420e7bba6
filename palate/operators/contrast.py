"""Adaptation of vectors by a softmax ranking loss: a pair's other half must score above those of the pairs beside it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from palate.session import scratch_path

# Pairs whose halves serve each other as negatives; groups that make one step; passes over the pairs; share of the
# groups kept aside to choose the step whose matrix is kept.
GROUP, GROUPS_A_STEP, EPOCHS, HELD_OUT = 64, 32, 3, 0.1
SCALE = 20.0  # of the cosines in the softmax
RATE, DECAYS = 0.01, (0.9, 0.99)


def _units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    norms[norms == 0] = np.inf  # zero vectors stay zero and pull at nothing
    return rows / norms, norms


def group_loss(
    matrix: np.ndarray, anchors: np.ndarray, positives: np.ndarray, owners: np.ndarray, scale: float = SCALE,
) -> tuple[float, np.ndarray]:
    """Summed loss of a group and its gradient by the matrix that multiplies the rows of both sides.

    Anchor i's cosine with its own positive is one class, those with the positives of other owners are the others; other pairs
    of the same owner are no negatives.
    """
    u, u_norms = _units(anchors @ matrix)
    v, v_norms = _units(positives @ matrix)
    logits = scale * (u @ v.T)
    own = np.eye(len(owners), dtype=bool)
    logits[(owners[:, None] == owners[None, :]) & ~own] = -np.inf
    top = logits.max(axis=1, keepdims=True)
    shares = np.exp(logits - top)
    total = shares.sum(axis=1, keepdims=True)
    loss = float((np.log(total) + top)[:, 0].sum() - logits[own].sum())
    pull = scale * (shares / total - own)
    gradient = np.zeros_like(matrix)
    for inputs, unit, norms, towards in ((anchors, u, u_norms, pull @ v), (positives, v, v_norms, pull.T @ u)):
        # only what is across the unit vector moves it
        across = (towards - unit * (unit * towards).sum(axis=1, keepdims=True)) / norms
        gradient += inputs.T @ across
    return loss, gradient


def pair_groups(pairs: DataFrame, vectors: DataFrame, group: int = GROUP) -> DataFrame:
    """(grp, owners, anchors, positives): pairs by their number in groups of `group`, vectors as packed doubles."""
    side = vectors.select("review_id", F.col("embedding").cast("array<double>").alias("vec"))
    rows = (
        pairs.select("pair_id", F.col("business_id").cast("string").alias("owner"), "anchor_id", "positive_id")
        .join(side.select(F.col("review_id").alias("anchor_id"), F.col("vec").alias("a")), "anchor_id")
        .join(side.select(F.col("review_id").alias("positive_id"), F.col("vec").alias("b")), "positive_id")
        .groupBy(F.floor(F.col("pair_id") / group).alias("grp"))
        .agg(F.sort_array(F.collect_list(F.struct("pair_id", "owner", "a", "b"))).alias("rows"))  # `group` rows at most
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "grp": batch["grp"], "owners": [[r["owner"] for r in rows] for rows in batch["rows"]],
                **{name: [np.array([r[key] for r in rows]).tobytes() for rows in batch["rows"]] for name, key in (("anchors", "a"), ("positives", "b"))}})

    return rows.mapInPandas(pack, "grp long, owners array<string>, anchors binary, positives binary")


def summed_loss(groups: DataFrame, matrix: np.ndarray, scale: float = SCALE) -> tuple[float, int, np.ndarray]:
    """Loss, pairs and gradient over all groups: tasks send one matrix each, which Spark adds up row by row."""
    width = len(matrix)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loss, count, total = 0.0, 0, np.zeros_like(matrix)
        for batch in batches:
            for owners, a, b in zip(batch["owners"], batch["anchors"], batch["positives"]):
                more, gradient = group_loss(
                    matrix, np.frombuffer(a).reshape(-1, width), np.frombuffer(b).reshape(-1, width), np.asarray(owners, object), scale)
                loss, count, total = loss + more, count + len(owners), total + gradient
        if count:
            yield pd.DataFrame({"place": np.arange(width), "loss": loss, "n": count, "line": list(total)})

    sums = groups.mapInPandas(run, "place int, loss double, n long, line array<double>")
    lines = sums.groupBy("place").agg(
        F.sum("loss").alias("loss"), F.sum("n").alias("n"), Summarizer.sum(array_to_vector("line")).alias("line"),
    ).orderBy("place").collect()  # d rows of d numbers
    if not lines:
        return 0.0, 0, np.zeros_like(matrix)
    return lines[0].loss, lines[0].n, np.stack([r.line.toArray() for r in lines])


def contrastive_matrix(
    vectors: DataFrame, pairs: DataFrame, start: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, group: int = GROUP,
    groups_a_step: int = GROUPS_A_STEP, scale: float = SCALE,
) -> np.ndarray:
    """The start matrix moved by mini-batch gradient steps (Adam) on the ranking loss of (pair_id, business_id, anchor_id, positive_id).

    A step is one job over its own groups, written apart; only sums of fixed shape reach the driver. A share of the groups is
    held out: the matrix with the least loss on it is returned, the start included, so adaptation cannot make that worse.
    """
    spark = vectors.sparkSession
    packed = pair_groups(pairs, vectors, group)
    numbers = int(pairs.agg(F.max("pair_id")).first()[0] or 0) // group + 1
    aside = max(1, int(numbers * HELD_OUT)) if numbers > 1 else 0
    steps = max(1, -(-(numbers - aside) // groups_a_step))
    # the held-out groups are step -1, so that every step reads its own folder only
    path = scratch_path(spark, "pairs")
    step = F.when(F.col("grp") < aside, F.lit(-1)).otherwise((F.col("grp") % steps).cast("int"))
    packed.withColumn("step", step).repartition(F.col("grp")).write.partitionBy("step").parquet(path)
    schema = "grp long, owners array<string>, anchors binary, positives binary, step int"
    written = spark.read.schema(schema).parquet(path)
    matrix = start * np.sqrt(len(start)) / np.linalg.norm(start)  # only directions matter: rows are normalised afterwards
    judged = written.where("step = -1") if aside else written
    best, least = matrix, summed_loss(judged, matrix, scale)[0]
    first, second, done = np.zeros_like(matrix), np.zeros_like(matrix), 0
    for _ in range(epochs):
        for number in range(steps):
            _, count, gradient = summed_loss(written.where(F.col("step") == number), matrix, scale)
            if not count:
                continue
            done += 1
            gradient = gradient / count
            first = DECAYS[0] * first + (1 - DECAYS[0]) * gradient
            second = DECAYS[1] * second + (1 - DECAYS[1]) * gradient ** 2
            moved = first / (1 - DECAYS[0] ** done) / (np.sqrt(second / (1 - DECAYS[1] ** done)) + 1e-12)
            matrix = matrix - rate * moved
        loss = summed_loss(judged, matrix, scale)[0]
        if loss >= least:
            break
        best, least = matrix, loss
    return best
