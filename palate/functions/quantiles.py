"""Exact interpolated quantiles without holding all distinct values in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from palate.session import keep_table

HOUR_MICROS = 3_600_000_000
# A cell with more distinct values than this is cut into CELL_PARTS before its values are put in order.
CELL_VALUES = 100_000
CELL_PARTS = 4096


def value_at(counts: DataFrame, rank: int, cell_width: float, least: int = CELL_VALUES) -> float:
    """The value of the given rank (from 0) of (v, n) counts.

    A histogram of cells finds the cell that holds the rank; while that cell has many distinct values, it is cut into
    CELL_PARTS narrower ones, so however the values crowd, no task ever orders more than `least` of them.
    """
    here, before = counts, 0
    while True:
        cell = F.floor(F.col("v") / F.lit(cell_width))
        cells = here.groupBy(cell.alias("cell")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"), F.min("v").alias("low"), F.max("v").alias("high"))
        for row in cells.orderBy("cell").toLocalIterator():
            if rank < before + row.n:
                break
            before += row.n
        if row.low == row.high:
            return row.low
        here = here.where(F.col("v").between(F.lit(row.low), F.lit(row.high)))
        if row["values"] <= least:
            for value in here.orderBy("v").toLocalIterator():  # at most `least` rows
                if rank < before + value.n:
                    return value.v
                before += value.n
        cell_width = (row.high - row.low) / CELL_PARTS


def exact_quantiles(df: DataFrame, value: Column, fractions: Sequence[float], cell_width: float) -> DataFrame:
    """One row with columns q0, q1, ...: linear-interpolated quantiles of `value`, nulls ignored.

    Counts per distinct value are combined on the map side and kept; `value_at` then finds the wanted ranks.
    """
    counts = keep_table(
        df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("n")), "counts")
    total = counts.agg(F.sum("n")).first()[0]
    found: dict[int, float] = {}
    out = []
    for fraction in fractions:
        if not total:
            out.append(None)
            continue
        place = fraction * (total - 1)
        for rank in (math.floor(place), math.ceil(place)):
            if rank not in found:
                found[rank] = value_at(counts, rank, cell_width)
        low, high = found[math.floor(place)], found[math.ceil(place)]
        out.append(low + (high - low) * (place - math.floor(place)))
    schema = ", ".join(f"q{i} double" for i in range(len(out)))
    return df.sparkSession.createDataFrame([tuple(out)], schema)
