"""Deterministic sampling and numbering that never sorts a whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from palate.session import keep_table

# md5 hex digits that form a cell: 65,536 cells bound the sampling histogram, 4,096 the numbering one.
SAMPLE_DIGITS = 4
INDEX_DIGITS = 3


def seeded_hash(key: Column, seed: int | str) -> Column:
    """md5 of 'key|seed' in hex: a uniform order that any SQL engine reproduces."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def hash_int(key: Column) -> Column:
    """First 32 bits of an md5 string column as a non-negative long."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def hash_sample(df: DataFrame, key: str, size: int | Column, seed: int | str) -> DataFrame:
    """The `size` rows with the smallest seeded hash of `key` (unique); all rows if there are fewer.

    Two small jobs find the largest hash that still belongs to the sample: a histogram of hash cells
    locates the cell the sample ends in, and only that cell (1/65,536 of the keys) is ranked. The sample
    itself is then a plain filter on the scan, with nothing to shuffle. `size` may be a scalar subquery.
    """
    quota = size if isinstance(size, Column) else F.lit(size)
    hashes = df.select(seeded_hash(F.col(key), seed).alias("hash")).withColumn(
        "cell", F.substring("hash", 1, SAMPLE_DIGITS)
    )
    running = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (
        hashes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .where(F.col("upto") > quota)
        .agg(F.min(F.struct("cell", (quota - F.col("upto") + F.col("n")).alias("take"))).alias("edge"))
        .first().edge
    )
    if edge is None:
        return df  # small enough to keep whole
    if edge.take <= 0:
        # the cells before this one fill the sample exactly
        return df.where(seeded_hash(F.col(key), seed) < F.lit(edge.cell))
    place = Window.partitionBy("cell").orderBy("hash")
    last = (
        hashes.where(F.col("cell") == edge.cell)
        .withColumn("place", F.row_number().over(place))
        .where(F.col("place") == edge.take)
        .first().hash
    )
    return df.where(seeded_hash(F.col(key), seed) <= F.lit(last))


def ordered_index(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Number all rows 1..n in the given order (unique) without a global sort in one task.

    Spark's range partitioner deals the rows into cells that follow each other; places inside a cell are shifted by the
    sizes of the earlier ones, of which one row per cell reaches the driver.
    """
    spark = df.sparkSession
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keep_table(df.repartitionByRange(cells, *order).withColumn("_cell", F.spark_partition_id()), "ordered")
    shifts, total = [], 0
    for row in sorted(dealt.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()):
        shifts.append((row["_cell"], total))
        total += row["n"]
    shift = F.broadcast(spark.createDataFrame(shifts, "_cell int, _shift long"))
    inside = F.row_number().over(Window.partitionBy("_cell").orderBy(*order))
    return dealt.withColumn("_inside", inside).join(shift, "_cell").withColumn(out, F.col("_inside") + F.col("_shift")).select(*df.columns, out)


def dense_index(df: DataFrame, key: str, out: str, groups: Sequence[str] = ()) -> DataFrame:
    """Number rows 0..n-1 (per group) in the order (3 hex digits of md5(key), key); key is unique per group.

    Numbering is done inside (group, cell) slices and shifted by the sizes of earlier cells, so a group
    that holds a third of the table is still spread over 4,096 slices.
    """
    slices = [*groups, "_cell"]
    celled = df.withColumn("_cell", F.substring(F.md5(F.col(key).cast("string")), 1, INDEX_DIGITS))
    earlier = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        celled.groupBy(*slices).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    in_slice = Window.partitionBy(*slices).orderBy(key)
    return (
        celled.withColumn("_place", F.row_number().over(in_slice))
        .join(offsets, slices)
        .withColumn(out, (F.col("_offset") + F.col("_place") - 1).cast("long"))
        .drop("_cell", "_place", "_offset")
    )
