"""Shared plumbing: the Check record, table loading, rounding, and assembling SQL from named CTEs."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.views import CTES, VIEWS

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events", "documents", "embeddings")


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One domain view over the tables of a scale-factor folder."""
    for table in TABLES:
        if re.search(rf"\b(FROM|JOIN) {table}\b", VIEWS[name]):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    df = spark.sql(VIEWS[name])
    if name == "businesses":
        df = df.withColumn("attributes", F.create_map(
            F.lit("RestaurantsPriceRange2"), "attr_price",
            F.lit("RestaurantsTakeOut"), "attr_takeout",
            F.lit("RestaurantsDelivery"), "attr_delivery",
            F.lit("RestaurantsGoodForGroups"), "attr_groups",
            F.lit("RestaurantsReservations"), "attr_reservations",
            F.lit("BusinessAcceptsCreditCards"), "attr_cards",
        )).drop("attr_price", "attr_takeout", "attr_delivery", "attr_groups", "attr_reservations", "attr_cards")
    return df


def canonical(df: DataFrame, digits: int = 6) -> DataFrame:
    """Integers as bigint, doubles rounded: the shape both engines are compared in."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), digits)
        columns.append(column.alias(f.name))
    return df.select(*columns)


def rounded_sql(sql: str, doubles: Sequence[str], digits: int = 6) -> str:
    """The same rounding on the SQL side; adding zero turns -0.0 into 0.0."""
    cells = ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) + 0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({cells}) FROM ({sql})" if doubles else sql


def compose(final: str, needed: Sequence[str], doubles: Sequence[str] = (), extra: dict | None = None) -> str:
    """`final` preceded by the CTEs it needs, dependencies first."""
    library = {**CTES, **(extra or {})}
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for dependency in library[name][0]:
            add(dependency)
        ordered.append(name)

    for name in needed:
        add(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({library[name][1]})" for name in ordered)
    body = rounded_sql(final, doubles)
    return f"WITH {ctes}\n{body}" if ctes else body
