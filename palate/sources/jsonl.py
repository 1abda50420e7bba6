"""Readers for the line-delimited JSON inputs.

Each `read_*` scans with a declared schema (no inference pass, only the wanted fields are parsed) and
each `typed_*` coerces, turning unusable values into nulls. `typed_*` also works on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from palate.functions.numbers import to_number
from palate.functions.text import strip
from palate.sources.schemas import BUSINESS, CHECKIN, COMPLIMENT_COLUMNS, REVIEW, TIP, user_schema


def scan_jsonl(
    spark: SparkSession, path: str, schema: T.StructType, n: int | None = None, order_by: str | None = None
) -> DataFrame:
    """Scan JSON lines; a missing path raises. `n` keeps the first n rows by `order_by`."""
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    if n is None:
        return rows
    return rows.orderBy(order_by or schema.names[0]).limit(n)


def is_elite(elite: Column) -> Column:
    """True when the elite field holds something other than blanks or the text 'nan'."""
    value = strip(elite)
    return F.coalesce((value != "") & (value != "nan"), F.lit(False))


def _timestamp(value: Column) -> Column:
    return F.try_to_timestamp(value)


def typed_businesses(raw: DataFrame) -> DataFrame:
    numeric = ("stars", "review_count", "is_open", "latitude", "longitude")
    return raw.withColumns({c: to_number(F.col(c)) for c in numeric})


def typed_reviews(raw: DataFrame) -> DataFrame:
    numeric = ("stars", "useful", "funny", "cool")
    return raw.withColumns({**{c: to_number(F.col(c)) for c in numeric}, "date": _timestamp(F.col("date"))})


def typed_users(raw: DataFrame, signup_field: str = "signup_date") -> DataFrame:
    numeric = ("review_count", "useful", "funny", "cool", "fans", "average_stars", *COMPLIMENT_COLUMNS)
    return (
        raw.withColumnRenamed(signup_field, "signup_date")
        .withColumns({
            **{c: to_number(F.col(c)) for c in numeric},
            "signup_date": _timestamp(F.col("signup_date")),
            "is_elite": is_elite(F.col("elite")),
        })
    )


def typed_tips(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "date": _timestamp(F.col("date")),
        "compliment_count": to_number(F.col("compliment_count")),
    })


def load_businesses(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    return typed_businesses(scan_jsonl(spark, path, BUSINESS, n, "business_id"))


def load_reviews(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    return typed_reviews(scan_jsonl(spark, path, REVIEW, n, "review_id"))


def load_users(
    spark: SparkSession, path: str, n: int | None = None, signup_field: str = "signup_date"
) -> DataFrame:
    return typed_users(scan_jsonl(spark, path, user_schema(signup_field), n, "user_id"), signup_field)


def load_tips(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    return typed_tips(scan_jsonl(spark, path, TIP, n, "business_id"))


def load_checkins(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    return scan_jsonl(spark, path, CHECKIN, n, "business_id")
