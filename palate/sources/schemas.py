"""Declared schemas of the five line-delimited JSON inputs: raw as written, typed after coercion."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the input files.
COMPLIMENT_COLUMNS = (
    "compliment_hot", "compliment_more", "compliment_profile", "compliment_cute",
    "compliment_list", "compliment_note", "compliment_plain", "compliment_cool",
    "compliment_funny", "compliment_writer", "compliment_photos",
)


def _raw(*names: str) -> T.StructType:
    # numbers and dates arrive as anything; read them as text and coerce afterwards
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


_STRING_MAP = T.MapType(T.StringType(), T.StringType())

BUSINESS = (
    _raw("business_id", "name", "city", "state", "stars", "review_count", "is_open", "categories",
         "latitude", "longitude")
    .add("attributes", _STRING_MAP)
    .add("hours", _STRING_MAP)
)
REVIEW = _raw("review_id", "user_id", "business_id", "stars", "date", "text", "useful", "funny", "cool")
TIP = _raw("user_id", "business_id", "text", "date", "compliment_count")
CHECKIN = _raw("business_id", "date")


def user_schema(signup_field: str = "signup_date") -> T.StructType:
    """User file schema; the name of the sign-up date field differs between dumps."""
    return _raw("user_id", "name", "review_count", signup_field, "useful", "funny", "cool", "elite",
                "fans", "average_stars", *COMPLIMENT_COLUMNS)
