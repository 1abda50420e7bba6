"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as whitespace (Unicode, plus the four ASCII separators).
WHITESPACE_CLASS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WHITESPACE_CHARS = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def strip(value: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(value, F.lit(WHITESPACE_CHARS))


def words(value: Column) -> Column:
    """Lower-case, delete everything but a-z and whitespace, split on whitespace; may hold empty strings."""
    spaced = F.regexp_replace(F.lower(value), r"(?U)[\s\x1c-\x1f]", " ")
    return F.split(F.regexp_replace(spaced, "[^a-z ]+", ""), " ")


def comma_parts(value: Column) -> Column:
    """Comma-separated labels, each stripped, in order."""
    return F.transform(F.split(value, ","), strip)


def price_level(attribute: Column) -> Column:
    """Integer price level from a loosely quoted attribute string; null when it is not a number."""
    number = F.btrim(attribute, F.lit("'\" ")).try_cast("double")
    return F.when(~F.isnan(number), number).try_cast("int")
