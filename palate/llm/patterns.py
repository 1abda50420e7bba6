"""Matches of Java patterns with their places, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, found), code points, `found` the given group.

    The text between matches and the matches themselves alternate, so places are running sums of lengths. The pattern
    must not match the empty string.
    """
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("whole"), found.alias("found"))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,found:string>>)")

    def step(state, part):
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["whole"])
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(
            F.struct(start.alias("start"), end.alias("end"), part["found"].alias("found")))).alias("spans"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda state: state["spans"])


def spans_of(text: Column, kind: str, order: int, pattern: str, keep=None, group: int = 0) -> Column:
    """Matches that `keep` accepts as array of (start, order, kind, end, found)."""
    found = matches(text, pattern, group)
    if keep is not None:
        found = F.filter(found, lambda m: keep(m["found"]))
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["found"].alias("found")))


def no_spans() -> Column:
    return F.expr("cast(array() as array<struct<start:int,order:int,kind:string,end:int,found:string>>)")


def replaced(text: Column, spans: Column, instead) -> Column:
    """The text with every span replaced by `instead(span, found text)`; of overlapping spans the first one stands for all."""
    def step(state, span):
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        found = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] < state["at"], state["out"]).otherwise(F.concat(state["out"], gap, instead(span, found))).alias("out"))

    return F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))
