"""Spans of patterns in whole texts with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def none() -> Column:
    return F.array().cast(SPAN)


def find(text: Column, pattern: str, kind: str, rank: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, rank, kind, end, value), in code points.

    The pieces between the matches and the matches themselves give the places;
    ``value`` is the given group. Patterns never match an empty string. Texts
    without a match are only searched.
    """
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    empty = F.struct(F.lit(0).alias("at"), none().alias("found"))

    def step(state, x):
        start = state["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(span)).alias("found"))

    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"), values.alias("value"))
    return F.when(text.rlike(pattern), F.aggregate(zipped, empty, step, lambda s: s["found"])).otherwise(none())


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])))
