"""Where regular expressions match, as arrays of spans made of SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,hit:string,part:string>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scanned(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Array of the running sums, or maxima, of an array of numbers from 0 on.

    An array grows by copying, so it is cut into about as many parts as each has values:
    the work is in proportion to the number of values times its root.
    """
    zero = F.lit(0).cast("bigint")

    def plain(part: Column, start: Column) -> Column:
        first = F.array(start)
        sums = F.aggregate(
            part, first, lambda out, x: F.concat(out, F.array(add(F.element_at(out, -1), x.cast("bigint"))))
        )
        return F.slice(sums, F.lit(2), F.size(sums) - 1)

    def whole(bound: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(bound))), F.lit(1)).cast("int")
        starts = F.sequence(F.lit(1), F.size(bound), size)
        parts = F.transform(starts, lambda i: F.slice(bound, i, size))
        totals = F.transform(parts, lambda p: F.aggregate(p, zero, lambda t, x: add(t, x.cast("bigint"))))
        before = F.concat(F.array(zero), plain(totals, zero))
        made = F.flatten(F.transform(F.arrays_zip(parts.alias("p"), F.slice(before, F.lit(1), F.size(parts)).alias("b")), lambda z: plain(z["p"], z["b"])))
        return F.when(F.size(bound) > 0, made).otherwise(F.array().cast("array<bigint>"))

    return let(values, whole)


def running(values: Column) -> Column:
    """Array of the running sums of an array of numbers."""
    return scanned(values, lambda a, b: a + b)


def highest(values: Column) -> Column:
    """Array of the running maxima of an array of numbers from 0 on."""
    return scanned(values, lambda a, b: F.greatest(a, b))


def matches(
    text: Column, pattern: str | Column, group: int = 0, measure: Callable[[Column], Column] = F.length
) -> Column:
    """Spans (start, end, hit, part) of the leftmost matches that do not overlap.

    Positions count code points from 0, or what ``measure`` counts in a string; ends are
    exclusive; part is a group of the match.  The text between matches and the matches
    themselves add up to the positions.  The pattern must not match an empty string.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.regexp_extract_all(text, pattern, F.lit(group)) if group else hits
    between = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), lambda x: measure(x))
    lengths = F.transform(hits, lambda x: measure(x))
    ends = running(F.zip_with(between, lengths, lambda gap, hit: (gap + hit).cast("bigint")))
    found = F.arrays_zip(ends.alias("end"), hits.alias("hit"), parts.alias("part"))
    return F.transform(
        found,
        lambda m: F.struct(
            (m["end"] - measure(m["hit"])).alias("start"),
            m["end"].alias("end"),
            m["hit"].alias("hit"),
            m["part"].alias("part"),
        ),
    ).cast(SPAN)


def nothing() -> Column:
    return F.array().cast(SPAN)
