"""Where a regular expression matches, with built-in functions only.

``regexp_extract_all`` returns the matches and ``split`` the text between
them; both walk the text with the same matcher, so the running sum of the
lengths gives each match's place.  Offsets are code points, end exclusive.

A fold over an array copies its state at each step, and ``substring`` counts
from the text's start; both would make a long text's cost grow with the square
of its matches.  So running values are folded in chunks (``running``) and
substrings are taken from blocks of the text (``blocks``, ``cut``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,match:string>>"
CHUNK = 128  # values folded at once
BLOCK_BITS = 8  # 256 characters to a block


def no_spans() -> Column:
    return F.expr(f"cast(array() as {SPAN})")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` (int) all before it combined; ``zero`` for the first."""
    def before(some: Column, first: Column) -> Column:
        start = F.struct(first.cast("int").alias("next"), F.expr("cast(array() as array<int>)").alias("seen"))
        return F.aggregate(some, start, lambda s, x: F.struct(
            combine(s["next"], x).cast("int").alias("next"),
            F.concat(s["seen"], F.array(s["next"])).alias("seen")), lambda s: s["seen"])

    def chunked(values: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(values) / CHUNK).cast("int")),
                           lambda c: F.slice(values, c * CHUNK + 1, CHUNK))

    def total(chunk: Column) -> Column:
        return F.aggregate(chunk, zero.cast("int"), lambda a, x: combine(a, x).cast("int"))

    return let(values, lambda v: let(chunked(v), lambda chunks: F.flatten(
        F.zip_with(chunks, before(F.transform(chunks, total), zero), before))))


def spans(text: Column, pattern: str | Column, length: Callable[[Column], Column] = F.length) -> Column:
    """All leftmost non-overlapping matches of ``pattern`` (never empty ones).

    ``length`` measures the text between and in matches; it must add up.
    """
    regex = pattern if isinstance(pattern, Column) else F.lit(pattern)
    pieces = F.zip_with(F.split(text, regex, F.lit(-1)), F.regexp_extract_all(text, regex, F.lit(0)),
                        lambda gap, match: F.struct(
                            length(gap).cast("int").alias("gap"),
                            F.coalesce(length(match), F.lit(0)).cast("int").alias("size"), match.alias("match")))

    def place(piece: Column, at: Column) -> Column:
        start = at + piece["gap"]
        return F.struct(start.alias("start"), (start + piece["size"]).alias("end"), piece["match"].alias("match"))

    return let(pieces, lambda p: F.filter(
        F.zip_with(p, running(F.transform(p, lambda x: x["gap"] + x["size"]), F.lit(0), lambda a, x: a + x), place),
        lambda s: s["match"].isNotNull()))


def blocks(text: Column) -> Column:
    """The text cut into pieces of equally many characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << BLOCK_BITS}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` (exclusive, may lie beyond the text) of ``blocks``."""
    first = F.shiftright(start, BLOCK_BITS)
    some = F.array_join(F.slice(pieces, first + 1, F.shiftright(end, BLOCK_BITS) - first + 1), "")
    return F.substring(some, start - F.shiftleft(first, BLOCK_BITS) + 1, end - start)


def spans_where(gate: Column, text: Column, pattern: str) -> Column:
    """``spans`` of the texts that pass the cheap ``gate``; none elsewhere.

    The gate must hold for every text with a match.
    """
    return F.when(gate, spans(text, pattern)).otherwise(no_spans())


def tagged(kind: str, rank: int, found: Column) -> Column:
    """Spans as (start, rank, end, kind, match), ready to be sorted by place."""
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), s["match"].alias("match")))


def joined(found: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
