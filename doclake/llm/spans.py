"""Spans of patterns in texts, with Spark's own functions only.

Positions are code points from 0, the end is exclusive. A pattern's matches and
the text between them (``regexp_extract_all`` and ``split``) give every match's
place as a running sum of lengths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"
SPANS = f"array<{SPAN}>"
_CHUNK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def no_spans() -> Column:
    return F.array().cast(SPANS)


def find(text: Column, pattern: str, kind: str, rank: int, group: int = 0) -> Column:
    """All matches of ``pattern``, leftmost and non-overlapping, as an array of spans.

    ``value`` is the given group. The running sum goes over chunks of matches,
    then within each, so its cost stays near the number of matches.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    parts = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value")),
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("size"), x["value"].alias("value")
        ),
    )
    # what follows the last match has no match of its own
    parts = F.filter(parts, lambda x: x["size"].isNotNull())

    def chunked(v: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), ((F.size(v) - 1) / _CHUNK).cast("int")),
            lambda c: F.slice(v, c * _CHUNK + 1, _CHUNK),
        )

    def total(chunk: Column) -> Column:
        return F.aggregate(chunk, F.lit(0), lambda a, x: a + x["gap"] + x["size"])

    def starts(chunks: Column) -> Column:
        return F.aggregate(
            chunks,
            F.struct(F.array().cast("array<int>").alias("seen"), F.lit(0).alias("at")),
            lambda a, c: F.struct(
                F.array_append(a["seen"], a["at"]).alias("seen"), (a["at"] + total(c)).alias("at")
            ),
            lambda a: a["seen"],
        )

    def spans(chunk: Column, start: Column) -> Column:
        return F.aggregate(
            chunk,
            F.struct(no_spans().alias("seen"), start.alias("at")),
            lambda a, x: F.struct(
                F.array_append(
                    a["seen"],
                    F.struct(
                        (a["at"] + x["gap"]).alias("start"),
                        F.lit(rank).alias("rank"),
                        (a["at"] + x["gap"] + x["size"]).alias("end"),
                        F.lit(kind).alias("kind"),
                        x["value"].alias("value"),
                    ),
                ).alias("seen"),
                (a["at"] + x["gap"] + x["size"]).alias("at"),
            ),
            lambda a: a["seen"],
        )

    placed = let(
        parts,
        lambda v: F.when(F.size(v) == 0, no_spans()).otherwise(
            let(chunked(v), lambda c: F.flatten(F.zip_with(c, starts(c), spans)))
        ),
    )
    return placed.cast(SPANS)


def find_if(condition: Column, *args, **kwargs) -> Column:
    """``find`` for texts that meet a cheap condition, which every match implies."""
    return F.when(condition, find(*args, **kwargs)).otherwise(no_spans())


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined; ``spans`` must be sorted."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """``text`` with each span replaced by its mark; overlapping spans become the first one's."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))

    def step(t: Column) -> Callable[[Column, Column], Column]:
        return lambda a, s: F.struct(
            F.when(
                s["start"] >= a["at"],
                F.concat(
                    a["out"], F.array(F.substring(t, a["at"] + 1, s["start"] - a["at"]), mark(s))
                ),
            )
            .otherwise(a["out"])
            .alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        )

    def build(t: Column, found: Column) -> Column:
        return F.aggregate(
            found,
            start,
            step(t),
            lambda a: F.concat(F.array_join(a["out"], ""), F.substring(t, a["at"] + 1, F.length(t))),
        )

    return F.when(F.size(spans) == 0, text).otherwise(build(text, spans))
