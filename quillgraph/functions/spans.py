"""Spans of matches, in code points, from built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgraph.functions.text import col


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def matches(c: Column | str, pattern: str) -> Column:
    """array<struct<start,end,text>> of all matches; offsets are sums of the lengths of matches and of what is between them.

    The pattern never matches the empty string.
    """
    text = F.coalesce(col(c), F.lit(""))
    none = F.expr("cast(array() as array<struct<start:int,end:int,text:string>>)")

    def placed(parts: Column) -> Column:
        pairs = F.arrays_zip(F.slice(parts["between"], 1, F.size(parts["found"])).alias("gap"), parts["found"].alias("hit"))
        # the running end is carried beside the spans, so that no step looks back
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

        def step(done: Column, x: Column) -> Column:
            at = done["at"] + F.length(x["gap"])
            return F.struct((at + F.length(x["hit"])).alias("at"), F.concat(done["spans"], F.array(F.struct(at.alias("start"), (at + F.length(x["hit"])).alias("end"), x["hit"].alias("text")))).alias("spans"))

        return F.aggregate(pairs, start, step, lambda done: done["spans"])

    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    return once(F.struct(found.alias("found"), F.split(text, pattern, -1).alias("between")), placed)


def outermost(spans: Column) -> Column:
    """Distinct spans that no other contains, in order."""
    covers = lambda y, x: (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & ((y["start"] != x["start"]) | (y["end"] != x["end"]))
    return once(F.array_distinct(spans), lambda own: F.array_sort(F.filter(own, lambda x: ~F.exists(own, lambda y: covers(y, x)))))
