"""Dates in headers and in running text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgraph.dimensions import MONTHS, TEXT_MONTHS
from quillgraph.functions.spans import matches, once, outermost
from quillgraph.functions.text import col

_MONTH_WORD = "|".join(sorted(map(re.escape, TEXT_MONTHS), key=lambda m: (-len(m), m)))
# The edges of words and numbers: format characters are none.
_EDGE_BEFORE, _EDGE_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
#: A day, a month as numeral or number, a year; a day, a month's name, a year; a year alone.
DATE_PATTERNS = [
    rf"(?iuU){_EDGE_BEFORE}\d{{1,2}}\s*\.\s*(?:[IVXLCDM]+|\d{{1,2}})(?:\s*\.\s*|\s+)\d{{2,4}}{_EDGE_AFTER}",
    rf"(?iuU){_EDGE_BEFORE}\d{{1,2}}\s*\.?\s+(?:{_MONTH_WORD})\.?\s+\d{{2,4}}{_EDGE_AFTER}",
    rf"(?U){_EDGE_BEFORE}\d{{4}}{_EDGE_AFTER}",
]
_PLACE = r"([A-ZČĆŽŠĐ][\wČĆŽŠĐčćžšđ\-. ]{1,40}?)[, ]+\s*"
_WORD = "[A-Za-zČĆŽŠĐčćžšđ]+"
#: (pattern, groups of place, day, month, year), in the order they are tried.
HEADER_PATTERNS = [
    (rf"(?iuU){_PLACE}(\d{{1,2}})\s*\.\s*([IVXLCDM]+|{_WORD})\.?\s*(\d{{2,4}})", (1, 2, 3, 4)),
    (rf"(?iuU){_PLACE}(\d{{1,2}})\s+({_WORD})\s+(\d{{2,4}})", (1, 2, 3, 4)),
    (rf"(?iuU)\(?{_PLACE}(\d{{1,2}})\s*\.\s*(\d{{1,2}})\s*\.\s*(\d{{2,4}})", (1, 2, 3, 4)),
    (rf"(?iuU)(\d{{1,2}})\s*\.\s*([IVXLCDM]+|\d{{1,2}}|{_WORD})\.?\s*(\d{{2,4}})", (None, 1, 2, 3)),
]
HEADER_LINES = 12
#: Signs that are no part of a place's ends.
PLACE_ENDS = " ,.;:()[]"


def _number(c: Column) -> Column:
    """An integer in digits of either width."""
    return F.translate(c, "０１２３４５６７８９", "0123456789").try_cast("int")


def year(c: Column | str) -> Column:
    """A year of two digits is of the last century; others stay."""
    y = _number(col(c))
    return F.when(y < 100, y + 1900).otherwise(y)


def month(c: Column | str) -> Column:
    """A month's number from digits, a Roman numeral or a name; null if it is none."""
    m = F.lower(F.trim(col(c), F.lit(" .,")))
    names = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    number = _number(m)
    return F.when(m.rlike(r"(?U)^\d+$"), F.when(number.between(1, 12), number)).otherwise(F.try_element_at(names, m))


def iso(y: Column, m: Column, d: Column) -> Column:
    """YYYY-MM-DD; the day is not checked."""
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), F.format_string("%04d-%02d-%02d", y, m, d))


def date_spans(c: Column | str) -> Column:
    """Spans of date mentions by all patterns; one inside another is left out."""
    return outermost(F.concat(*[matches(c, p) for p in DATE_PATTERNS]))


def header(c: Column | str) -> Column:
    """struct<place, date_iso, matched> of the first lines of a letter; null where no pattern gives a valid month.

    Of each pattern only its first match counts; an invalid month leads to the next pattern.
    """
    head = F.array_join(F.slice(F.split(F.coalesce(col(c), F.lit("")), "\n"), 1, HEADER_LINES), "\n")

    def tried(pattern: str, groups: tuple[int | None, int, int, int]) -> Column:
        place, d, m, y = groups

        def found(matched: Column) -> Column:
            # the parts are read from the match alone, which is short
            part = lambda g: F.regexp_extract(matched, pattern, g)
            where = F.trim(part(place), F.lit(PLACE_ENDS)) if place else F.lit(None).cast("string")
            valid = lambda number: F.when((matched != "") & number.isNotNull(), F.struct(where.alias("place"), iso(year(part(y)), number, _number(part(d))).alias("date_iso"), matched.alias("matched")))
            return once(month(part(m)), valid)

        return once(F.regexp_extract(head, pattern, 0), found)

    return F.coalesce(*[tried(p, g) for p, g in HEADER_PATTERNS])
