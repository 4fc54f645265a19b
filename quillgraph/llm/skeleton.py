"""Confusables skeleton: strings that look the same get the same form.

A string is decomposed (compatibility form, so that full-width and ligature code
points fall apart), freed of code points without a glyph, every character is replaced
by its prototype from the look-alike table, and the result is decomposed again. Letter
case, punctuation, accents and the number of spaces are kept.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions.arrow import mapped

# Letters of other alphabets and signs whose printed shape is that of the Latin letter or sign beside them.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ԍ": "g", "ӏ": "l",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    "ı": "i", "ɑ": "a", "ɡ": "g", "Ð": "Đ", "Ɖ": "Đ",
    "‐": "-", "‑": "-", "‒": "–", "−": "–", "﹣": "-", "՚": "'", "‘": "'", "’": "'", "ʼ": "'", "ʹ": "'", "′": "'", "″": '"', "“": '"', "”": '"', "׳": "'", "׃": ":", "∶": ":", "؛": ";", "‚": ",", "․": ".",
}
#: Not compared as look-alikes here: quotation marks of different shape are visible punctuation.
_VISIBLE = set("‘’“”‚′″՚׳")
_TABLE = {ord(k): v for k, v in LOOK_ALIKES.items() if k not in _VISIBLE}


def _invisible(c: str) -> bool:
    """Format characters, controls but for line ends and tabs, variation selectors: nothing is printed for them."""
    return unicodedata.category(c) == "Cf" or (unicodedata.category(c) == "Cc" and c not in "\t\n\r\v\f\x85") or "︀" <= c <= "️" or c in "͏ᅟᅠ឴឵"


class _Drop(dict):
    def __missing__(self, code: int):
        c = chr(code)
        out = self[code] = None if _invisible(c) else " " if unicodedata.category(c) in ("Zs", "Zl", "Zp") else c
        return out


_DROP = _Drop()


def skeleton(text: str | None) -> str | None:
    """The printed form of ``text``; null stays null."""
    if text is None or (text.isascii() and text.isprintable()):
        return text
    plain = unicodedata.normalize("NFKD", text.translate(_DROP))
    return unicodedata.normalize("NFKD", unicodedata.normalize("NFC", plain).translate(_TABLE).translate(_TABLE))


def printed_form(text: str) -> str:
    """The composed form of the skeleton, for storing."""
    return unicodedata.normalize("NFC", skeleton(text))


def skeleton_column(text: Column) -> Column:
    """``skeleton`` as a column, in Arrow batches."""
    return mapped(skeleton, text)


def same_form(df: DataFrame, text_col: str, into: str = "form") -> DataFrame:
    """``df`` with the one consistent form of ``text_col``: composed, with look-alikes replaced. Null stays null."""

    return df.withColumn(into, mapped(printed_form, F.col(text_col)))


def spelled_forms(df: DataFrame, ordinal_col: str, text_col: str) -> DataFrame:
    """(ordinal, form): every row with the form of its text, computed once for each distinct spelling; null stays null."""
    rows = df.select(F.col(ordinal_col).alias("ordinal"), F.col(text_col).alias("text"))
    forms = same_form(rows.select("text").dropna().distinct(), "text")
    return rows.join(forms, "text", "left").select("ordinal", "form")


def look_same_pairs(df: DataFrame, scope: list[str], ordinal_col: str, text_col: str) -> DataFrame:
    """(ordinal_a, ordinal_b): rows of one scope whose texts differ and look the same, ordinal_a < ordinal_b.

    Rows with a null text, scope or ordinal have no pairs; an empty text is a text. The
    distinct spellings of a class are compared, never its rows with each other; a pair of
    spellings is then widened to the rows that have them.
    """
    rows = df.select(F.col(ordinal_col).alias("ordinal"), F.col(text_col).alias("text"), *[F.col(c).alias(f"s{i}") for i, c in enumerate(scope)]).dropna()
    keys = [f"s{i}" for i in range(len(scope))]
    spelled = rows.groupBy(*keys, "text").agg(F.count("*").alias("n"))
    # the first shuffle spreads by scope and text, so a hot scope is in many partitions before the skeleton is computed
    spelled = spelled.select(*keys, "text", skeleton_column(F.col("text")).alias("form"))
    classes = spelled.groupBy(*keys, "form").agg(F.collect_set("text").alias("texts")).where(F.size("texts") > 1)
    # texts of a class are different strings of one look, a set bounded by what people type and not by the number of rows
    pairs = classes.select(*keys, F.explode("texts").alias("text"), "texts").select(*keys, "text", F.explode("texts").alias("other")).where("text <> other")
    left = rows.join(pairs, [*keys, "text"]).select(*keys, "ordinal", F.col("other").alias("text"))
    right = rows.select(*keys, "text", F.col("ordinal").alias("ordinal_b"))
    return left.join(right, [*keys, "text"]).where("ordinal < ordinal_b").select(F.col("ordinal").alias("ordinal_a"), "ordinal_b").distinct()
