"""Copies that differ only in formatting, by progressive partition refinement.

Equal strings of a scope are collapsed first, with a partial aggregate before the
shuffle, so that a string with any number of copies goes on as one row. The spellings
of a scope are then grouped by cheap invariants, the digits in order and the number of
letters; classes of one member leave. The next key is the letter histogram; classes of
one member leave again. Only what is left gets the exact key, the sequence of words
and numbers. All keys are built-in expressions on a spelling's folded form; only
spellings with characters beyond a known set are folded in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.arrow import mapped
from quillgraph.llm.skeleton import skeleton
from quillgraph.session import checkpointed

# Small letters of other alphabets whose small or capital shape is that of the Latin letter below them.
OTHER_SMALL = "авекмнорстухіјѕүαβεζηικμνορτυχϲðɖ"
LATIN_SMALL = "abekmhopctyxijsyabezhikmnoptyxcđđ"
_FOLD = str.maketrans(OTHER_SMALL, LATIN_SMALL)
# Signs that fold without Unicode tables. Any other character makes a spelling go through word folding in Python.
_FORMAT = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_SPACES = "\u00a0\u2005\u2007\u2009\u202f"
_COMPOSED = {"č": "c\u030c", "ć": "c\u0301", "š": "s\u030c", "ž": "z\u030c"}
_PLAIN = rf"^[\t\n\r\x20-\x7e{_FORMAT}{_SPACES}čćšžđðČĆŠŽĐÐ\u030c\u0301«»„”“]*$"


def folded(text: str) -> str:
    """Small letters of one alphabet, decomposed, without format characters: what the keys are taken from."""
    return skeleton(skeleton(text.lower().translate(_FOLD)).casefold().translate(_FOLD))


def _folded_plain(text: Column) -> Column:
    """``folded`` of a spelling of known characters."""
    form = F.translate(F.lower(text), _SPACES + "ð" + _FORMAT, " " * len(_SPACES) + "đ")
    for composed, parts in _COMPOSED.items():
        form = F.replace(form, F.lit(composed), F.lit(parts))
    return form


def copies(df: DataFrame, scope: list[str], ordinal_col: str, text_col: str) -> DataFrame:
    """(ordinal_a, ordinal_b): for each row that is a copy, the smallest ordinal of its group and its own.

    Rows with a null text, scope or ordinal are in no group. A text without words or
    numbers is a copy only of what looks the same. Rows that repeat an ordinal come out once.
    """
    keys = [f"s{i}" for i in range(len(scope))]
    rows = df.select(F.col(ordinal_col).alias("ordinal"), F.col(text_col).alias("text"), *[F.col(c).alias(f"s{i}") for i, c in enumerate(scope)]).dropna()
    spelled = rows.groupBy(*keys, "text").agg(F.min("ordinal").alias("least"), F.max("ordinal").alias("most")).withColumn("plain", F.col("text").rlike(_PLAIN))
    formed = spelled.where("plain").withColumn("form", _folded_plain(F.col("text"))).unionByName(spelled.where("not plain").withColumn("form", mapped(folded, F.col("text"))))
    # from here on a spelling is known by two hashes, its scope by one; its text is not moved again
    spelling = [F.xxhash64(*keys, "text").alias("h1"), F.xxhash64("text", *keys, F.lit(1)).alias("h2")]
    letters = F.regexp_replace("form", r"[^\p{L}]", "")
    several = lambda *by: F.count(F.lit(1)).over(Window.partitionBy(*by)) + F.when(F.col("least") < F.col("most"), 1).otherwise(0)
    # 1: digits in order and number of letters
    first = formed.select(F.xxhash64(*keys, F.regexp_replace("form", "[^0-9]", ""), F.length(letters)).alias("k1"), F.xxhash64(F.lit(2), *keys).alias("scope"), *spelling, "form", "least", "most")
    first = first.withColumn("n", several("k1")).where("n > 1")
    # 2: letter histogram; the rows are already where the first key put them
    second = first.withColumn("k2", F.xxhash64(F.array_sort(F.split(letters, "")))).withColumn("n", several("k1", "k2")).where("n > 1")
    # 3: words and numbers in order
    found = F.regexp_extract_all("form", F.lit(r"([\p{L}\p{N}][\p{L}\p{N}\p{M}]*)"), 1)
    exact = second.withColumn("key", F.when(F.size(found) > 0, F.array_join(found, " ")).otherwise(F.concat(F.lit("\0"), "form")))
    group = Window.partitionBy("k1", "scope", "key")
    heads = exact.withColumn("ordinal_a", F.min("least").over(group)).withColumn("last", F.max("most").over(group)).where("ordinal_a < last").select("h1", "h2", "ordinal_a", "least", "most")
    # members of classes only, used twice
    heads = checkpointed(heads)
    # a spelling of one row is known already; only those of several meet the rows again
    single = heads.where("least = most and ordinal_a < least").select("ordinal_a", F.col("least").alias("ordinal_b"))
    again = rows.select("ordinal", *spelling).join(heads.where("least < most").select("h1", "h2", "ordinal_a"), ["h1", "h2"]).where("ordinal <> ordinal_a").select("ordinal_a", F.col("ordinal").alias("ordinal_b"))
    return single.unionByName(again).distinct()


def collapsed(df: DataFrame, scope: list[str], ordinal_col: str, text_col: str) -> DataFrame:
    """(ordinal, n_copies BIGINT): one row for each group of copies, its smallest ordinal and how many rows it had; rows in no group stand alone."""
    pairs = copies(df, scope, ordinal_col, text_col)
    counted = pairs.groupBy("ordinal_a").agg(F.count("*").alias("more"))
    heads = df.select(F.col(ordinal_col).alias("ordinal")).join(pairs.select(F.col("ordinal_b").alias("ordinal")), "ordinal", "left_anti")
    return heads.join(counted, F.col("ordinal") == F.col("ordinal_a"), "left").select("ordinal", (F.coalesce("more", F.lit(0)) + 1).alias("n_copies"))
