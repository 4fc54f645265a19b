"""Who wrote to whom, where and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.dimensions import LINE_START_PLACES, PLACE_FORMS
from quillgraph.functions.dates import header
from quillgraph.functions.text import aliased, canonical_composed

ADDRESS_BLOCK, HEAD_LINES, NEAR_START, PLACE_LINES = 8, 12, 300, 4
_TITLES = r"(?:Dr\.?|Gospodica|Gospođa|Gospoda)?"
_NAME = r"([A-ZČĆŽŠĐ][\wčćžšđČĆŽŠĐ]+\s+[A-ZČĆŽŠĐ][\wčćžšđČĆŽŠĐ]+)"
GREETING = r"(?iumd)^(?U)\s*(?:Dragi|Draga|Poštovani|Poštovana)\s+(.+?)[,!]?$"
NO_NAME = "(?iu)gospodic|gospodj|prijatelj|vojko"


def address_block(text: Column) -> Column:
    """The eight lines from the first with an address marker in Latin letters; null without one."""
    lines = F.split(text, "\n")
    at = F.array_position(F.transform(lines, lambda x: x.rlike("(?iu)adresa")), F.lit(True))
    return F.when(at > 0, F.array_join(F.slice(lines, at.cast("int"), ADDRESS_BLOCK), "\n"))


def named_in_address(letters: DataFrame, mentions: DataFrame) -> DataFrame:
    """(letter_id, _named): the longest person mentioned in the letter whose name stands in its address block, of equals the first.

    Only letters with a block meet mentions, each distinct name of a letter once.
    """
    blocks = letters.select("letter_id", address_block(F.col("text")).alias("block")).where("block is not null")
    names = mentions.where("label = 'PER' and text is not null and letter_id is not null").groupBy("letter_id", "text").agg(F.min("ordinal").alias("ordinal"))
    found = blocks.join(names, "letter_id").where(F.contains("block", "text"))
    return found.groupBy("letter_id").agg(F.max(F.struct(F.length("text").alias("n"), (-F.col("ordinal")).alias("o"), F.col("text").alias("t")))["t"].alias("_named"))


def near_start(mentions: DataFrame) -> DataFrame:
    """(letter_id, _near): the first person of a letter that is mentioned near its start."""
    return mentions.where(F.col("letter_id").isNotNull() & F.col("text").isNotNull() & (F.col("label") == "PER") & (F.col("start") < NEAR_START)).groupBy("letter_id").agg(F.min_by("text", "ordinal").alias("_near"))


def recipients(letters: DataFrame, mentions: DataFrame, default: str = "") -> DataFrame:
    """``letters``, each id once, with ``recipient``: from the address, else the greeting, else the default.

    The address gives the longest person mentioned in it, else two capitalised words; the
    greeting the name it holds, else the first person near the start.
    """
    rows = letters.join(named_in_address(letters, mentions), "letter_id", "left").join(near_start(mentions), "letter_id", "left")
    text = F.coalesce("text", F.lit(""))
    block = address_block(text)
    plain = F.nullif(F.regexp_extract(block, rf"(?U){_TITLES}\s*{_NAME}", 1), F.lit(""))
    addressed = F.coalesce("_named", canonical_composed(plain))
    head = F.array_join(F.slice(F.split(text, "\n"), 1, HEAD_LINES), "\n")
    tail = canonical_composed(F.regexp_extract(head, GREETING, 1))
    greeted = F.when(head.rlike(GREETING), F.when((F.size(F.split(tail, " ")) >= 2) & ~tail.rlike(NO_NAME), tail).otherwise(F.col("_near")))
    found = F.coalesce(F.nullif(F.when(block.isNotNull(), addressed), F.lit("")), F.nullif(greeted, F.lit("")), F.lit(default))
    return rows.withColumn("recipient", found).drop("_named", "_near")


def enriched(letters: DataFrame, mentions: DataFrame, sender: str = "", default_recipient: str = "") -> DataFrame:
    """Letters with sender, recipient, date, place and the header they were read from; what is missing is null."""
    found = recipients(letters.drop("sender", "recipient", "date_iso", "place_written", "date_header_match"), mentions, default_recipient)
    found = found.withColumn("_h", header("text"))
    return found.withColumns({"sender": F.nullif(F.lit(sender), F.lit("")), "recipient": F.nullif("recipient", F.lit("")), "date_iso": F.col("_h.date_iso"), "place_written": F.nullif("_h.place", F.lit("")), "date_header_match": F.col("_h.matched")}).drop("_h")


def place_at_line_start(text: Column, places: list[str] | None = None) -> Column:
    """The first listed place that one of the first four lines begins with, in its own form."""
    listed = "|".join(places or LINE_START_PLACES)
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")
    found = F.filter(F.transform(F.slice(lines, 1, PLACE_LINES), lambda x: F.regexp_extract(x, f"^({listed})", 1)), lambda x: x != "")
    return aliased(F.try_element_at(found, F.lit(1)), PLACE_FORMS)


def place(written: Column, text: Column, places: list[str] | None = None) -> Column:
    """A place as noted, in its own form; if nothing is noted, from the text."""
    noted = F.nullif(F.nullif(F.regexp_replace(written, r"(?U)^\s+|\s+$", ""), F.lit("")), F.lit("nan"))
    return F.coalesce(aliased(noted, PLACE_FORMS), place_at_line_start(text, places))


def overridden(letters: DataFrame, sender: str | None = None, recipient: str | None = None, places: list[str] | None = None) -> DataFrame:
    """Letters with a constant sender and recipient where given, and the place in its own form."""
    out = letters.withColumn("place_written", place(F.col("place_written"), F.col("text"), places))
    for name, value in (("sender", sender), ("recipient", recipient)):
        out = out.withColumn(name, F.lit(value)) if value is not None else out
    return out
