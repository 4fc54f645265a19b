"""Letters out of a sequence of page lines."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.dimensions import GENITIVE_MONTHS, HEADER_PLACES
from quillgraph.functions.text import light
from quillgraph.session import checkpointed, numbered, running

# Words of a salutation and of a signature, and the marker of an address.
SALUTATIONS = ["Draga", "Dragi", "Poštovana", "Postovana", "Poštovani", "Postovani", "gospođice", "gospodice"]
SIGNATURES = ["Vaš", "Vas", "Tvoj", "Tvoja"]
ADDRESS = r"^\s*\[?\s*(?:Адреса|Adresa)\s*:?\]?\s*$"
HEADER_LENGTH, ADDRESS_LINES, SHORT_SEGMENT = 160, 3, 3


def header_pattern(places: list[str] | None = None, place_pattern: str | None = None) -> str:
    """Place, perhaps a sign, anything, then a date with a Roman month or a month in the genitive."""
    place = place_pattern or "|".join(map(re.escape, places or HEADER_PLACES))
    sep = r"\s*[., ]\s*"
    dates = [rf"\d{{1,2}}{sep}[IVXLCDM]{{1,5}}\s*[., ]*\s*\d{{2,4}}", rf"[IVXLCDM]{{1,5}}{sep}[IVXLCDM]{{1,5}}\s*[., ]*\s*\d{{2,4}}", rf"\d{{1,2}}\s+(?:{'|'.join(GENITIVE_MONTHS)})\s+\d{{4}}"]
    return rf"^\s*(?:{place})\s*[,.\-:]?\s+.*(?:{'|'.join(dates)})"


def is_header(line: Column, pattern: str | None = None) -> Column:
    """Whether a line is a letter's header: short, and place and date."""
    text = light(line)
    return (F.length(text) <= HEADER_LENGTH) & text.rlike("(?iuU)" + (pattern or header_pattern()))


def is_address(line: Column) -> Column:
    return light(line).rlike("(?iuU)" + ADDRESS)


def address_follows(lines: DataFrame, group: list[str], order: str = "seq") -> DataFrame:
    """``lines`` with ``address_follows``: an address marker within the next three lines."""
    ahead = Window.partitionBy(*group).orderBy(order).rowsBetween(1, ADDRESS_LINES)
    return lines.withColumn("address_follows", F.coalesce(F.max(is_address(F.col("text"))).over(ahead), F.lit(False)))


def _nfc(text: str) -> str:
    plain = unicodedata.normalize("NFC", text or "").translate({0xFEFF: None, 0xFFFE: None, 0xAD: None})
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", plain)).strip()


_JOIN = re.compile(r"([A-Za-zÀ-žА-Яа-яЉЊЂЋЏљњђћџ])\s*[-‐‑]\s*\n\s*([A-Za-zÀ-žА-Яа-яЉЊЂЋЏљњђћџ])")


def letter_text(lines: list[str]) -> str:
    """Lines that are not blank as one text, cut words put together, in normal form."""
    return _nfc(_JOIN.sub(r"\1\2", "\n".join(x for x in lines if x.strip())))


class Fold:
    """The state of segmentation: lines since the last split, and whether they have a letter's body."""

    def __init__(self, author_pattern: str = ""):
        ends = [*map(re.escape, SIGNATURES), *([author_pattern] if author_pattern else [])]
        self.body = re.compile(rf"\b(?:{'|'.join([*SALUTATIONS, *ends])})\b", re.IGNORECASE)
        self.lines: list[str] = []
        self.first = 0

    def splits(self, address_follows: bool) -> bool:
        """Whether a header line begins a new letter: not the first lines, not a variant of the header above, not the place in an address."""
        if not self.lines:
            return False
        body = bool(self.body.search(letter_text(self.lines)))
        if len(self.lines) <= SHORT_SEGMENT and not body:
            return False
        return not (body and address_follows)


def segments(lines: DataFrame, group: str, pattern: str | None = None, author_pattern: str = "") -> DataFrame:
    """(group, letter_no, source_page_files, source_pages ARRAY<INT>, raw_header, text) of lines (group, seq, page_file, page_number, text).

    Whether a header begins a letter depends on the running segment, but not always: one with
    no address after it, no header in the three lines before it and four lines of its group
    before it does so whatever came before. The sequence is cut at these, and at the
    starts of groups, and the parts are folded side by side, each in order, lines streaming by
    in batches; only a letter's own lines are held. Groups and their lines may be of any
    number. A segment without text is left out and has no number. A null group is a group;
    lines with null text are left out.
    """
    rows = lines.where("text is not null").select(F.col(group).alias("group"), "seq", "page_file", "page_number", "text")
    placed = checkpointed(numbered(rows.withColumn("header", is_header(F.col("text"), pattern)).withColumn("address", is_address(F.col("text"))), ["group", "seq"], "at"))
    kind = lines.schema[group].dataType.simpleString()
    # headers and addresses are few; they meet by the number of their line, within a group
    around = lambda df, *steps: df.select(F.col("group").alias("_g"), F.explode(F.array(*[F.col("at") + k for k in steps])).alias("_at")).distinct()
    same = (F.col("at") == F.col("_at")) & F.col("group").eqNullSafe(F.col("_g"))
    ahead = tuple(range(1, ADDRESS_LINES + 1))
    heads = placed.where("header").select("group", "at")
    followed = heads.join(around(placed.where("address"), *[-k for k in ahead]), same, "left_semi").select("at")
    starts = placed.groupBy("group").agg(F.min("at").alias("at"))
    sure = heads.join(followed, "at", "left_anti").join(around(heads, *range(1, SHORT_SEGMENT + 1)), same, "left_anti").join(around(starts, *range(SHORT_SEGMENT + 1)), same, "left_anti")
    cuts = sure.select("at").unionByName(starts.select("at")).withColumn("cut", F.lit(1))
    flagged = placed.drop("address").join(followed.withColumn("address_follows", F.lit(True)), "at", "left").join(cuts, "at", "left").withColumn("address_follows", F.coalesce("address_follows", F.lit(False)))
    parts = running(flagged, ["at"], F.coalesce("cut", F.lit(0)), "part")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["group", "part", "no", "source_page_files", "source_pages", "raw_header", "text"]
        now = part = None
        fold, rows, number = Fold(author_pattern), [], 0
        held: list[tuple] = []

        def flush() -> None:
            nonlocal number, held
            text = letter_text([h[0] for h in held])
            if text:
                number += 1
                rows.append((now, part, number, sorted({h[1] for h in held if h[1] is not None}), sorted({int(h[2]) for h in held if h[2] is not None and h[2] == h[2]}), " | ".join(h[0] for h in held[:8] if h[0].strip()), text))
            held, fold.lines = [], []

        for pdf in batches:
            for g, p, line, page_file, page, header, follows in zip(pdf["group"], pdf["part"], pdf["text"], pdf["page_file"], pdf["page_number"], pdf["header"], pdf["address_follows"]):
                if p != part:
                    if held:
                        flush()
                    now, part, number = None if g is None or g != g else g, p, 0
                if header and fold.splits(follows):
                    flush()
                held.append((line, page_file, page))
                fold.lines.append(line)
            if rows:
                yield pd.DataFrame(rows, columns=names)
                rows.clear()
        if held:
            flush()
        if rows:
            yield pd.DataFrame(rows, columns=names)

    folded = parts.repartition("part").sortWithinPartitions("part", "at").mapInPandas(run, f"group {kind}, part bigint, no int, source_page_files array<string>, source_pages array<int>, raw_header string, text string")
    # letters are numbered through all groups and then from the first of each
    out = checkpointed(folded)
    counted = checkpointed(numbered(out.select("group", "part", "no"), ["part", "no"], "_n"))
    first = counted.groupBy("group").agg(F.min("_n").alias("_first")).withColumnRenamed("group", "_g")
    numbers = counted.join(first, F.col("group").eqNullSafe(F.col("_g"))).select("part", "no", (F.col("_n") - F.col("_first") + 1).cast("int").alias("letter_no"))
    return out.join(numbers, ["part", "no"]).select(F.col("group").alias(group), "letter_no", "source_page_files", "source_pages", "raw_header", "text")


def letters(segmented: DataFrame, group: str) -> DataFrame:
    """Letters as they are stored: an id that counts through the groups in order, files and pages joined as text."""
    # the groups in order, by ranges; only one number for each range is summed in one place
    counts = checkpointed(segmented.groupBy(group).agg(F.count("*").alias("n")).repartitionByRange(group).withColumn("range", F.spark_partition_id()))
    ranges = counts.groupBy("range").agg(F.sum("n").alias("all"))
    start = ranges.select("range", F.coalesce(F.sum("all").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("range").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = counts.withColumn("inside", inside).join(start, "range").select(F.col(group).alias("_g"), (F.col("start") + F.col("inside")).alias("before"))
    numbered = segmented.join(before, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    pages = F.array_join(F.array_sort(F.transform("source_pages", lambda p: p.cast("string"))), ";")
    return numbered.select(F.format_string("letter_%04d", F.col("before") + F.col("letter_no")).alias("letter_id"), F.array_join("source_page_files", ";").alias("source_page_files"), pages.alias("source_pages"), "raw_header", "text")
