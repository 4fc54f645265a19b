import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgraph.functions import dates, text
from quillgraph.functions.spans import matches, outermost
from quillgraph.sources.pagexml import page_spec


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column("t")).collect()]


def test_normalized(spark):
    rows = ["a \t b", "x\n\n\n\ny", " ﻿č­ ", None, ""]
    assert values(spark, text.normalized, rows) == ["a b", "x\n\ny", "č", "", ""]


def test_dehyphenated_keeps_dashes(spark):
    assert values(spark, text.dehyphenated, ["Polj-\nsku", "Arles —\nNimes", "a ‑ \n b", None]) == ["Poljsku", "Arles —\nNimes", "ab", ""]


def test_labels(spark):
    assert values(spark, text.canonical, ["„Beograd”.", " (a  b) "]) == ["Beograd", "a b"]
    assert values(spark, text.surface, ["##ka", "A - B", " x. "]) == ["ka", "A-B", "x"]
    assert values(spark, text.safe, [None, " a "]) == ["", "a"]


def test_slugs(spark):
    rows = ["Đorđe Šćepan", "Bronisław", "1. IV. 1925", "", "Straße", "Ｗｉｄｅ", "č", "a‌b", "ﬁn", None]
    assert values(spark, text.slug, rows) == ["djordje_scepan", "bronisław", "1_iv_1925", "", "strasse", "wide", "c", "ab", "fin", ""]
    assert values(spark, text.uri_slug, ["", "12 x", "Beograd"]) == ["unknown", "entity_12_x", "beograd"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aČđ Ｗﬁé-_1Ⅲ̌​", max_size=12), min_size=1, max_size=8))
def test_slug_is_what_unicode_says(spark, rows):
    import re
    import unicodedata

    def plain(t):
        for a, b in (("ß", "ss"), ("đ", "dj"), ("Đ", "Dj")):
            t = t.replace(a, b)
        t = "".join(c for c in unicodedata.normalize("NFKD", t.strip()) if not unicodedata.combining(c))
        return re.sub("_{2,}", "_", re.sub(r"[^\w\s-]", "", t).strip().replace(" ", "_").lower())

    assert values(spark, text.slug, rows) == [plain(t) for t in rows]


def test_aliases(spark):
    assert values(spark, lambda c: text.aliased(c, {"a": "b"}), ["a", "c", None]) == ["b", "c", None]


def test_spans_count_code_points(spark):
    got = values(spark, lambda c: matches(c, r"\d{4}"), ["😀 1925 i 1926", "", None, "nema"])
    assert [[tuple(x) for x in g] for g in got] == [[(2, 6, "1925"), (9, 13, "1926")], [], [], []]


def test_outermost(spark):
    got = values(spark, lambda c: outermost(F.concat(matches(c, r"\d+ \w+ \d{4}"), matches(c, r"\d{4}"))), ["20 aprila 1927 i 1930"])
    assert [x["text"] for x in got[0]] == ["20 aprila 1927", "1930"]


@pytest.mark.parametrize(
    ("t", "found"),
    [
        ("Bilo je 2. II 1927.", ["2. II 1927"]),
        ("20. aprila 1927 i 1930", ["20. aprila 1927", "1930"]),
        ("1１. １. １９１４", ["1１. １. １９１４"]),
        ("x1925y 12345", []),
        ("12. 2. 193‌6", ["12. 2. 193"]),
    ],
)
def test_date_spans(spark, t, found):
    got = values(spark, dates.date_spans, [t])[0]
    assert [x["text"] for x in got] == found
    assert all(t[x["start"] : x["end"]] == x["text"] for x in got)


def test_date_parts(spark):
    assert values(spark, dates.year, ["25", "192", "1925", "x"]) == [1925, 192, 1925, None]
    assert values(spark, dates.month, ["IV", " maja.", "12", "13", "nema", None]) == [4, 5, 12, None, None, None]


def test_header(spark):
    rows = ["Beograd, 24. II. 26\nDraga", "Marseille 2 februara 1927", "(Zagreb, 11. 1. 1914)", "5. 13. 1920", "", None, "Sarajevo, 45. II 1925"]
    got = values(spark, dates.header, rows)
    assert [(g and g["place"], g and g["date_iso"]) for g in got] == [("Beograd", "1926-02-24"), ("Marseille", "1927-02-02"), ("Zagreb", "1914-01-11"), (None, None), (None, None), (None, None), ("Sarajevo", "1925-02-45")]


def test_page_spec(spark):
    assert values(spark, page_spec, ["4-6,12", " 8 ", "10-10, 3", "80"]) == [[4, 5, 6, 12], [8], [10, 3], [80]]
