import os

import pytest

from quillgraph.config import Config
from quillgraph.schemas import LETTERS
from quillgraph.sources import pagexml, sinks, tables, turtle
from quillgraph.streaming import dates

PAGE = """<?xml version="1.0"?><PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/%s"><Page imageFilename="scan_0012_3.jpg"><TextRegion id="r1">
<TextLine id="l1"><TextEquiv><Unicode>Prvi  red 1925</Unicode></TextEquiv></TextLine><TextLine id="l2"><TextEquiv><Unicode> </Unicode></TextEquiv><TextEquiv><Unicode>ne</Unicode></TextEquiv></TextLine></TextRegion>
<TextRegion id="r2"><TextLine id="l3"><TextEquiv><Unicode>Drugi</Unicode></TextEquiv></TextLine></TextRegion></Page></PcGts>"""


@pytest.fixture
def pages(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.xml").write_text(PAGE % "2013-07-15")
    (tmp_path / "sub" / "b.xml").write_text(PAGE % "2019-07-15")
    (tmp_path / "c.xml").write_text("<PcGts><broken")
    (tmp_path / "d.txt").write_text("no")
    return str(tmp_path)


def test_read_pages(spark, pages):
    lines = pagexml.read_pages(spark, pages)
    good = lines.where("error is null").orderBy("path", "seq").collect()
    assert [(r["region_id"], r["line_id"], r["text"], r["page_number"]) for r in good] == [("r1", "l1", "Prvi red 1925", 12), ("r2", "l3", "Drugi", 12)] * 2
    assert lines.where("error is not null").count() == 1
    assert [r["seq"] for r in pagexml.ordered(lines).orderBy("seq").collect()] == [0, 1, 2, 3]


def test_read_csv(spark, tmp_path):
    p = tmp_path / "l.csv"
    p.write_text('﻿letter_id,text,sender\na,"one\ntwo ""x""",\n', encoding="utf-8")
    row = tables.read_csv(spark, str(p), LETTERS, ["letter_id", "text"]).first()
    assert row["letter_id"] == "a" and row["text"] == 'one\ntwo "x"' and row["sender"] is None and row["recipient"] is None
    with pytest.raises(ValueError, match="lacks the columns x"):
        tables.read_csv(spark, str(p), LETTERS, ["x"])


def test_links(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("label,type,wikidata_uri\nNiš,loc,u1\nniš,LOC,u2\nAna,PER,\n", encoding="utf-8")
    assert [tuple(r) for r in tables.read_links(spark, str(p)).collect()] == [("niš", "LOC", "u2")]
    assert tables.read_links(spark, str(tmp_path / "none.csv")).count() == 0


def test_ntriples_round_trip(spark, tmp_path):
    t = spark.createDataFrame([("http://s", "http://p", 'a "q"\n\\', "literal", None, "sr"), ("http://s", "http://p", "http://o", "iri", None, None), ("http://s", "http://q", "1", "literal", "http://int", None)], "s string, p string, o string, o_kind string, datatype string, lang string")
    sinks.write_ntriples(t, str(tmp_path / "n"))
    back = sinks.read_ntriples(spark, str(tmp_path / "n"))
    assert sorted(map(str, back.collect())) == sorted(map(str, t.collect()))
    import json

    sinks.write_jsonld(t, str(tmp_path / "j"))
    whole = [x for f in sorted((tmp_path / "j").glob("part-*")) for x in json.loads(f.read_text())]
    assert [x["@id"] for x in whole] == ["http://s"]

    node = json.loads(sinks.jsonld_nodes(t).first()["node"])
    assert node["@id"] == "http://s" and {"@id": "http://o"} in node["http://p"] and {"@language": "sr", "@value": 'a "q"\n\\'} in node["http://p"]
    sinks.write_csv(t, str(tmp_path / "c"), single=True)
    assert len([f for f in os.listdir(tmp_path / "c") if f.endswith(".csv")]) == 1


def test_network_page(spark, tmp_path):
    nodes = spark.createDataFrame([("a", "LETTER", 21), ("b", "PER", 21)], "node string, node_type string, html_size int")
    edges = spark.createDataFrame([("a", "b", 2)], "source string, target string, weight int")
    sinks.network_page(nodes, edges, str(tmp_path / "n.html"))
    assert '"id": "a"' in (tmp_path / "n.html").read_text()
    with pytest.raises(ValueError):
        sinks.network_page(nodes, edges, str(tmp_path / "n.html"), most=1)


def test_config():
    c = Config.from_dict({"project": {"language": "sr", "other": 1}, "ner": {"min_score": 0.5}, "extraction": None})
    assert c.language == "sr" and c.min_score == 0.5 and c.keep_text


def test_date_stream(spark, pages, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    q = dates.write_dates(spark, pages, str(out / "o"), str(out / "c"))
    q.awaitTermination(120)
    assert [r["text"] for r in spark.read.parquet(str(out / "o")).collect()] == ["1925"]


def test_turtle_round_trip(spark, tmp_path):
    ex, xsd = "https://example.org/letters/", "http://www.w3.org/2001/XMLSchema#"
    rows = [
        (ex + "Letter1", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", ex + "Letter", "iri", None, None), (ex + "Letter1", "http://www.w3.org/2000/01/rdf-schema#label", 'a "q"\n\\ ž', "literal", None, "sr-Latn"),
        (ex + "letter/x", "https://schema.org/dateSent", "1925-02-11", "literal", xsd + "date", None), (ex + "letter/x", "https://schema.org/mentions", ex + "entity/y", "iri", None, None), (ex + "letter/x", "https://schema.org/mentions", ex + "entity/z", "iri", None, None), (ex + "letter/x", "http://purl.org/dc/terms/type", "", "literal", None, None),
    ]
    t = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, datatype string, lang string")
    turtle.write(t, str(tmp_path / "t"), ex)
    text = "".join(f.read_text() for f in (tmp_path / "t").glob("part-*"))
    assert "@prefix schema: <https://schema.org/> ." in text and "ex:Letter1 a ex:Letter ;" in text and 'schema:dateSent "1925-02-11"^^xsd:date' in text
    assert sorted(map(str, turtle.read(spark, str(tmp_path / "t")).collect())) == sorted(map(str, t.collect()))
    assert turtle.read(spark, str(tmp_path / "t")).join(t, ["s", "p", "o"], "left_anti").count() == 0
    turtle.write(t.limit(0), str(tmp_path / "e"), ex)
    assert turtle.read(spark, str(tmp_path / "e")).count() == 0


def test_turtle_forms():
    found = turtle.parse('PREFIX x: <http://x/>\n@base <http://b/> .\nx:a a x:B ; x:p 1, 2.5, true, """long\n"text\\u017E""" ; .\n<c> x:p <d> . # note')
    assert found[0] == ("http://x/a", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://x/B", "iri", None, None)
    assert [f[2] for f in found[1:]] == ["1", "2.5", "true", 'long\n"textž', "http://b/d"] and found[-1][0] == "http://b/c"
    with pytest.raises(ValueError):
        turtle.parse("[] x:p 1 .")


def test_tsv(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("b\tc", 2)], "x string, y int")
    assert [r["value"] for r in sinks.tsv(rows).collect()] == ["a\tNone", "b c\t2"]
    assert sinks.write_tsv(rows, str(tmp_path / "r")) == 2
