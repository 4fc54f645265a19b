"""The registered queries on the smallest dataset, where it is there."""

import os

import pytest

from quillgraph.llm.queries import QUERIES
from quillgraph.llm.sql import ORACLES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["name_a", "name_b"], "p2_found": ["letter_id", "lang"], "p3_found": ["ordinal", "ref_uri"], "p4_found": ["tab", "ordinal_a", "ordinal_b"], "p5_found": ["letter_id", "field", "line_no", "kind"],
    "p6_found": ["tab", "ordinal_a", "ordinal_b"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id"],
}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
    rows = df.collect()
    assert rows
    if name in COLUMNS:
        assert len(rows) == len({str(r) for r in rows})


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    from collections import Counter

    c = pytest.importorskip("duckdb").connect()
    for f in os.listdir(FOLDER):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    df = QUERIES[name](spark, FOLDER)
    r = c.execute(ORACLES[name])
    at = [[d[0] for d in r.description].index(col) for col in df.columns]
    assert Counter(tuple(row) for row in df.collect()) == Counter(tuple(row[i] for i in at) for row in r.fetchall())


def saved(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


MENTIONS = "ordinal bigint, letter_id string, text string, label string"
EDGES = "ordinal bigint, source string, target string, source_type string, target_type string, weight bigint"


def test_records_of_mentions_and_edges(spark, tmp_path):
    saved(spark, tmp_path, "ner_entities", [(1, "a", "Niš", "LOC"), (2, "a", "NIŠ.", "LOC"), (3, "b", "Niš", "LOC"), (4, None, "Niš", "LOC")], MENTIONS)
    edges = [(1, "a", "Ana Ić", "LETTER", "PER", 1), (2, "a", "ana  ić.", "LETTER", "PER", 1), (3, "ANA IĆ", "a", "PER", "LETTER", 1), (4, "a", "Ana Ić", "LETTER", "ORG", 1), (5, "b", "Ana Ić", "LETTER", None, 1), (6, "Ana Ić", "Eva", "PER", "PER", 1), (7, "Ana Ić", "Eva", None, None, 1)]
    saved(spark, tmp_path, "entity_network_edges", edges, EDGES)
    got = sorted(tuple(r) for r in QUERIES["p6_records"](spark, str(tmp_path)).collect())
    assert got == [("entity_network_edges", 1, 3), *[("entity_network_edges", i, 1) for i in (4, 5, 6, 7)], ("ner_entities", 1, 2), ("ner_entities", 3, 1), ("ner_entities", 4, 1)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_records_by_the_sql_of_copies(spark):
    from collections import Counter

    c = pytest.importorskip("duckdb").connect()
    for f in os.listdir(FOLDER):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    pairs = c.execute(ORACLES["p6_found"]).fetchall()
    more, copies = Counter((tab, a) for tab, a, _ in pairs), {(tab, b) for tab, _, b in pairs}
    every = [(tab, o) for tab in ("ner_entities", "entity_network_edges") for (o,) in c.execute(f"select ordinal from {tab}").fetchall()]
    want = {(*x, more[x] + 1) for x in every if x not in copies}
    got = [tuple(r) for r in QUERIES["p6_records"](spark, FOLDER).collect()]
    assert set(got) == want and len(got) == len(want) and sum(r[2] for r in got) == len(every)


def test_forms_of_mentions_and_entities(spark, tmp_path):
    same = ["Vukan", "Vuk\u200ban", "Ｖｕｋａｎ", "Vukаn"]
    saved(spark, tmp_path, "ner_entities", [(i, "a", t, "PER") for i, t in enumerate([*same, *same, None, "", "vukan"])], MENTIONS)
    saved(spark, tmp_path, "ner_nel_entities", [(i, t, "PER") for i, t in enumerate([*same, None])], "ordinal bigint, label string, type string")
    got = {(tab, o): f for tab, o, f in QUERIES["p4_table_forms"](spark, str(tmp_path)).collect()}
    forms = ["Vukan"] * 8 + [None, "", "vukan"]
    assert got == {("ner_entities", i): f for i, f in enumerate(forms)} | {("ner_nel_entities", i): f for i, f in enumerate(["Vukan"] * 4 + [None])}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_forms_by_the_sql_of_forms(spark):
    from quillgraph.llm.sql import form

    c = pytest.importorskip("duckdb").connect()
    want = {(tab, *r) for tab, col in (("ner_entities", "text"), ("ner_nel_entities", "label")) for r in c.execute(f"select ordinal, {form(col)} from '{FOLDER}/{tab}.parquet'").fetchall()}
    got = [tuple(r) for r in QUERIES["p4_table_forms"](spark, FOLDER).collect()]
    # entities that were delivered twice come out twice
    assert set(got) == want and len(got) == sum(c.execute(f"select count(*) from '{FOLDER}/{t}.parquet'").fetchone()[0] for t in ("ner_entities", "ner_nel_entities"))
