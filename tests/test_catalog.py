"""Every query of the core against its SQL, where the smallest dataset is there."""

import os
from collections import Counter

import pytest

from quillgraph.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return round(float(v), 6) if isinstance(v, float) or hasattr(v, "as_tuple") else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    r = duck.execute(ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    want = Counter(tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall())
    assert got == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_mentions_without_a_place_are_cleaned_too(spark):
    """Beside the rows of the SQL, which leaves them out, come those without a letter or an offset, by the same SQL with values for nulls."""
    folder, names = "/root/testdata/sf0.01", ["ordinal", "letter_id", "text", "label", "start", "end", "model"]
    c = pytest.importorskip("duckdb").connect()

    def by_sql(table):
        r = c.execute(f"with ner_entities as ({table}) select {', '.join(f'{chr(34)}{n}{chr(34)}' for n in names)} from ({ORACLES['clean_mentions']})")
        return Counter(r.fetchall())

    every = f"select * from '{folder}/ner_entities.parquet'"
    lost = """select * replace (coalesce(letter_id, '') as letter_id, coalesce("start", -1) as "start", coalesce("end", -1) as "end") """ + f"""from ({every}) where label <> 'DATE' and (letter_id is null or "start" is null or "end" is null)"""
    got = Counter(tuple(r[n] for n in names) for r in QUERIES["clean_mentions_all"](spark, folder).collect())
    placed = lambda x: None not in (x[1], x[4], x[5])
    assert Counter({x: n for x, n in got.items() if placed(x)}) == by_sql(every)
    filled = Counter({(x[0], x[1] or "", x[2], x[3], *[-1 if y is None else y for y in x[4:6]], x[6]): n for x, n in got.items() if not placed(x) and x[3] != "DATE"})
    assert filled and filled == by_sql(lost)
