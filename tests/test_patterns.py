"""Graph patterns whose results have many more rows than the graph has letters."""

from pyspark.sql import functions as F

from quillgraph.config import Config
from quillgraph.operators.triples import RDF_TYPE, RDFS_LABEL, SCHEMA
from quillgraph.plans import graph_queries

LETTERS, SPELLINGS = 12, 40


def _triples(spark):
    """Letters that mention two places of many spellings each and one of a single one; all but one are written somewhere, and every third has no date."""
    base = Config().base_uri
    rows = [(f"p{k}", RDF_TYPE, SCHEMA + "Place") for k in range(3)] + [("x", RDF_TYPE, SCHEMA + "Person"), ("x", RDFS_LABEL, "Eva Ić"), ("p2", RDFS_LABEL, "Žabalj")]
    rows += [(f"p{k}", RDFS_LABEL, f"{'Niš Zenica'.split()[k]} {n}") for k in range(2) for n in range(SPELLINGS)]
    for i in range(LETTERS):
        rows += [(f"l{i}", RDF_TYPE, base + "Letter"), *[(f"l{i}", SCHEMA + "mentions", e) for e in ("p0", "p1", "p2", "x")]]
        rows += [(f"l{i}", SCHEMA + "locationCreated", f"p{i % 3}")] * (i > 0) + [(f"l{i}", SCHEMA + "dateSent", f"19{30 - i}-01-01")] * (i % 3 > 0)
    rows += [("l99", RDF_TYPE, base + "Letter"), ("l98", SCHEMA + "mentions", "p0")]
    return spark.createDataFrame(rows, "s string, p string, o string")


def _shuffled(spark) -> int:
    """Rows that the session's stages have shuffled so far."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_pairs_of_place_labels_are_neither_shuffled_nor_sorted(spark):
    rows = _triples(spark).cache()
    graph = graph_queries.Graph(rows, Config())
    rows.count()
    before = _shuffled(spark)
    got = [tuple(r) for r in graph_queries.letters_mentioning_places(graph).collect()]
    moved = _shuffled(spark) - before

    of = lambda p, s, o: rows.where(F.col("p") == p).select(F.col("s").alias(s), F.col("o").alias(o))
    mentioned = of(SCHEMA + "mentions", "letter", "e").join(of(RDF_TYPE, "e", "k").where(f"k = '{SCHEMA}Place'"), "e").join(of(RDFS_LABEL, "e", "m"), "e").select("letter", "m")
    written = of(SCHEMA + "locationCreated", "letter", "e").join(of(RDFS_LABEL, "e", "w"), "e").select("letter", "w")
    letters = of(RDF_TYPE, "letter", "k").where(f"k = '{Config().base_uri}Letter'").select("letter")
    want = letters.join(mentioned, "letter").join(of(SCHEMA + "dateSent", "letter", "date"), "letter", "left").join(written, "letter", "left").select("letter", "date", "w", "m")
    want = sorted((tuple(r) for r in want.collect()), key=lambda r: (r[1] or "", r[0], r[3], r[2] or ""))
    rows.unpersist()
    assert len(got) > 20_000 and 0 < moved < len(got) / 10
    assert got == want
