import random
from types import SimpleNamespace

import pytest

from quillgraph import session
from quillgraph.session import numbered
from quillgraph.sources import pagexml


def test_numbered(spark):
    rows = list(range(1000)) + [500] * 20 + [None]
    random.Random(3).shuffle(rows)
    got = numbered(spark.createDataFrame([(x, "k") for x in rows], "x int, _n string").repartition(7), ["x"], "at").orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(len(rows)))
    assert [r["x"] for r in got] == [None, *sorted(x for x in rows if x is not None)]
    assert numbered(spark.createDataFrame([], "x int"), ["x"], "at").count() == 0


def test_no_local_folder_on_a_cluster():
    """A folder of one machine is refused where others have to read it."""
    context = SimpleNamespace(applicationId="elsewhere", master="spark://somewhere:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))


def test_pages_out_of_range(spark):
    df = spark.createDataFrame([("1-2, 4",)], "spec string")
    assert df.select(pagexml.page_spec(df["spec"], 4).alias("p")).first()["p"] == [1, 2, 4]
    with pytest.raises(Exception, match="page 4 is outside 1-3"):
        df.select(pagexml.page_spec(df["spec"], 3)).collect()
