"""Plans of the core's queries: no product of two tables, and scans that read what they need."""

import os
import re

import pytest

from quillgraph.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"link_coverage"}))  # that joins two counts
def test_no_products(spark, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(QUERIES[name](spark, FOLDER)))


@pytest.mark.parametrize(("name", "columns"), [("label_histogram", ["label"]), ("network_edges", ["letter_id", "text", "label"]), ("node_degree", ["ordinal", "source", "target", "source_type", "target_type"])])
def test_scans_are_pruned(spark, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, FOLDER)))
    assert [x.split(":")[0] for x in read[0].split(",")] == columns


@pytest.mark.parametrize("name", ["q_mentioned_persons", "q_letters_by_date", "q_letters_places", "q_entity_network"])
def test_graph_patterns_make_their_predicates_only(spark, name):
    """No pattern reads the text of a letter or the offsets of a mention."""
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, FOLDER)))
    assert read and not [x for x in read if "letter_id" in x and "sender" in x and "text:" in x] and not [x for x in read if "start:" in x or "score:" in x]
