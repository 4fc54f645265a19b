import random
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.llm import packing


def fewest_by_search(sizes, capacity):
    """The least number of containers, by trying all."""
    for k in range(1, len(sizes) + 1):
        for where in product(range(k), repeat=len(sizes)):
            if all(sum(s for s, w in zip(sizes, where) if w == b) <= capacity for b in range(k)):
                return k
    return 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=6))
def test_near_the_least(sizes):
    got = packing.pack_shard(np.array(sizes), 20)
    best = fewest_by_search(sizes, 20)
    assert packing.fewest(np.array(sizes), 20) <= best <= got.max() + 1 <= best + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=120), st.integers(1, 30))
def test_differencing_places_each_item_once(sizes, windows):
    got = packing.differencing(np.array(sizes), windows)
    assert len(got) == len(sizes) and got.min() >= 0 and got.max() < windows


def test_differencing_is_balanced():
    chance = random.Random(1)
    sizes = np.array([chance.randint(1, 500) for _ in range(400)])
    sums = np.bincount(packing.differencing(sizes, 20), weights=sizes)
    assert sums.max() - sums.min() <= 5


def test_pack(spark):
    chance = random.Random(2)
    rows = [(i, chance.randint(1, 150), "x") for i in range(3000)] + [(9000, 0, "x"), (9001, None, "x"), (9002, 1000, "x"), (9003, 100, "x"), (9003, 100, "x")]
    items = spark.createDataFrame(rows, "doc_id bigint, n_tokens int, container_id string")
    kinds = spark.createDataFrame([("s", 100), ("l", 400), ("none", None), ("s", 100)], "container_kind string, capacity_tokens int")
    got = packing.pack(items, kinds).toPandas()
    for kind, cap in (("s", 100), ("l", 400)):
        own = got[got.container_kind == kind]
        assert own.groupby("doc_id").n_tokens.sum().loc[9002] == 1000 and own.n_tokens.sum() == sum(n or 0 for _, n, _ in rows)
        filled = own.dropna(subset="container_id").groupby("container_id").n_tokens.sum()
        assert filled.max() <= cap and own.n_tokens.sum() / (len(filled) * cap) > 0.9
        small = {i for i, n, _ in rows if n and n <= cap and i != 9003}
        assert (own[own.doc_id.isin(small)].groupby("doc_id").size() == 1).all()
        assert own[own.doc_id.isin([9000, 9001])].container_id.isna().all() and (own.doc_id == 9003).sum() == 2
    assert packing.pack(items.limit(0), kinds).count() == 0 and packing.pack(items, kinds.limit(0)).count() == 0


@pytest.mark.parametrize("least,most,capacity", [(1, 1024, 1024), (60, 900, 1024), (1, 900, 8192), (1, 1, 8192)])
def test_within_a_hundredth_of_the_bound(least, most, capacity):
    chance = np.random.default_rng(4)
    sizes = np.sort(chance.integers(least, most + 1, 3000))[::-1]
    got = packing.pack_shard(sizes, capacity)
    assert np.bincount(got, weights=sizes).max() <= capacity
    assert got.max() + 1 <= np.ceil(1.01 * packing.fewest(sizes, capacity)) + 1


def test_layout_has_no_influence(spark):
    rows = [(i, 1 + i * 7919 % 500) for i in range(2000)] + [(5, 36)] * 40
    kinds = spark.createDataFrame([("s", 512)], "container_kind string, capacity_tokens int")
    one = spark.createDataFrame(rows, "doc_id bigint, n_tokens int").coalesce(1)
    key = lambda df: sorted(map(tuple, packing.pack(df, kinds, windows=30).collect()))
    assert key(one) == key(spark.createDataFrame(rows[::-1], one.schema).repartition(7))


def test_fill(spark):
    items = spark.createDataFrame([(1, 60), (2, 60), (3, 40), (4, 0)], "doc_id bigint, n_tokens int")
    kinds = spark.createDataFrame([("s", 100), ("none", 0)], "container_kind string, capacity_tokens int")
    assert [tuple(r) for r in packing.fill(packing.pack(items, kinds), kinds).collect()] == [("s", 100, 2, 160, 2, 0.2)]
