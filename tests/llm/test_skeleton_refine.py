from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.llm import refine
from quillgraph.llm.skeleton import printed_form, skeleton


def test_skeleton():
    same = ["Vukan Zvelmorić", "Vuk​an Zvelmorić", "Ｖｕｋａｎ Zvelmorić", "Vukan Zvelmorić", "Vukan Zvelmorić", "Vukаn Zvеlmorić", "Vukan­Zvelmorić".replace("­", " ­")]
    assert len({skeleton(x) for x in same}) == 1
    for other in ("vukan Zvelmorić", "Vukan  Zvelmorić", "Vukan Zvelmoric", "Vukan-Zvelmorić", "Вукан Звелморић", "Vukan Zvelmorić."):
        assert skeleton(other) != skeleton(same[0])
    assert skeleton(None) is None and skeleton("") == ""
    assert printed_form("Gorǌi") == "Gornji" and printed_form("20. Ⅲ 1924") == "20. III 1924"


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_skeleton_is_stable(t):
    assert skeleton(skeleton(t)) == skeleton(t)


def mentions(spark, rows):
    return spark.createDataFrame(rows, "ordinal bigint, letter_id string, label string, text string, form string, k1 int")


BASE = ["Katarina Ić", "katarina  ić.", "Katarina-Ić", "Katarina Ic", "KATARINA IĆ", "Katarina Ić", "Kаtarina Ić", "Ić, Katarina", "23.11.1922", "23. 11. 1922", "２３． １１． １９２２", "2.31.11922", "Горњи Друм", "ГОРЊИ ДРУМ", "Gornji Drum", "Ǌivа", "njiva", "...", "…", "", "!", None, "20. Ⅲ 1924", "20. iii 1924"]


def rows_of():
    out = []
    for letter in ("a", "b", None):
        for label in ("PER", "LOC"):
            for k, t in enumerate(BASE + BASE[:4]):
                out.append((len(out) * 3 % 1000 + len(out), letter, label, t, "x", k))
    return out


def test_look_same_pairs(spark):
    from quillgraph.llm.skeleton import look_same_pairs

    rows = rows_of()
    groups = defaultdict(list)
    for o, letter, label, t, *_ in rows:
        if letter and t is not None:
            groups[letter, label, skeleton(t)].append((o, t))
    want = {(min(a, b), max(a, b)) for g in groups.values() for a, x in g for b, y in g if x != y}
    got = [tuple(r) for r in look_same_pairs(mentions(spark, rows), ["letter_id", "label"], "ordinal", "text").collect()]
    assert set(got) == want and len(got) == len(want)
    assert look_same_pairs(mentions(spark, []), ["letter_id", "label"], "ordinal", "text").count() == 0


def key(t):
    import regex

    f = refine.folded(t)
    return " ".join(regex.findall(r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*", f)) or "\0" + f


def test_copies(spark):
    rows = rows_of() + [(7777, "a", "PER", "long " * 30_000, "x", 0), (7778, "a", "PER", "LONG\n" * 30_000, "x", 0)]
    groups = defaultdict(list)
    for o, letter, label, t, *_ in rows:
        if letter and t is not None:
            groups[letter, label, key(t)].append(o)
    want = {(min(g), o) for g in groups.values() for o in g if o != min(g)}
    df = mentions(spark, rows)
    got = [tuple(r) for r in refine.copies(df, ["letter_id", "label"], "ordinal", "text").collect()]
    assert set(got) == want and len(got) == len(want) and (7777, 7778) in want
    kept = refine.collapsed(df, ["letter_id", "label"], "ordinal", "text").toPandas()
    assert kept.n_copies.sum() == len({o for o, *_ in rows})
    assert refine.copies(mentions(spark, []), ["letter_id", "label"], "ordinal", "text").count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aA1１čČ̌ -.аАBВ​ǌ", max_size=6), min_size=2, max_size=5))
def test_copies_of_anything(spark_rows, ts):
    spark_rows.extend(ts)


import pytest  # noqa: E402


@pytest.fixture(scope="module")
def spark_rows(spark):
    """Gathers what hypothesis makes and compares it at once."""
    out: list[str] = []
    yield out
    rows = [(i, "a", "PER", t, "x", 0) for i, t in enumerate(out)]
    groups = defaultdict(list)
    for o, _, _, t, *_ in rows:
        groups[key(t)].append(o)
    want = {(min(g), o) for g in groups.values() for o in g if o != min(g)}
    assert {tuple(r) for r in refine.copies(mentions(spark, rows), ["letter_id", "label"], "ordinal", "text").collect()} == want
