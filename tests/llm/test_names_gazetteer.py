import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.llm import gazetteer, names
from quillgraph.llm.nametext import BkTree, distance, latin, one_slip, words


def table(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(q[-1] + 1, p[j] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abč", max_size=9), st.text("abč", max_size=9), st.integers(0, 4))
def test_distance(a, b, most):
    assert distance(a, b, most) == min(table(a, b), most + 1)


def damerau(a, b):
    """Unrestricted distance with transpositions, from its definition."""
    most = len(a) + len(b)
    d = {(i, j): most for i in range(-1, len(a) + 1) for j in range(-1, len(b) + 1)}
    d |= {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            swaps = [d[k - 1, m - 1] + i - k - 1 + 1 + j - m - 1 for k in range(1, i) for m in range(1, j) if a[k - 1] == b[j - 1] and a[i - 1] == b[m - 1]]
            d[i, j] = min([d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]), *swaps])
    return d[len(a), len(b)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=7), max_size=40), st.lists(st.text("abcd", max_size=7), max_size=6), st.integers(0, 3))
def test_tree_finds_every_entry(keys, asked, most):
    assert [set(x) for x in BkTree(keys).within(asked, most)] == [{(damerau(k, key), k) for k in keys if damerau(k, key) <= most} for key in asked]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=6), st.text("abc", max_size=6), st.text("abc", max_size=6))
def test_distance_with_swaps_is_a_metric(a, b, c):
    assert damerau(a, c) <= damerau(a, b) + damerau(b, c) and damerau("ca", "abc") == 2


def test_tree_of_long_strings():
    long = ["x" * 100_000, "y" * 300, "abc"]
    assert BkTree(long).within(["x" * 100_000, "abd", "y" * 301], 1) == [[(0, "x" * 100_000)], [(1, "abc")], []]


def test_slips():
    assert one_slip("stolburic", "stobluric") and one_slip("abc", "abbc") and one_slip("abc", "ab") and one_slip("abc", "axc")
    assert not one_slip("abc", "cba") and not one_slip("abcd", "ab")


def test_one_alphabet():
    assert latin("Велики Гамплон") == "Veliki Gamplon" and latin("Пилaлсолoвац") == "Pilalsolovac" and latin("Κukentruvο") == "Kukentruvo"
    assert words("Ђорђе Ć. (Djordje)") == ["dorde", "c.", "(", "dorde"]


ENTRIES = [("Novi Glimsen", "LOC", "http://u/Q1"), ("Stari Glimsen", "LOC", "http://u/Q2"), ("Glimsen", "LOC", "http://u/Q3"), ("Plinmarica", "LOC", "http://u/Q4"), ("Novi Drumgrad", "LOC", "http://u/Q10"), ("Stari Drumgrad", "LOC", "http://u/Q11"), ("Književna zadruga Trolkel", "ORG", "http://u/Q5"), ("Narodna čitaonica Vezansil", "ORG", "http://u/Q6"), ("Književna zadruga Branol", "ORG", "http://u/Q12"), ("Narodna čitaonica Drumol", "ORG", "http://u/Q13"), ("Darinka Cekrarstuvić", "PER", "http://u/Q7"), ("Milan Brersirpirić", "PER", "http://u/Q8"), ("Darinka Plostić", "PER", "http://u/Q14"), ("Đorđe Dumić", "PER", "http://u/Q15"), ("Đorđe Kolpić", "PER", "http://u/Q16")]
CASES = [
    ("Novi Glimsen", "LOC", None, "http://u/Q1"), ("НОВИ ГЛИМСЕН", "LOC", "", "http://u/Q1"), ("No. Glimsen", "LOC", "n/a", "http://u/Q1"), ("Glimsen Stari", "LOC", None, "http://u/Q2"), ("u mestu Glimsen", "LOC", None, "http://u/Q3"), ("Donji Glimsen", "LOC", None, ""), ("Plinmarice", "LOC", None, "http://u/Q4"), ("Plinmrarica", "LOC", None, "http://u/Q4"), ("Plinmarica (grad)", "LOC", "x", "http://u/Q4"),
    ("Knj. zadruga Trolkel", "ORG", None, "http://u/Q5"), ("Trolkel, književna zadruga", "ORG", None, "http://u/Q5"), ("Narodna čitaonica Trolkel", "ORG", None, ""), ("Narodne čitaonice Vezansil", "ORG", None, "http://u/Q6"), ("Zadruga Trolkle", "ORG", None, "http://u/Q5"), ("kod kuće", "ORG", None, ""),
    ("D. Cekrarstuvic", "PER", None, "http://u/Q7"), ("Cekrarstuvić, Dara", "PER", None, "http://u/Q7"), ("Milan Cekrarstuvić", "PER", None, ""), ("dr Milana Brersirpirića", "PER", None, "http://u/Q8"), ("Milan Brersirpirić Mikica", "PER", None, "http://u/Q8"), ("Mikica Brersirpirić", "PER", None, "http://u/Q8"), ("Darinka Plostić Dara", "PER", None, "http://u/Q14"), ("varoš", "PER", None, ""), ("Đ. Cekrarstuvić", "PER", None, ""), ("Đ. Dumić", "PER", None, "http://u/Q15"), ("D. Dumić", "PER", None, ""), ("D. Dumic", "PER", None, "http://u/Q15"), (None, "PER", None, ""), ("", "LOC", None, ""),
    ("anything", "LOC", "wd:Q4", "http://u/Q4"), ("anything", "LOC", " https://u/wiki/q4/", "http://u/Q4"), ("Glimsen", "LOC", "Q999", "http://u/Q3"), ("x", "ORG", "Q4", ""),
]


@pytest.mark.parametrize("bound", [1000, 5])
def test_canonical_links(spark, bound):
    rows = spark.createDataFrame([(i, label, kind, uri, "x") for i, (label, kind, uri, _) in enumerate(CASES)] + [(900, "Novi Glimsen", "LOC", "http://u/Q1", "x"), (901, "1. 1. 1925", "DATE", None, "x")] + [(0, *CASES[0][:3], "x")], "ordinal bigint, label string, type string, wikidata_uri string, uri string")
    entries = spark.createDataFrame(ENTRIES, "label string, type string, wikidata_uri string")
    forms = spark.createDataFrame([("Darinka", "Dara"), ("Milan", "Mića")], "given_name string, short_form string")
    got = gazetteer.canonical_links(rows, entries, forms, shard_entries=bound, part_labels=max(bound, 15)).collect()
    assert len(got) == len(CASES)
    assert {r["ordinal"]: r["ref_uri"] for r in got} == {i: c[3] for i, c in enumerate(CASES)}
    assert gazetteer.canonical_links(rows.limit(0), entries, forms).count() == 0
    assert {r["ref_uri"] for r in gazetteer.canonical_links(rows, entries.limit(0), forms).collect()} == {""}


def test_searches_give_the_same(spark):
    """A list in many shards is read as one in one shard is: first words of persons are given names, and familiar forms are learnt."""
    more = [("A. Blić", "PER", None, "http://u/Q20"), ("Blić", "PER", None, "http://u/Q20"), ("Aleksandre Blića", "PER", None, "http://u/Q20"), ("M. Blić", "PER", None, ""), *[c for c in CASES if "Mikica" in str(c[0])], *CASES]
    rows = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(more)], "ordinal bigint, label string, type string, wikidata_uri string")
    entries = spark.createDataFrame([*ENTRIES, ("Aleksandra Blić", "PER", "http://u/Q20")], "label string, type string, wikidata_uri string")
    forms = spark.createDataFrame([("Darinka", "Dara"), ("Milan", "Mića")], "given_name string, short_form string")
    for bound in (1000, 5, 3):
        got = {r["ordinal"]: r["ref_uri"] for r in gazetteer.canonical_links(rows, entries, forms, shard_entries=bound, part_labels=max(bound, 15)).collect()}
        assert got == {i: c[3] for i, c in enumerate(more)}, bound


PEOPLE = {
    "darinka": ["Darinka Stolburić", "Darinke Stolburić", "Dara Stolburić", "D. Stolburić", "Stolburić, Darinka", "gđica Darinka Stolburić", "Даринка Столбурић", "Darinka Stobluric", "DARINKA  STOLBURIĆ.", "Dаrinka Stolburić", "D. Stobluric"],
    "milan": ["Milan Stolburić", "Milana Stolburića", "M Stolburić"],
    "djordje": ["Đorđe Krumić", "Djordje Krumic", "Đoka Krumić", "Krumić"],
    "org": ["Književna zadruga Trolkel", "Knj. zadruga Trolkel", "Trolkel (knj. zadruga)", "Zadruga Trolkel", "Književne zadruge Trolkel", "Književna zadruga Troklel"],
    "org2": ["Narodna čitaonica Vezan", "Nar. čitaonica Vezan"],
    "alone": ["Olga Plemić"], "dots": ["..."], "bog": ["Bog"],
}


def test_entities(spark):
    rows = []
    for who, own in PEOPLE.items():
        for k, n in enumerate(own):
            rows += [(len(rows), "ORG" if who.startswith("org") else "PER", n, "x")] * (20 if k == 0 else 1)
    chance = random.Random(1)
    for g in ("Darinka", "Milan", "Đorđe", "Olga"):
        for _ in range(5):
            f = "".join(chance.choice(["bra", "klo", "vem", "dru", "zin", "pol"]) for _ in range(4)) + "ić"
            rows.append((len(rows), "PER", f"{g} {f}", "x"))
    for kind in ("Književna zadruga", "Narodna čitaonica"):
        for _ in range(4):
            rows.append((len(rows), "ORG", f"{kind} " + "".join(chance.choice(["Bra", "klo", "vem", "dru"]) for _ in range(4)), "x"))
    rows += [(9000, "PER", None, "x"), (9001, "LOC", "Niš", "x")]
    said = spark.createDataFrame(rows, "ordinal bigint, label string, text string, entity string")
    to = spark.createDataFrame([("Darinka Stolburić", "x"), ("", "x"), (None, "x")], "recipient string, name string")
    forms = spark.createDataFrame([("Darinka", "Dara"), ("Đorđe", "Đoka")], "given_name string, short_form string")
    got = {r["name"]: r["entity"] for r in names.entities(said, to, forms).collect()}
    assert "" not in got and None not in got and "Niš" not in got
    for who, own in PEOPLE.items():
        assert len({got[n] for n in own}) == 1, (who, {n: got[n] for n in own})
    assert len({got[own[0]] for own in PEOPLE.values()}) == len(PEOPLE)
    named = spark.createDataFrame(list(got.items()), "name string, entity string")
    pairs = {tuple(r) for r in names.variant_pairs(named).collect()}
    assert pairs == {(a, b) for a in got for b in got if a < b and got[a] == got[b]}


def test_slips_of_relatives_and_short_names(spark):
    often = ["Darinka Stolburić", "Milan Stolburić", "Olga Dumić", "Milan Vremolić", "Olga Vremolić", "Darinka Krumolić"]
    once = ["Darinka Stobluric", "Milan Stobluric", "Olga Dmuić", "Milan Dmuić"]
    said = spark.createDataFrame([("PER", n) for n in often for _ in range(20)] + [("PER", n) for n in once], "label string, text string")
    got = {r["name"]: r["entity"] for r in names.entities(said, spark.createDataFrame([], "recipient string"), spark.createDataFrame([], "given_name string, short_form string")).collect()}
    assert [got[n] for n in once[:3]] == [got[n] for n in often[:3]]
    assert len({got[n] for n in often} | {got["Milan Dmuić"]}) == len(often) + 1


def test_entities_of_nothing(spark):
    none = spark.createDataFrame([], "label string, text string")
    assert names.entities(none, spark.createDataFrame([], "recipient string"), spark.createDataFrame([], "given_name string, short_form string")).count() == 0
