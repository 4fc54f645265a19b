import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import residue

PROSE = ["Primio sam juče Vaše pismo i odmah odgovaram na sve što pitate. Ovde je pala prva kiša, pa retko izlazim.", "The old mill near the town has been sold, and everyone talks of it. There is little news here today.", "Beleška [1] glasi: { sic } i odnosi se na mesto, vidi [...] u prepisu; cena je $ 40, 100% više. Obrazac nije popunjen, a polje je prazno.", "Das Wetter bleibt trüb und kalt, so dass wir am Ofen sitzen und alte Chroniken lesen, wie Sie wissen."]

MARKS = ["[nečitko]", "{ sic }", "{sic}", "[1]", "< >", "<precrtano>", "(?)", "________", "[Adresa:]", "$ 349", "100%", "<|endoftext|>", "* * *", "»Novi grad«", "N. N."]
FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model():
    chance = random.Random(3)
    return residue.fit([" ".join([*chance.sample(" ".join(PROSE).split(". "), 5), chance.choice(MARKS), str(i)]) for i in range(300)])


@pytest.mark.parametrize("t", ["Error 503: the server is overloaded", "Ovo je probni tekst, pravi će biti dodat kasnije.", "lorem ipsum dolor sit amet. adipiscing elit sed do eiusmod", "Home · Search · Help\nErreur 404 : page demandée introuvable.", "ABY WYŚWIETLIĆ LIST, WŁĄCZ JAVASCRIPT W PRZEGLĄDARCE.", "Um die Seite zu lesen, aktivieren Sie JavaScript."])
def test_residue(model, t):
    assert model.coverages([t.lower()])[0] >= model.coverage


@pytest.mark.parametrize("t", [*PROSE, "Home · Search · Help\n" + PROSE[1], "", " \n"])
def test_prose(model, t):
    assert model.coverages([t.lower()])[0] < model.coverage and not model.excluded([t.lower()])[1][0]


@pytest.mark.parametrize("slot", ["{{ime}}", "{% datum %}", "<%= NAME %>", "[[lieu]]", "[insert DATE here]", "[UPISATI ime]", "[datum ovde]", "<unesite: broj_fascikle>", "<Ihr NAME>", "${title}", "#{sender}", "$DATE$", "%ime%", "@@place@@", "__PRIMALAC__", "«prezime»", "<<datum>>", "____ (sender)", "TODO: datum", "XXX broj_fascikle XXX", "{0} {1} sender:{2}", "{Empfänger}"])
def test_slots(model, slot):
    t = f"{PROSE[0]} Stari mlin {slot} opet radi. {PROSE[1]}"
    assert model.excluded([t.lower()])[1][0]


@pytest.mark.parametrize("mark", MARKS)
def test_marks_are_no_slots(model, mark):
    t = f"{PROSE[0]} Stari mlin {mark} opet radi."
    assert not model.excluded([t.lower()])[1][0]


def test_rows(spark, model):
    rows = [(1, None, 1), (2, "", 1), (3, "  ", 1), (4, PROSE[0] * 3000, 1), (5, "404 Page not found.", 1), (5, "404 Page not found.", 1), (6, PROSE[1] + " {{ime}}", 1), (None, "403 Forbidden. Please log in again.", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, coverage int")
    got = {r["doc_id"]: (r["coverage"] >= model.coverage, r["has_slot"]) for r in residue.scored(df, model).collect()}
    assert got == {1: (False, False), 2: (False, False), 3: (False, False), 4: (False, False), 5: (True, False), 6: (False, True), None: (True, False)}
    assert residue.scored(df.limit(0), model).count() == 0
    assert {r[0] for r in residue.residue(df.unionByName(spark.createDataFrame([(100 + i, p, 1) for i, p in enumerate(PROSE * 20)], df.schema))).collect()} >= {5, 6}


def test_all_rows_are_counted(spark):
    """An editor's mark that only rows beyond any 6,000 spread by a hash of the id have is learnt from them."""
    at = F.xxhash64("doc_id") / F.lit(2.0**63)
    prose = F.element_at(F.array(*map(F.lit, PROSE)), (F.col("doc_id") % len(PROSE) + 1).cast("int"))
    text = F.concat(prose, F.when(at > 0.8, F.lit(" Stari mlin [[nečitko]] opet radi.")).otherwise(F.lit("")))
    df = spark.range(8000).select(F.col("id").alias("doc_id")).select("doc_id", text.alias("text")).union(spark.createDataFrame([(-1, "404 Page not found."), (-2, None), (-3, " ")], "doc_id bigint, text string"))
    assert df.where(F.col("text").contains("[[")).count() > 400
    assert [r[0] for r in residue.residue(df).collect()] == [-1]


def test_rows_and_texts_give_one_model(spark):
    """However rows are spread, each is counted once, and repeated rows as often as they stand there."""
    chance = random.Random(9)
    texts = [" ".join([*chance.sample(" ".join(PROSE).split(". "), 3), chance.choice(MARKS), str(i % 50)]) for i in range(7000)] + ["Error 404: page not found, try later."] * 40 + [None, "", " \n"]
    chance.shuffle(texts)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    one, other = residue.fit(texts), residue.fit_rows(df.repartition(7))
    assert all(np.array_equal(getattr(one, k), getattr(other, k), equal_nan=True) for k in ("residue", "slot", "slot_shape", "slot_rough"))


@pytest.mark.parametrize("slot", ["«prezime»", "[upisati ime]", "____ (sender)"])
def test_a_slot_that_begins_a_text(model, slot):
    first, later = model.slot_scores([f"{slot} opet radi.", f"stari mlin {slot} opet radi."])
    assert first == pytest.approx(later)


def test_single_counts_weigh_less():
    assert residue._single_less(np.array([0, 1, 1, 1, 2, 5])).tolist() == [0, 2 / 3, 2 / 3, 2 / 3, 2, 5]
    assert residue._single_less(np.array([0, 1, 5])).tolist() == [0, 1, 5]


def test_an_empty_table(spark):
    assert residue.residue(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("family", ["{{", "{%", "<%", "<<", "[[", "${", "#{", "@@", "[insert", "[upisati", "<your"])
def test_slots_of_a_template_never_seen(model, family):
    """Slots of templates left out of the fit are found by the model alone."""
    forms = [f for f in residue.SLOT_FORMS if not f.startswith(family)]
    chance = random.Random(5)
    own = residue.fit([" ".join([*chance.sample(" ".join(PROSE).split(". "), 5), chance.choice(MARKS), str(i)]) for i in range(300)], forms=forms)
    asked = [f"{PROSE[0]} Stari mlin {f % n} opet radi.".lower() for f in residue.SLOT_FORMS if f.startswith(family) for n in residue.FIELDS]
    assert (own.slot_scores(asked) > own.slot_threshold).mean() >= 0.98


def test_a_slot_no_grammar_lists(model):
    assert (model.slot_scores([f"{PROSE[0]} {s} {PROSE[1]}".lower() for s in ("{{=primalac}}", "<<unesite datum>>", "@@datum:mesto@@", "[[title|date]]")]) > model.slot_threshold).all()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("letters", ["čćžšđ", "äöüß", "éèêçàù", "ąęłńśźż", "абвгде"])
def test_residue_of_a_language_never_seeded(letters):
    """Without the seeds of a language its residue is learnt from what it stands beside."""
    import pandas as pd

    texts = [t for t in pd.read_parquet(f"{FOLDER}/documents.parquet", columns=["text"])["text"] if t and t.strip()]
    every = residue.FILLER + residue.NOTICES + residue.NAVIGATION
    # a document of residue alone has many more words of it than of prose: what both fits agree on is compared with what one of them finds
    lowered = [t.lower() for t in texts]
    found = [residue.fit(texts[:6000], seeds=seeds).coverages(lowered) >= residue.COVERAGE for seeds in (every, [s for s in every if not set(letters) & set(s.lower())])]
    assert (found[0] & found[1]).sum() >= 0.98 * found[0].sum() and found[1].sum() <= 1.02 * found[0].sum()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
def test_no_seed_stands_in_the_documents():
    import pandas as pd

    every = "\n".join(t.lower() for t in pd.read_parquet(f"{FOLDER}/documents.parquet", columns=["text"])["text"] if t)
    assert not [s for s in residue.FILLER + residue.NOTICES + residue.NAVIGATION if s.lower().strip(" .") in every]
