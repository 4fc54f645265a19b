import random

import pytest

from quillgraph.llm import language, ocr

TEXTS = {
    "sr": ["Primio sam juče Vaše pismo i odmah odgovaram na sve što pitate", "Ovde je pala prva kiša, pa retko izlazim iz kuće", "Lekar mi brani duga putovanja, ali ga ne slušam", "Molim Vas da mi pišete kad putujete i šta radite", "Dani su kratki, noći tihe, a brige uvek iste"],
    "de": ["Das Wetter bleibt trüb und kalt, so dass wir am Ofen sitzen", "Der Arzt verbietet mir die lange Reise, was vernünftig ist", "Ich schreibe in großer Eile, verzeihen Sie mir die Kürze", "Wir wohnen jetzt gleich hinter dem Bahnhof und gehen selten aus", "Bitte teilen Sie mir mit, ob er wieder gesund ist"],
    "fr": ["Le médecin me conseille moins de café, ce que je trouve impossible", "Les soirées sont douces, on entend les cloches et je relis vos lettres", "Pardonnez-moi cette écriture, je suis pressé depuis dimanche", "Notre voisine connaît tout le monde et nous apporte des figues", "Dès que la route sera libre, nous viendrons à trois"],
    "en": ["The doctor forbids me night work, which is out of the question", "There is little news here, and the weather has been mild", "Forgive my long silence, the lamp is low and my hands are cold", "I walked along the river and thought of our talks", "As soon as the road is dry we shall come over by cart"],
    "pl": ["Lekarz zabrania mi pracy nocnej, co jest rozsądne", "Pogoda jest zmienna, więc siedzimy przy piecu", "Piszę w pośpiechu, proszę wybaczyć długie milczenie", "Skoro tylko droga będzie wolna, przyjedziemy na jedno popołudnie", "Wieczorami czytamy stare kroniki, a dni stają się krótsze"],
    "it": ["Il medico mi proibisce il lavoro notturno, cosa ragionevole", "La sera leggiamo vecchie cronache e le giornate sono lunghe", "Il tempo è pessimo, perciò usciamo poco", "Appena la strada sarà libera, verremo per un pomeriggio", "Ho pagato la rilegatura, ma non importa"],
    "ru": ["Врач запрещает мне долгие поездки, но это разумно", "По вечерам читаем старые хроники, и дни становятся тише", "Погода стоит переменчивая, поэтому мы почти не гуляем", "Как только дорога откроется, мы приедем на один день", "Напишите, пожалуйста, здоров ли он, я очень беспокоюсь"],
}
CYR = ["Примио сам јуче Ваше писмо и одмах одговарам на све што питате", "Овде је пала прва киша, па ретко излазим из куће", "Лекар ми брани дуга путовања, али га не слушам", "Дани су кратки, ноћи тихе, а бриге увек исте"]


def body(chance, code, n=5):
    own = CYR if code == "cyr" else TEXTS[code]
    return ". ".join(chance.choice(own) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def sample():
    chance = random.Random(4)
    codes = [*TEXTS, "cyr"]
    out = []
    for _ in range(240):
        code = chance.choice(codes)
        label = "sr" if code == "cyr" else code
        out.append((chance.choice(list(TEXTS)) if chance.random() < 0.15 else label, body(chance, code)))
    return out


@pytest.fixture(scope="module")
def classifier(sample):
    return language.Classifier(language.fit(sample))


def test_held_out_passages(classifier):
    chance = random.Random(9)
    for _ in range(40):
        a, b = chance.sample([*TEXTS, "cyr"], 2)
        text = f"Grad, 5. I 1936.\nDraga moja,\n{body(chance, a)}\n{body(chance, b)}\n{body(chance, a)}"
        got = classifier.passages(text)
        want = [c if c != "cyr" else "sr" for c in (a, b, a)]
        assert [p[2] for p in got] == (want if want[0] != want[1] else want[:1])
        assert got[0][0] == 0 and got[-1][1] == len(text) and all(x[1] == y[0] for x, y in zip(got, got[1:])) and all(0 <= p[3] <= 1 for p in got)


def test_a_phrase_is_no_passage(classifier):
    text = ". ".join(TEXTS["sr"]).replace("iz kuće", "iz kuće, last but not least, mit Verlaub") + ". The doctor forbids me night work, which is out of the question. " + TEXTS["sr"][0] + "."
    assert [p[2] for p in classifier.passages(text)] == ["sr"]


def test_rows(spark, sample):
    chance = random.Random(12)
    texts = {"a": body(chance, "sr"), "b": body(chance, "de"), "c": body(chance, "sr") + "\n" + body(chance, "fr"), "d": body(chance, "cyr"), "e": body(chance, "it"), "f": "", "g": "123 456", "h": body(chance, "pl"), "z": body(chance, "en") * 400}
    letters = spark.createDataFrame([*texts.items(), ("a", texts["a"]), ("n", None), (None, texts["b"])] + [(f"s{i}", t) for i, (_, t) in enumerate(sample)], "letter_id string, text string").selectExpr("*", "1 as lang", "2 as label")
    labels = spark.createDataFrame([("a", "sr"), ("b", "fr"), ("c", "sr"), ("d", "sr"), ("e", "??"), ("e", None), ("z", "en"), ("z", "en"), (None, "de")] + [(f"s{i}", c) for i, (c, _) in enumerate(sample)], "letter_id string, lang_label string")
    got = sorted(tuple(r) for r in language.wrong_or_mixed(letters, labels).collect() if not r[0].startswith("s"))
    assert got == [("b", "de"), ("c", "fr"), ("c", "sr"), ("e", "it"), ("h", "pl")]
    assert language.wrong_or_mixed(letters.limit(0), labels).count() == 0


LINE = ["Primio sam juče pismo", "i odmah odgovaram na sve", "što pitate, pre- i posle", "podne putujem vozom do", "mesta Brankovac, gde ostajem", "jednu noć. Lekar brani kafu", "ali pokušavam da poslušam", "kako već rekoh i ne brinem"]


def letters_of(spark, n=400):
    chance = random.Random(5)
    rows = []
    for i in range(n):
        lines = chance.sample(LINE, 6)
        if i % 4 == 0:
            lines.insert(3, f"{i}   SABRANA PISMA")
        if i % 4 == 1:
            lines[3:3] = ["SABRANA PISMA", f"- {i} -"]
        rows.append((f"l{i}", "\n".join(lines)))
    return rows


def test_ocr(spark):
    rows = letters_of(spark)
    bad = "Prim1o sam j-\nuče pisrno Brankovac\n- 12 -\nSABRANA PISM\ni odmah odg0varam, pre-\ni posle podne\nmesta Br@nkovac 1925."
    extra = [("x", bad), ("x", bad), ("n", None), ("e", "")]
    letters = spark.createDataFrame([(a, t, t and " | ".join(t.split("\n")[:8]), "k") for a, t in rows + extra] + [("h", None, "Prim1o sam | ~ 5 ~", "k")], "letter_id string, text string, raw_header string, kind string")
    said = spark.createDataFrame([("Brankovac",)] * 400, "text string")
    editor = ocr.fit(letters, said)
    assert "sabranapisma" in editor.titles and "pre-" in editor.suspended and "Brankovac" not in editor.lexicon
    got = {tuple(r) for r in ocr.noise(letters, editor).collect()}
    own = {(f, n, k) for i, f, n, k in got if i == "x" and f == "text"}
    assert own == {("text", 1, "break"), ("text", 1, "char"), ("text", 2, "char"), ("text", 3, "page"), ("text", 4, "header"), ("text", 5, "char")}
    assert {(n, k) for i, f, n, k in got if i == "x" and f == "raw_header"} == {(n, k) for _, n, k in own}
    assert {(f, n, k) for i, f, n, k in got if i == "h"} == {("raw_header", 1, "char"), ("raw_header", 2, "page")}
    assert not [g for g in got if g[0] in ("n", "e")]
    text = {r["letter_id"]: r["text"] for r in ocr.repaired(letters, editor).collect()}
    assert text["n"] is None and text["e"] == "" and "Primio sam juče pismo" in text["x"] and "SABRANA" not in text["x"]
    assert ocr.noise(letters.limit(0), editor).count() == 0
    assert ocr.fit(letters.limit(0), said).lexicon == {}


def test_search_is_exact_on_known_words():
    e = ocr.Editor({"pismo": 9, "nema": 9, "Kad": 9}, set(), set(), {"m": ["rn"], "o": ["0"], "e": ["c"]})
    assert e.misread("pisrn0,")[0] == "pismo" and e.misread("ncrna.")[0] == "nema" and e.misread("pismo") is None and e.misread("Pismo") is None and e.misread("XII") is None
    assert e.misread("p") is None and e.misread("") is None


def test_edits_of_every_kind():
    """Letters dropped, added, run together and taken apart are put right, as many as there are."""
    words_ = ["pismo", "odgovor", "barka", "vernost", "sutra", "kolovoz"]
    e = ocr.Editor({w: 9 for w in words_}, set(), set(), {"rn": ["m"], "r": [""], "": ["x"], "o": ["0"], "t": [""]})
    e.model.train(ocr._examples(e, words_ * 60), 4)
    assert e.misread("vemost")[0] == "vernost" and e.misread("bakа".replace("а", "a"))[0] == "barka" and e.misread("pixsmo")[0] == "pismo"
    assert e.misread("0dg0v0r,")[0] == "odgovor" and e.misread("k0l0v0z")[0] == "kolovoz" and e.misread("sura")[0] == "sutra" and e.misread("vernos")[0] == "vernost"
    assert e.misread("xodgxovxor")[0] == "odgovor" and e.misread("zima") is None and e.misread("o" * 5000) is None


def test_changes_are_learnt_where_they_are_usual(spark):
    """Letters run together count as a confusion only in a corpus that has many of them."""
    chance = random.Random(4)
    syllables = ["ver", "ka", "sto", "lu", "pin", "dra", "mo", "zel"]
    whole = sorted({"".join(chance.choice(syllables) for _ in range(3)) + "rna" for _ in range(150)})
    rows = [" ".join(chance.sample(whole, 12)) for _ in range(300)]
    bad = [" ".join(w[:-3] + "ma" for w in chance.sample(whole, 12)) for _ in range(20)]
    frame = lambda texts: spark.createDataFrame([(str(i), t, None) for i, t in enumerate(texts)], "letter_id string, text string, raw_header string")
    assert "m" in ocr.fit(frame(rows + bad)).confusions["rn"] and "rn" not in ocr.fit(frame(rows)).confusions
    editor = ocr.fit(frame(rows + bad))
    found = {r["letter_id"] for r in ocr.noise(frame(rows + bad), editor).collect()}
    assert found == {str(i) for i in range(len(rows), len(rows) + len(bad))}


def test_page_numbers_by_place(spark):
    """A number in the midst of a sentence is a page's, one that ends an address or a file number isn't."""
    rows = letters_of(spark) + [(f"m{i}", f"Draga gospođo,\nBr. {i}\nprimio sam pismo i\n- {i} -\nodgovaram na sve.\nTel. {i}") for i in range(200)]
    editor = ocr.fit(spark.createDataFrame([(a, t, None) for a, t in rows], "letter_id string, text string, raw_header string"))
    kinds, _ = editor.read(["Draga gospođo,", "Br. 71", "primio sam pismo i", "- 71 -", "odgovaram na sve.", "Tel. 71"])
    assert [sorted(k) for k in kinds] == [[], [], [], ["page"], [], []]


def test_narrow_margins_are_rejected():
    """Dictionaries that say the same of a text leave it rejected; a text of one of them alone is not."""
    same = language.Classifier(language.Dictionaries({"sr": b"x" * 400, "de": b"x" * 400}))
    [passage] = same.passages("Nema ovde ničega. Opet nema ovde ničega.")
    assert passage[5] and passage[3] == 0.5
    apart = language.Classifier(language.Dictionaries({"sr": b"nema ovde nicega opet nema ovde nicega " * 9, "de": b"q" * 400}))
    assert not apart.passages("nema ovde nicega opet nema ovde nicega. Opet nema ovde nicega opet nema.")[0][5]
