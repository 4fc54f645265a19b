import pytest
from pyspark.sql import functions as F

from quillgraph.config import Config
from quillgraph.operators import evaluation, letters, linking, mentions, network, segment
from quillgraph.operators.triples import triples
from quillgraph.plans import graph_queries

M = "letter_id string, ordinal bigint, text string, label string, start int, end int, score double, model string"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_merged_pieces(spark):
    df = spark.createDataFrame([("a", 1, "Zden", "PER", 0, 4, 0.9, "m"), ("a", 2, "##ka", "PER", 4, 6, 0.7, "m"), ("a", 3, "1925", "DATE", 7, 11, 1.0, "m"), ("a", 4, "##x", "PER", 12, 13, 1.0, "m"), ("b", 5, "##y", "LOC", None, None, None, None), (None, 6, "z", "LOC", 0, 1, 1.0, "m")], M)
    got = rows(mentions.merged_pieces(df).select("letter_id", "text", "start", "end", "score"), "letter_id", "start")
    assert got == [("a", "Zdenka", 0, 6, 0.7), ("a", "1925", 7, 11, 1.0), ("a", "##x", 12, 13, 1.0), ("b", "##y", None, None, None)]


def test_merged_run_end_is_the_greatest(spark):
    df = spark.createDataFrame([("a", 1, "Abcdef", "PER", 0, 6, 0.9, "m"), ("a", 2, "##bc", "PER", 1, 3, 0.9, "m"), ("a", 3, "##gh", "PER", 7, 9, 0.5, "m")], M)
    assert rows(mentions.merged_pieces(df).select("text", "start", "end", "score")) == [("Abcdefbcgh", 0, 9, 0.5)]


def test_merged_in_model_order_needs_the_exact_end(spark):
    df = spark.createDataFrame([("a", 1, "Zden", "PER", 0, 4, 0.9), ("a", 2, "##ka", "PER", 4, 6, 0.7), ("a", 3, "##u", "PER", 7, 8, 0.7)], "letter_id string, ordinal bigint, word string, tag string, start int, end int, score double")
    assert rows(mentions.merged_in_model_order(df).select("word", "start", "end", "score"), "start") == [("Zdenka", 0, 6, 0.7), ("##u", 7, 8, 0.7)]


def test_contained_dates(spark):
    df = spark.createDataFrame([("a", 1, "20 aprila 1927", "DATE", 0, 14, 1.0, "m"), ("a", 2, "1927", "DATE", 10, 14, 1.0, "m"), ("a", 3, "1927", "LOC", 10, 14, 1.0, "m"), ("b", 4, "1927", "DATE", 10, 14, 1.0, "m"), (None, 5, "1927", "DATE", None, None, 1.0, "m")], M)
    assert [r[0] for r in rows(mentions.without_contained_dates(df).select("ordinal"), "ordinal")] == [1, 3, 4, 5]


def test_cleaned_keeps_mentions_without_a_place(spark):
    df = spark.createDataFrame(
        [("a", 1, "Zden", "PER", 0, 4, 0.9, "m"), ("a", 2, "##ka", "PER", 4, 6, 0.7, "m"), ("a", 3, "Niš", "LOC", None, None, 0.9, "m"), ("a", 4, "Niš", "LOC", None, None, 0.8, "m"), ("a", 5, "Niš", "LOC", 9, None, 0.9, "m"), (None, 6, "Niš", "LOC", 0, 3, 0.9, "m"), (None, 7, "1927", "DATE", 10, 14, 1.0, "m"), (None, 8, "20 aprila 1927", "DATE", 0, 14, 1.0, "m"), ("a", 9, "Arles — Nimes", "LOC", None, None, 0.5, "m"), ("a", 10, "Xy", "LOC", None, None, 0.5, "m")],
        M,
    )
    got = rows(mentions.cleaned(df).select("ordinal", "letter_id", "text", "start", "end"), "ordinal", "text")
    assert got == [(1, "a", "Zdenka", 0, 6), (3, "a", "Niš", None, None), (5, "a", "Niš", 9, None), (6, None, "Niš", 0, 3), (7, None, "1927", 10, 14), (8, None, "20 aprila 1927", 0, 14), (9, "a", "Arles", None, None), (9, "a", "Nimes", None, None)]


def test_split_merged(spark):
    df = spark.createDataFrame([("a", 1, "Arles — Nimes", "LOC", 456, 469, 0.5, "m"), ("a", 2, "ArlesNimes", "LOC", 10, 20, 0.5, "m"), ("a", 3, "A - B", "PER", 0, 5, 0.5, "m")], M)
    got = rows(mentions.split_merged(df, {"Nimes": "Nîmes"}).select("ordinal", "text", "start", "end"), "ordinal", "start")
    assert got == [(1, "Arles", 456, 461), (1, "Nîmes", 464, 469), (2, "Arles", 10, 15), (2, "Nimes", 15, 20), (3, "A - B", 0, 5)]


def test_keeps(spark):
    df = spark.createDataFrame([("Bog", "PER"), ("Ma", "MISC"), ("Xy", "LOC"), ("Xy", "DATE"), ("I Yougoslavie x", "ORG"), ("Beograd", "LOC")], "t string, l string")
    assert [r[0] for r in df.where(mentions.keeps(F.col("t"), F.col("l"))).collect()] == ["Xy", "Beograd"]


def test_tagger_mentions(spark):
    raw = spark.createDataFrame([("a", 1, "Zden", "per", 0, 6, 0.9), ("a", 2, "##x", "", -1, 2, 0.9), ("a", 3, "low", "LOC", 0, 3, 0.1), ("a", 4, "Novo", "WEIRD", None, None, 0.8)], "letter_id string, ordinal bigint, word string, tag string, start int, end int, score double")
    text = spark.createDataFrame([("a", "Zdenka piše")], "letter_id string, text string")
    assert rows(mentions.tagger_mentions(raw, text, 0.6, "m").select("ordinal", "text", "label"), "ordinal") == [(1, "Zdenka", "PER"), (4, "Novo", "WEIRD")]


def test_gazetteer_and_dates_are_extractors(spark):
    text = spark.createDataFrame([("a", "U Nišu 1925, Niš"), ("b", None)], "letter_id string, text string")
    places = spark.createDataFrame([("Niš", "LOC")], "label string, type string")
    got = mentions.recognised(text, [mentions.date_mentions, lambda x: mentions.gazetteer_mentions(x, places)])
    assert rows(got.select("text", "label", "start", "end"), "start") == [("1925", "DATE", 7, 11), ("Niš", "LOC", 13, 16)]


LINES = "g string, seq bigint, page_file string, page_number int, text string"


def test_segments(spark):
    page = ["Beograd, 1. IV 1925.", "Beograd 2. IV. 25.", "Draga Zdenka,", "pišem Vam.", "Zagreb, 3. V 1925.", "[Адреса:]", "Dr. Z. M.", "Zagreb, 5. VI 1925.", "Dragi,", "Polj-", "sku."]
    df = spark.createDataFrame([("x", i, "p9" if i < 8 else "p10", 9 if i < 8 else 10, t) for i, t in enumerate(page)] + [("y", 0, None, None, "  "), (None, 0, "p", 1, "Samo.")], LINES)
    got = segment.segments(df, "g")
    by = {(r["g"], r["letter_no"]): r for r in got.collect()}
    assert set(by) == {("x", 1), ("x", 2), (None, 1)}
    assert by["x", 1]["text"].split("\n")[-1] == "Dr. Z. M." and by["x", 2]["text"].endswith("Poljsku.")
    assert by["x", 1]["raw_header"].count(" | ") == 6 and by["x", 2]["source_pages"] == [9, 10]
    stored = {r["letter_id"]: r["source_pages"] for r in segment.letters(got, "g").collect()}
    assert sorted(stored) == ["letter_0001", "letter_0002", "letter_0003"] and "10;9" in stored.values()


def test_segments_of_nothing(spark):
    assert segment.segments(spark.createDataFrame([], LINES), "g").count() == 0


def test_recipients(spark):
    texts = {
        "a": "Zagreb\nDraga Zdenka Marković,\ntekst",
        "b": "Zagreb\nDraga gospođice,\ntekst",
        "c": "tekst\n[Adresa:]\nDr. Zdenka Marković\nZagreb",
        "d": "tekst",
        "e": "Draga gospodice Zdenka,",
    }
    text = spark.createDataFrame(list(texts.items()) + [("f", None)], "letter_id string, text string")
    said = spark.createDataFrame([("b", 2, "Ana", "PER", 40, 43, 1.0, "m"), ("b", 3, "Eva", "PER", 10, 13, 1.0, "m"), ("c", 4, "Zdenka", "PER", 20, 26, 1.0, "m"), ("c", 5, "Zdenka Marković", "PER", 20, 35, 1.0, "m")], M)
    got = dict(rows(letters.recipients(text, said, "?").select("letter_id", "recipient")))
    assert got == {"a": "Zdenka Marković", "b": "Ana", "c": "Zdenka Marković", "d": "?", "e": "?", "f": "?"}


def test_places(spark):
    df = spark.createDataFrame([(1, None, "\n\nSarajevo, 1925"), (2, " Београд ", "x"), (3, "nan", "Марсеј 1925"), (4, "", None)], "i int, p string, t string")
    assert [r[0] for r in df.orderBy("i").select(letters.place(F.col("p"), F.col("t"))).collect()] == ["Sarajevo", "Beograd", "Marseille", None]


def _graph(spark):
    text = spark.createDataFrame([("letter_0001", "p1", "1", "h", "Tekst", "Ana Ić", "Eva Ić", "1925-01-02", "Niš", "m"), ("letter_0002", None, None, None, None, "Ana Ić", "", None, None, None)], "letter_id string, source_page_files string, source_pages string, raw_header string, text string, sender string, recipient string, date_iso string, place_written string, date_header_match string")
    ents = spark.createDataFrame([(1, "", "Niš", "LOC", "http://x/Q1", 1), (2, "", "Ana Ić", "PER", None, 2)], "ordinal bigint, entity_id string, label string, type string, wikidata_uri string, mention_count bigint")
    said = spark.createDataFrame([("letter_0001", 1, "Niš", "LOC", 0, 3, 0.5, "m"), ("letter_0001", 2, "Niš", "LOC", None, None, None, None), ("letter_0002", 3, "Eva Ić", "PER", 1, 2, 0.5, "m"), ("letter_0002", 4, "...", "PER", 1, 2, 0.5, "m")], M)
    return text, ents, said


def test_triples(spark):
    g = triples(*_graph(spark), Config()).cache()
    assert g.count() == g.distinct().count()
    n = dict(rows(g.groupBy("p").count()))
    short = {p.rsplit("/", 1)[-1].rsplit("#", 1)[-1]: c for p, c in n.items()}
    assert short["mentions"] == 2 and short["hasMention"] == 3 and short["startOffset"] == 2 and short["confidence"] == 2
    assert short["sender"] == 2 and short["recipient"] == 1 and short["exactMatch"] == 1 and short["dateSent"] == 1
    q = graph_queries.Graph(g, Config())
    assert [(r["label"], r["mentions"]) for r in graph_queries.mentioned_persons(q).collect()] == [("Eva Ić", 1)]
    assert [(r["date"], r["place_label"]) for r in graph_queries.letters_by_date(q).collect()] == [(None, None), ("1925-01-02", "Niš")]
    assert [r["mentioned_place_label"] for r in graph_queries.letters_mentioning_places(q).collect()] == ["Niš"]
    assert graph_queries.entity_network(q).count() == 2
    q.register("t")
    assert spark.sql("select count(*) from t_mentions").first()[0] == 2


def test_entity_table_and_links(spark):
    said = spark.createDataFrame([("a", 1, "Niš", "LOC", 0, 1, 1.0, "m"), ("a", 2, "niš.", "LOC", 0, 1, 1.0, "m"), ("a", 3, "Ana", "PER", 0, 1, 1.0, "m"), ("a", 4, "..", "PER", 0, 1, 1.0, "m"), ("a", 5, "X", None, 0, 1, 1.0, "m")], M)
    table = linking.entity_table(said)
    assert sorted(rows(table)) == [("Ana", "PER", 1), ("Niš", "LOC", 2), ("X", "MISC", 1)]
    manual = spark.createDataFrame([("niš", "LOC", "u1")], "label string, type string, wikidata_uri string")
    other = spark.createDataFrame([("ana", "u2"), ("x", "u3")], "label string, wikidata_uri string")
    got = {r["label"]: r["wikidata_uri"] for r in linking.linked(table, manual, linking.DictionaryProvider(other)).collect()}
    assert got == {"Niš": "u1", "Ana": "u2", "X": None}


def test_network(spark):
    text, ents, said = _graph(spark)
    got = rows(network.edges(said, ents), "source", "target")
    assert ("letter_0001", "Niš", "LETTER", "LOC", 2) in got and sum(r[4] for r in got) == 4
    e = network.edges(said, ents).withColumn("ordinal", F.monotonically_increasing_id())
    n = {r["node"]: r for r in network.nodes(e.unionByName(e)).collect()}
    assert n["Niš"]["degree"] == 1 and n["Niš"]["row_degree"] == 2 and n["Niš"]["html_size"] == 24
    assert network.drawn_edges(e).where("width < 0.6 or width > 3").count() == 0


def test_ner_metrics(spark):
    gold = spark.createDataFrame([("a", "X", "PER"), ("a", "X", "PER"), ("a", "Y", "LOC"), ("a", "E", "EVENT"), ("a", " ", "PER")], "letter_id string, text string, label string")
    found = spark.createDataFrame([("a", "X", "per"), ("a", "X ", "PER"), ("a", "Z", "LOC")], "letter_id string, text string, label string")
    got = {r["type"]: r for r in evaluation.ner_metrics(gold, found.withColumn("label", F.upper("label"))).collect()}
    assert (got["PER"]["gold"], got["PER"]["correct"], got["PER"]["f1"]) == (2, 2, 1.0)
    assert got["ORG"]["gold"] == 0 and got["ORG"]["f1"] == 0.0 and got["micro avg."]["predicted"] == 3
    assert sorted(r[:4] for r in rows(evaluation.ner_errors(gold, found))) == [("FN", "a", "Y", "LOC"), ("FP", "a", "Z", "LOC")]
    assert [r["f1"] for r in evaluation.formatted(evaluation.ner_metrics(gold, gold)).where("type = 'PER'").collect()] == ["1.000"]


def test_nel_metrics(spark):
    gold = spark.createDataFrame([(1, "A", "PER", "u1"), (2, "B", "LOC", "u2"), (3, "C", "WORK", "u3")], "ordinal int, label string, type string, wikidata_uri string")
    found = spark.createDataFrame([(1, "a", "per", "u0"), (2, "A", "PER", "u1"), (3, "B", "LOC", "u9"), (4, "D", "ORG", "")], "ordinal int, label string, type string, wikidata_uri string")
    got = {r["type"]: r for r in evaluation.nel_metrics(gold, found).collect()}
    assert got["PER"]["correct"] == 1 and got["LOC"]["accuracy"] == 0.0 and got["micro avg."]["gold"] == 3
    assert sorted(r[0] for r in rows(evaluation.nel_errors(gold, found))) == ["FN", "FN", "FP"]
    assert evaluation.coverage(gold, found).first()[0] == pytest.approx(4 / 3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], M)
    assert mentions.merged_pieces(none).count() == 0 and mentions.without_contained_dates(none).count() == 0 and linking.entity_table(none).count() == 0
    assert evaluation.ner_metrics(none, none).count() == 5


def test_segments_as_one_fold(spark):
    """Parts folded side by side give what one fold over each group gives, whatever headers, addresses and short segments follow each other."""
    import random

    chance = random.Random(8)
    says = ["Beograd, 1. IV 1925.", "Zagreb, 3. V 1925.", "[Adresa:]", "Draga Zdenka,", "pišem Vam.", "tekst", "  ", "Vaš", "nešto u Polj-", "skoj"]
    rows = [(g, i, f"p{g}", 1, chance.choice(says)) for g in ("a", "b", "c", None) for i in range(400)] + [(f"s{k}", 0, "p", 1, chance.choice(says)) for k in range(40)]
    want = []
    for g in dict.fromkeys(r[0] for r in rows):
        lines = [r[4] for r in rows if r[0] == g]
        fold, held = segment.Fold(), []
        made = []
        for i, line in enumerate(lines):
            header = line.startswith(("Beograd", "Zagreb"))
            if header and fold.splits("[Adresa:]" in lines[i + 1 : i + 4]):
                made.append(held)
                held, fold.lines = [], []
            held.append(line)
            fold.lines.append(line)
        texts = [t for t in map(segment.letter_text, [*made, held]) if t]
        want += [(g, k + 1, t) for k, t in enumerate(texts)]
    chance.shuffle(rows)
    got = [tuple(r) for r in segment.segments(spark.createDataFrame(rows, LINES).repartition(5), "g").select("g", "letter_no", "text").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
