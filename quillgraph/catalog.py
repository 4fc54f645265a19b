"""Queries of the core by name; each takes a session and a dataset folder and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.config import Config
from quillgraph.functions import dates, text
from quillgraph.functions.spans import matches
from quillgraph.operators import evaluation, letters, linking, mentions, network, segment
from quillgraph.operators.triples import Sources
from quillgraph.oracles import ALIASES, ORACLES  # noqa: F401
from quillgraph.plans import graph_queries
from quillgraph.session import numbered, read_table
from quillgraph.sources import pagexml, sinks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CONFIG = Config(default_sender="Vukan Zvelmorić", default_recipient="")
#: Any capitalised name may head a letter in these data, whose places are invented.
PLACE = r"\p{L}+(?: \p{L}+)?"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _letters(spark: SparkSession, folder: str) -> DataFrame:
    """Letters, each once: some were delivered twice, unchanged."""
    return read_table(spark, folder, "letters_fixed").dropDuplicates(["letter_id"])


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = _letters(spark, folder).where("text is not null")
    return rows.select("letter_id", "source_page_files", "source_pages", F.posexplode(F.split("text", "\n")).alias("seq", "text"))


def _sources(spark: SparkSession, folder: str) -> Sources:
    return Sources(_letters(spark, folder), read_table(spark, folder, "ner_nel_entities"), read_table(spark, folder, "ner_entities"), CONFIG)


def _graph(spark: SparkSession, folder: str) -> DataFrame:
    return _sources(spark, folder).triples()


def _by_predicate(spark: SparkSession, folder: str) -> graph_queries.Graph:
    """The graph by predicate: a pattern makes only the triples it asks for."""
    return graph_queries.Graph(_sources(spark, folder))


@query
def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "letters_fixed").select("letter_id", text.normalized("text").alias("text_norm"))


@query
def dehyphenate(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "letters_fixed").select("letter_id", text.dehyphenated("text").alias("text_joined"))


@query
def canonical_label(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "ner_entities")
    return rows.select("ordinal", text.canonical("text").alias("label"), text.surface("text").alias("surface"), text.safe("letter_id").alias("letter"))


@query
def slug(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "manual_links").select(F.concat_ws("_", "type", "label").alias("name"))
    rows = rows.unionByName(read_table(spark, folder, "part").select(F.col("p_name").alias("name"))).unionByName(read_table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("name")))
    return rows.select("name", text.slug("name").alias("slug"), text.uri_slug("name").alias("uri_slug"))


@query
def date_normalize(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("d"))
    romans = F.element_at(F.array(*[F.lit(r) for r in ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII")]), F.month("d"))
    y = text.col(F.date_format("d", "yyyy"))
    forms = {"numeric": F.date_format("d", "M"), "roman": romans, "dotted": F.concat(F.lit(" "), F.lower(romans), F.lit(". ")), "none": F.lit("13"), "word": F.lit("oktobra")}
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("form"), dates.iso(dates.year(y), dates.month(m), F.dayofmonth("d")).alias("date_iso"), dates.year(F.substring(y, 3, 2)).alias("year")) for k, m in forms.items()]))
    return rows.select("o_orderkey", kinds.alias("k")).select("o_orderkey", "k.form", "k.date_iso", "k.year")


@query
def date_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = mentions.date_mentions(_letters(spark, folder))
    return found.select("letter_id", "text", "label", "start", "end", "score", "model")


@query
def place_date_header(spark: SparkSession, folder: str) -> DataFrame:
    return _letters(spark, folder).select("letter_id", dates.header("text").alias("h")).select("letter_id", "h.place", "h.date_iso", "h.matched")


@query
def place_repair(spark: SparkSession, folder: str) -> DataFrame:
    return _letters(spark, folder).select("letter_id", letters.place(F.col("place_written"), F.col("text"), ["Gornji", "Novi", "Stari", "Нови", "Стари"]).alias("place"))


@query
def header_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    return lines.withColumn("is_header", segment.is_header(F.col("text"), segment.header_pattern(place_pattern=PLACE))).where("is_header").select("letter_id", "seq", "text")


@query
def address_lookahead(spark: SparkSession, folder: str) -> DataFrame:
    return segment.address_follows(_lines(spark, folder), ["letter_id"]).where("address_follows").select("letter_id", "seq", "text")


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """Letters that share page files are cut apart again; a page file's lines are one sequence."""
    lines = _lines(spark, folder).withColumn("page_file", F.col("source_page_files")).withColumn("page_number", F.split("source_pages", ";")[0].cast("int"))
    # numbers over all page files serve as well within each
    placed = numbered(lines, ["page_file", "letter_id", "seq"], "seq")
    return segment.segments(placed, "page_file", segment.header_pattern(place_pattern=PLACE))


@query
def segment_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Every letter found in the lines of a page file."""
    return _segments(spark, folder).select("page_file", "letter_no", F.array_join("source_page_files", ";").alias("source_page_files"), "raw_header", "text")


@query
def stored_letters(spark: SparkSession, folder: str) -> DataFrame:
    """The letters found, with ids that count through the page files, as they are stored."""
    return segment.letters(_segments(spark, folder), "page_file").select("letter_id", "source_page_files", "source_pages", "raw_header", "text")


@query
def page_markup(spark: SparkSession, folder: str) -> DataFrame:
    """Letters written as page markup and scanned again: a region and a line for each line with text."""
    rows = _letters(spark, folder).where("text is not null")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    line = lambda x, i: F.concat(F.lit('<TextLine id="l'), i.cast("string"), F.lit('"><TextEquiv><Unicode>'), esc(x), F.lit("</Unicode></TextEquiv></TextLine>"))
    body = F.array_join(F.transform(F.split("text", "\n"), line), "")
    page = F.concat(F.lit('<PcGts xmlns="urn:page"><Page imageFilename="'), F.coalesce("source_page_files", F.lit("")), F.lit('"><TextRegion id="r1">'), body, F.lit("</TextRegion></Page></PcGts>"))
    found = pagexml.parse_pages(rows.select(F.concat("letter_id", F.lit(".xml")).alias("path"), page.alias("content")))
    return found.where("error is null").select("page_file", "page_number", "region_id", "line_id", "text")


@query
def page_spec(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "letters_fixed").where("source_pages is not null").select("source_pages").distinct()
    return rows.select("source_pages", F.explode(pagexml.page_spec(F.concat(F.replace("source_pages", F.lit(";"), F.lit("-")), F.lit(", 3")))).alias("page"))


def _pieces(spark: SparkSession, folder: str, gap: Column) -> DataFrame:
    """Every mention as a letter of its own (own), cut into two pieces where it has offsets and four letters; the second begins ``gap`` later."""
    rows = read_table(spark, folder, "ner_entities").withColumn("own", F.concat_ws("#", F.coalesce("letter_id", F.lit("")), "ordinal"))
    piece = lambda k, text, start, end: F.struct(F.lit(k).alias("k"), text.alias("word"), start.cast("int").alias("start"), end.cast("int").alias("end"))
    start, end, text = F.col("start"), F.col("end"), F.col("text")
    cut = F.array(piece(0, F.substring("text", 1, 2), start, start + 2), piece(1, F.concat(F.lit("##"), F.expr("substring(text, 3)")), start + 2 + gap, end))
    can = F.coalesce((F.col("label") != "DATE") & (F.length("text") > 3) & (end - start > 3), F.lit(False))
    return rows.select("own", "ordinal", "label", "score", "model", F.explode(F.when(can, cut).otherwise(F.array(piece(0, text, start, end)))).alias("p")).select("own", "ordinal", "label", "score", "model", "p.*")


@query
def wordpiece_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Every mention cut into two pieces and merged again."""
    pieces = _pieces(spark, folder, F.lit(0)).withColumnsRenamed({"own": "letter_id", "word": "text"})
    return mentions.merged_pieces(pieces).select("ordinal", "text", "label", "start", "end", "score")


@query
def wordpiece_merge_inference(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces in model order, of which each second one continues the one before only if it starts where that ends."""
    pieces = _pieces(spark, folder, F.when(F.col("label") == "LOC", 1).otherwise(0)).withColumn("ordinal", F.col("ordinal") * 2 + F.col("k"))
    return mentions.merged_in_model_order(pieces.withColumnsRenamed({"own": "letter_id", "label": "tag"})).select("ordinal", "word", "tag", "start", "end", "score")


@query
def contained_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Dates, and their years as dates of their own, of which the contained ones go."""
    rows = read_table(spark, folder, "ner_entities").select("ordinal", "letter_id", "text", "label", "start", "end")
    years = rows.where("label = 'DATE' and length(text) > 4 and start is not null").select("ordinal", "letter_id", F.expr("right(text, 4)").alias("text"), "label", (F.col("end") - 4).alias("start"), "end")
    return mentions.without_contained_dates(rows.unionByName(years)).select("ordinal", "letter_id", "text", "label", "start", "end")


@query
def drop_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "ner_entities").withColumn("surface", text.surface("text")).where("surface <> '' and letter_id <> ''")
    return rows.where((F.col("score") >= CONFIG.min_score) & (F.length("surface") >= 2) & mentions.keeps(F.col("surface"), F.col("label"))).select("ordinal", "surface", "label")


@query
def alias_normalize(spark: SparkSession, folder: str) -> DataFrame:
    """The first word of each person in its full form, by a look-up table of familiar forms, and listed surfaces in their own form."""
    forms = read_table(spark, folder, "given_name_forms").groupBy("short_form").agg(F.min("given_name").alias("given_name"))
    named = read_table(spark, folder, "ner_entities").where("label = 'PER'").withColumn("surface", text.surface("text"))
    rows = named.select("ordinal", F.split("surface", " ")[0].alias("word"), text.aliased("surface", ALIASES).alias("alias"))
    # 42 rows, fixed
    return rows.join(F.broadcast(forms), F.col("word") == F.col("short_form"), "left").select("ordinal", F.coalesce("given_name", "word").alias("given_name"), "alias")


@query
def split_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The places of each letter around a dash, split into one row each."""
    rows = read_table(spark, folder, "ner_entities").where("label = 'LOC' and letter_id is not null and text is not null").groupBy("letter_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "text"))).alias("l"))
    joined = rows.select("letter_id", F.array_join(F.transform("l", lambda x: F.translate(x["text"], "–—-", "")), " — ").alias("text"), F.lit("LOC").alias("label"), F.lit(5).alias("start"))
    joined = joined.withColumn("end", F.col("start") + F.length("text")).withColumn("score", F.lit(1.0))
    return mentions.split_merged(joined).select("letter_id", "text", "label", "start", "end")


@query
def mention_union_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Tagged mentions and dates by rule, each once, the first kept."""
    tagged = read_table(spark, folder, "ner_entities").where("label <> 'DATE'").select("ordinal", "letter_id", "text", "label", "start", "end")
    ruled = mentions.date_mentions(_letters(spark, folder)).select(F.lit(1 << 40).alias("ordinal"), "letter_id", "text", "label", "start", "end")
    return mentions.first_of_each(tagged.unionByName(ruled), ["letter_id", "text", "label", "start", "end"]).select("letter_id", "text", "label", "start", "end", "ordinal")


@query
def gazetteer_mentions(spark: SparkSession, folder: str) -> DataFrame:
    return mentions.gazetteer_mentions(_letters(spark, folder), read_table(spark, folder, "manual_links").where("type = 'LOC'"))


@query
def tagger_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Mentions as a tagger gives them, read again over the letters' text."""
    raw = read_table(spark, folder, "ner_entities").select("letter_id", "ordinal", F.col("text").alias("word"), F.col("label").alias("tag"), "start", "end", "score")
    return mentions.tagger_mentions(raw, _letters(spark, folder), CONFIG.min_score, "tagger-v1").select("ordinal", "letter_id", "text", "label", "start", "end", "score", "model")


@query
def recognised_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Mentions of all extractors that need no model, each once."""
    places = read_table(spark, folder, "manual_links").where("type = 'LOC'")
    return mentions.recognised(_letters(spark, folder), [mentions.date_mentions, lambda x: mentions.gazetteer_mentions(x, places)])


@query
def clean_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cleaning of mentions that have offsets and a letter."""
    return mentions.cleaned(read_table(spark, folder, "ner_entities").where("letter_id is not null and start is not null and end is not null"), CONFIG.aliases).select("ordinal", "letter_id", "text", "label", "start", "end", "model")


@query
def clean_mentions_all(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cleaning of all mentions, those without offsets or a letter too."""
    return mentions.cleaned(read_table(spark, folder, "ner_entities"), CONFIG.aliases).select("ordinal", "letter_id", "text", "label", "start", "end", "model")


@query
def recipient_inference(spark: SparkSession, folder: str) -> DataFrame:
    return letters.recipients(_letters(spark, folder).drop("recipient"), read_table(spark, folder, "ner_entities"), "unknown").select("letter_id", "recipient")


@query
def letter_enrich(spark: SparkSession, folder: str) -> DataFrame:
    found = letters.enriched(_letters(spark, folder), read_table(spark, folder, "ner_entities"), CONFIG.default_sender)
    return letters.overridden(found, recipient="Darinka Stolburić").select("letter_id", "sender", "recipient", "date_iso", "place_written", "date_header_match")


@query
def entity_table(spark: SparkSession, folder: str) -> DataFrame:
    return linking.entity_table(read_table(spark, folder, "ner_entities")).orderBy("type", "label")


@query
def entity_link(spark: SparkSession, folder: str) -> DataFrame:
    """Entities with links by hand for places and organisations, and by a provider for persons."""
    manual = read_table(spark, folder, "manual_links")
    dictionary = tables.link_dictionary(manual.where("type <> 'PER'"), F.col("wikidata_uri"))
    provider = linking.DictionaryProvider(manual.where("type = 'PER'"), manual.where("type = 'LOC'"))
    return linking.linked(linking.entity_table(read_table(spark, folder, "ner_entities")), dictionary, provider, CONFIG.lookup_types)


@query
def triples_by_predicate(spark: SparkSession, folder: str) -> DataFrame:
    return _graph(spark, folder).groupBy("p").agg(F.count("*").alias("n"))


@query
def triple_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The graph as N-Triples."""
    return sinks.ntriples(_graph(spark, folder))


@query
def jsonld_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.jsonld_nodes(_graph(spark, folder))


@query
def q_letters_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return graph_queries.letters_by_date(_by_predicate(spark, folder))


@query
def q_mentioned_persons(spark: SparkSession, folder: str) -> DataFrame:
    return graph_queries.mentioned_persons(_by_predicate(spark, folder))


@query
def q_letters_places(spark: SparkSession, folder: str) -> DataFrame:
    return graph_queries.letters_mentioning_places(_by_predicate(spark, folder))


@query
def q_entity_network(spark: SparkSession, folder: str) -> DataFrame:
    return graph_queries.entity_network(_by_predicate(spark, folder))


@query
def network_edges(spark: SparkSession, folder: str) -> DataFrame:
    return network.sorted_edges(network.edges(read_table(spark, folder, "ner_entities"), read_table(spark, folder, "ner_nel_entities")))


@query
def node_degree(spark: SparkSession, folder: str) -> DataFrame:
    return network.nodes(read_table(spark, folder, "entity_network_edges"))


@query
def drawn_edges(spark: SparkSession, folder: str) -> DataFrame:
    return network.drawn_edges(read_table(spark, folder, "entity_network_edges"))


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    """What an earlier run of the tagger had: an edge is a mention of its letter, whichever end that is at."""
    e = read_table(spark, folder, "entity_network_edges").where("source_type = 'LETTER' or target_type = 'LETTER'")
    # of two letter ends the target is what is mentioned
    first = F.coalesce(F.col("source_type") == "LETTER", F.lit(False))
    end = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    return e.select(end("source", "target").alias("letter_id"), end("target", "source").alias("text"), end("target_type", "source_type").alias("label"))


@query
def ner_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = evaluation.ner_metrics(_gold(spark, folder), read_table(spark, folder, "ner_entities"))
    return found.select("type", "gold", "predicted", "correct", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query
def ner_errors(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.ner_errors(_gold(spark, folder), read_table(spark, folder, "ner_entities"))


@query
def nel_metrics(spark: SparkSession, folder: str) -> DataFrame:
    gold = read_table(spark, folder, "manual_links").withColumn("ordinal", F.lit(0))
    found = evaluation.nel_metrics(gold, read_table(spark, folder, "ner_nel_entities"))
    return found.select("type", "gold", "predicted", "correct", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


@query
def nel_errors(spark: SparkSession, folder: str) -> DataFrame:
    gold = read_table(spark, folder, "manual_links").withColumn("ordinal", F.lit(0))
    return evaluation.nel_errors(gold, read_table(spark, folder, "ner_nel_entities"))


@query
def link_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.coverage(read_table(spark, folder, "manual_links"), read_table(spark, folder, "ner_nel_entities")).select(F.round("coverage", 6).alias("coverage"))


@query
def metric_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics as they are written."""
    return evaluation.formatted(evaluation.ner_metrics(_gold(spark, folder), read_table(spark, folder, "ner_entities")))


@query
def label_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.label_histogram(read_table(spark, folder, "ner_entities"))


@query
def word_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Words of entity labels with their offsets."""
    rows = read_table(spark, folder, "manual_links")
    return rows.select("wikidata_uri", F.explode(matches("label", r"[\p{L}]+")).alias("w")).select("wikidata_uri", "w.text", "w.start", "w.end")
