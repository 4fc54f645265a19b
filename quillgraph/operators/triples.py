"""Letters, entities and mentions as a set of triples."""

from __future__ import annotations

from collections.abc import Collection
from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.config import Config
from quillgraph.dimensions import SCHEMA_TYPES
from quillgraph.functions.text import canonical_composed, uri_slug
from quillgraph.schemas import TRIPLES
from quillgraph.session import checkpointed

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS_LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
SCHEMA = "https://schema.org/"
DCTERMS = "http://purl.org/dc/terms/"
PROV = "http://www.w3.org/ns/prov#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
XSD = "http://www.w3.org/2001/XMLSchema#"
PREFIXES = {"schema": SCHEMA, "dcterms": DCTERMS, "prov": PROV, "foaf": "http://xmlns.com/foaf/0.1/", "owl": "http://www.w3.org/2002/07/owl#", "skos": SKOS, "xsd": XSD, "rdfs": "http://www.w3.org/2000/01/rdf-schema#"}
KEY = ["s", "p", "o", "o_kind", "datatype", "lang"]


class Item(NamedTuple):
    """A triple to make of a row: its predicate, its object if that is the same for all rows, and the rest."""

    p: str
    constant: str | None
    value: Column


class Wanted:
    """Which triples are asked for: all, or those of some predicates, one object, or one kind of subject."""

    def __init__(self, predicates: Collection[str] | None = None, o: str | None = None, subject: str | None = None):
        self.predicates, self.o, self.subject = predicates, o, subject

    def of(self, subject: str, items: list[Item]) -> list[Item]:
        """Items of a kind of subject that may give such triples; those of another constant object are none."""
        return [i for i in items if self.subject in (None, subject) and (self.predicates is None or i.p in self.predicates) and (self.o is None or i.constant in (None, self.o))]


def _iri(p: str, o: Column | str) -> Item:
    value = F.struct(F.lit(p).alias("p"), (F.lit(o) if isinstance(o, str) else o).alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))
    return Item(p, o if isinstance(o, str) else None, value)


def _text(p: str, o: Column, datatype: str | None = None, lang: str | None = None) -> Item:
    return Item(p, None, F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit("literal").alias("o_kind"), F.lit(datatype).cast("string").alias("datatype"), F.lit(lang).cast("string").alias("lang")))


def _emit(df: DataFrame, subject: Column, items: list[Item]) -> DataFrame:
    """A row for each item whose object is there and not empty."""
    if len(items) == 1:  # no array to build and take apart
        return df.select(subject.alias("s"), items[0].value.alias("t")).select("s", "t.*").where("o <> ''")
    some = F.filter(F.array(*[i.value for i in items]), lambda x: x["o"].isNotNull() & (x["o"] != ""))
    return df.select(subject.alias("s"), F.explode(some).alias("t")).select("s", "t.*")


def keyed(label: Column) -> Column:
    return F.lower(label)


def entities_of(letters: DataFrame, entities: DataFrame, mentions: DataFrame, config: Config) -> DataFrame:
    """(key, type, uri, label, wikidata_uri, listed, at): every entity row listed, in the order of its ordinal, and those that letters or mentions name beside them.

    A listed entity keeps the label of its last row of a key for its URI; one that is not listed
    takes the label named first: senders, recipients, places of letters, then mentions.
    """
    listed = entities.select(canonical_composed("label").alias("label"), F.upper(F.coalesce(F.nullif("type", F.lit("")), F.lit("MISC"))).alias("type"), F.nullif("wikidata_uri", F.lit("")).alias("wikidata_uri"), F.lit(True).alias("listed"), (F.col("ordinal") if "ordinal" in entities.columns else F.lit(0)).cast("bigint").alias("at")).where("label <> ''")
    # each spelling is read once, however often it is written
    part = lambda c, kind, k: letters.select(c).dropna().distinct().select(canonical_composed(c).alias("label"), F.lit(kind).alias("type"), F.lit(None).cast("string").alias("wikidata_uri"), F.lit(False).alias("listed"), F.lit(0).cast("bigint").alias("at"), F.lit(k).alias("part"))
    named = part("sender", "PER", 1).unionByName(part("recipient", "PER", 2)).unionByName(part("place_written", "LOC", 3))
    said = mentions.groupBy("text", "label").agg(F.min("ordinal").alias("ordinal"))
    named = named.unionByName(said.select(canonical_composed("text").alias("label"), F.upper(F.coalesce(F.nullif("label", F.lit("")), F.lit("MISC"))).alias("type"), F.lit(None).cast("string").alias("wikidata_uri"), F.lit(False).alias("listed"), F.col("ordinal").cast("bigint").alias("at"), F.lit(4).alias("part")))
    # one row for each key before the anti join: names repeat a great deal
    first = named.where("label <> ''").groupBy(keyed(F.col("label")).alias("key"), "type").agg(F.min_by("label", F.struct("part", "at", "label")).alias("label"))
    minted = first.join(listed.select(keyed(F.col("label")).alias("key"), "type").distinct(), ["key", "type"], "left_anti").select("label", "type", F.lit(None).cast("string").alias("wikidata_uri"), F.lit(False).alias("listed"), F.lit(0).cast("bigint").alias("at"))
    every = listed.unionByName(minted)
    uri = F.concat(F.lit(config.base_uri + "entity/"), uri_slug(F.concat_ws("_", "type", "label")))
    return every.select(keyed(F.col("label")).alias("key"), "type", uri.alias("uri"), "label", "wikidata_uri", "listed", "at")


def entity_index(known: DataFrame) -> DataFrame:
    """(key, type, uri): one URI for each key, that of its last row."""
    return known.groupBy("key", "type").agg(F.max_by("uri", F.struct("at", "label")).alias("uri"))


class Sources:
    """The tables a graph is made of. Known entities are computed once, when they are first needed."""

    def __init__(self, letters: DataFrame, entities: DataFrame, mentions: DataFrame, config: Config | None = None):
        self.letters, self.entities, self.mentions, self.config = letters, entities, mentions, config or Config()

    @cached_property
    def known(self) -> DataFrame:
        return checkpointed(entities_of(self.letters, self.entities, self.mentions, self.config))

    @cached_property
    def index(self) -> DataFrame:
        return entity_index(self.known)

    def letter_uri(self, c: Column) -> Column:
        return F.concat(F.lit(self.config.base_uri + "letter/"), uri_slug(F.coalesce(c, F.lit("letter"))))

    def triples(self, predicates: Collection[str] | None = None, o: str | None = None, subject: str | None = None) -> DataFrame:
        """(s, p, o, o_kind, datatype, lang): the graph as a set, or what of it has one of the predicates, the object and a subject that is a collection, entity, letter or mention."""
        wanted = Wanted(predicates, o, subject)
        parts = [part for part in (self._head(wanted), self._of_entities(wanted), self._of_letters(wanted), *self._of_mentions(wanted)) if part is not None]
        if not parts:
            return self.letters.sparkSession.createDataFrame([], TRIPLES)
        # subjects and predicates of the parts differ, so each part is a set by itself
        found = reduce(DataFrame.unionByName, parts)
        return found.where(F.col("o") == o) if o is not None else found

    def _head(self, wanted: Wanted) -> DataFrame | None:
        c = self.config
        items = wanted.of("collection", [_iri(RDF_TYPE, SCHEMA + "Collection"), _text(RDFS_LABEL, F.lit(c.collection_label), lang=c.language), _text(DCTERMS + "source", F.lit(c.source_label), lang=c.language)])
        return _emit(self.letters.sparkSession.range(1), F.lit(c.base_uri + c.collection_id), items) if items else None

    def _of_entities(self, wanted: Wanted) -> DataFrame | None:
        classes = F.create_map(*[F.lit(x) for k, v in SCHEMA_TYPES.items() for x in (k, SCHEMA + v)])
        kind = F.coalesce(F.try_element_at(classes, F.col("type")), F.lit(SCHEMA + "Thing"))
        items = [_iri(RDF_TYPE, kind), _text(RDFS_LABEL, F.col("label"), lang=self.config.language), _text(DCTERMS + "type", F.col("type")), _iri(SKOS + "exactMatch", F.col("wikidata_uri")), _iri(DCTERMS + "source", F.col("wikidata_uri"))]
        items = wanted.of("entity", items)
        # classes of entities are of one vocabulary
        if not items or (wanted.o is not None and {i.p for i in items} == {RDF_TYPE} and not wanted.o.startswith(SCHEMA)):
            return None
        return _emit(self.known, F.col("uri"), items).dropDuplicates(KEY)

    def _of_letters(self, wanted: Wanted) -> DataFrame | None:
        c = self.config
        text = F.col("text") if c.keep_text else F.lit(None).cast("string")
        items = [_iri(RDF_TYPE, c.base_uri + "Letter"), _iri(RDF_TYPE, SCHEMA + "Message"), _iri(DCTERMS + "isPartOf", c.base_uri + c.collection_id), _text(DCTERMS + "identifier", F.col("letter_id")), _text(PROV + "hadPrimarySource", F.col("source_page_files")), _text(SCHEMA + "pagination", F.col("source_pages")), _text(SCHEMA + "dateSent", F.col("date_iso"), XSD + "date"), _text(SCHEMA + "text", text, lang=c.language)]
        named = {SCHEMA + "sender": ("sender", "PER"), SCHEMA + "recipient": ("recipient", "PER"), SCHEMA + "locationCreated": ("place_written", "LOC")}
        asked = [p for p in named if wanted.of("letter", [_iri(p, F.lit(""))])]
        items = wanted.of("letter", items) + [_iri(p, F.col(f"_{named[p][0]}")) for p in asked]
        if not items:
            return None
        rows = self.letters
        # who and where find their URIs by joins on distinct keys: one name may be that of all letters, so it is looked up once
        for p in asked:
            name, kind = named[p]
            own = self.index.where(F.col("type") == kind).select("key", F.col("uri").alias(f"_{name}"))
            spelled = self.letters.select(name).dropna().distinct()
            found = spelled.join(own, keyed(canonical_composed(name)) == F.col("key")).drop("key")
            rows = rows.join(found, name, "left")
        return _emit(rows, self.letter_uri(F.col("letter_id")), items).dropDuplicates(KEY)

    def _of_mentions(self, wanted: Wanted) -> list[DataFrame]:
        c = self.config
        label = canonical_composed("text")
        pair, has = wanted.of("letter", [_iri(SCHEMA + "mentions", F.col("uri"))]), wanted.of("letter", [_iri(c.base_uri + "hasMention", F.col("mention"))])
        items = wanted.of("mention", [_iri(RDF_TYPE, c.base_uri + "EntityMention"), _iri(c.base_uri + "mentionOf", F.col("uri")), _text(c.base_uri + "mentionText", F.col("label"), lang=c.language), _text(DCTERMS + "type", F.col("type")), _text(c.base_uri + "startOffset", F.col("start"), XSD + "integer"), _text(c.base_uri + "endOffset", F.col("end"), XSD + "integer"), _text(c.base_uri + "confidence", F.col("score"), XSD + "float"), _text(PROV + "wasGeneratedBy", F.col("model"))])
        kind = F.upper(F.coalesce(F.nullif("label", F.lit("")), F.lit("MISC")))
        out = []
        if pair:
            # each spelling of a letter once before any name is read, and each spelling read once
            said = self.mentions.select("letter_id", "text", kind.alias("type")).distinct()
            spelled = said.select("text", "type").distinct().withColumn("key", keyed(label)).where("key <> ''").join(self.index, ["key", "type"]).select("text", "type", "uri")
            pairs = said.join(spelled, ["text", "type"]).select("letter_id", "uri").distinct().select(self.letter_uri(F.col("letter_id")).alias("letter"), "uri").distinct()
            out.append(_emit(pairs, F.col("letter"), pair))
        if has or items:
            said = self.mentions.select("letter_id", "ordinal", label.alias("label"), kind.alias("type"), F.col("start").try_cast("int").alias("start"), F.col("end").try_cast("int").alias("end"), F.col("score").try_cast("double").alias("score"), "model").where("label <> ''")
            # repeated rows go before they become eight triples each
            said = said.dropDuplicates().withColumn("key", keyed(F.col("label"))).join(self.index, ["key", "type"]).withColumn("letter", self.letter_uri(F.col("letter_id")))
            said = said.withColumn("mention", F.concat(F.lit(c.base_uri + "mention/"), uri_slug(F.coalesce("letter_id", F.lit("letter"))), F.lit("/"), F.col("ordinal").cast("string")))
            out += [_emit(said, F.col("letter"), has)] if has else []
            out += [_emit(said, F.col("mention"), items)] if items else []
        return out


def triples(letters: DataFrame, entities: DataFrame, mentions: DataFrame, config: Config | None = None) -> DataFrame:
    """(s, p, o, o_kind, datatype, lang): the graph as a set.

    ``mentions`` have an ordinal that counts from 1 in file order, skipped rows included. A
    value that is missing or does not parse gives no triple.
    """
    return Sources(letters, entities, mentions, config).triples()
