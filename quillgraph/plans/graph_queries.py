"""Graph patterns over the triple relation, as joins of its predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.config import Config
from quillgraph.operators.triples import DCTERMS, RDF_TYPE, RDFS_LABEL, SCHEMA, Sources


class Graph:
    """The triples by predicate; a pattern reads only its predicates, filtered before any join.

    Of a relation of triples the predicates are filtered; of ``Sources`` only those triples are
    made that a pattern asks for.
    """

    def __init__(self, triples: DataFrame | Sources, config: Config | None = None):
        self.source, self.config = triples, config or (triples.config if isinstance(triples, Sources) else Config())

    @property
    def triples(self) -> DataFrame:
        return self.source.triples() if isinstance(self.source, Sources) else self.source

    def rows(self, predicate: str | None = None, o: str | None = None) -> DataFrame:
        """Triples of a predicate and an object, where given."""
        if isinstance(self.source, Sources):
            return self.source.triples(None if predicate is None else [predicate], o)
        found = self.source if predicate is None else self.source.where(F.col("p") == predicate)
        return found if o is None else found.where(F.col("o") == o)

    def of(self, predicate: str, s: str, o: str, subject: str | None = None) -> DataFrame:
        """Subjects and objects of a predicate; ``subject`` says that only entities, letters or mentions are of use."""
        found = self.source.triples([predicate], None, subject) if isinstance(self.source, Sources) else self.rows(predicate)
        return found.select(F.col("s").alias(s), F.col("o").alias(o))

    def typed(self, kind: str, s: str) -> DataFrame:
        return self.rows(RDF_TYPE, kind).select(F.col("s").alias(s))

    @property
    def letters(self) -> DataFrame:
        return self.typed(self.config.base_uri + "Letter", "letter")

    def register(self, prefix: str = "kg") -> None:
        """Temporary views ``<prefix>_triples`` and one for each predicate's last name, as a surface for SQL."""
        self.triples.createOrReplaceTempView(f"{prefix}_triples")
        for name, p in (("type", RDF_TYPE), ("label", RDFS_LABEL), ("mentions", SCHEMA + "mentions"), ("dtype", DCTERMS + "type"), ("date_sent", SCHEMA + "dateSent"), ("location_created", SCHEMA + "locationCreated"), ("recipient", SCHEMA + "recipient"), ("sender", SCHEMA + "sender")):
            self.of(p, "s", "o").createOrReplaceTempView(f"{prefix}_{name}")


def letters_by_date(g: Graph) -> DataFrame:
    """(letter, date, place_label, recipient_label): every letter with what is known of it, undated first."""
    place = g.of(SCHEMA + "locationCreated", "letter", "e").join(g.of(RDFS_LABEL, "e", "place_label", "entity"), "e").drop("e")
    recipient = g.of(SCHEMA + "recipient", "letter", "e").join(g.of(RDFS_LABEL, "e", "recipient_label", "entity"), "e").drop("e")
    rows = g.letters.join(g.of(SCHEMA + "dateSent", "letter", "date"), "letter", "left").join(place, "letter", "left").join(recipient, "letter", "left")
    return rows.select("letter", "date", "place_label", "recipient_label").orderBy(F.asc_nulls_first("date"), "letter", "place_label", "recipient_label")


def mentioned_persons(g: Graph) -> DataFrame:
    """(person, label, mentions): persons by the number of letters that mention them."""
    pairs = g.letters.join(g.of(SCHEMA + "mentions", "letter", "person"), "letter").groupBy("person").agg(F.count("letter").alias("mentions"))
    rows = pairs.join(g.typed(SCHEMA + "Person", "person"), "person", "left_semi").join(g.of(RDFS_LABEL, "person", "label", "entity"), "person")
    return rows.select("person", "label", "mentions").orderBy(F.desc("mentions"), "label", "person")


def _spellings(g: Graph, into: str) -> DataFrame:
    """(e, into): the labels of each entity, in order, in one row."""
    return g.of(RDFS_LABEL, "e", "label", "entity").groupBy("e").agg(F.sort_array(F.collect_list("label")).alias(into))


def letters_mentioning_places(g: Graph) -> DataFrame:
    """(letter, date, written_place_label, mentioned_place_label).

    A letter has a row for each label of a place it mentions with each label of its own place. These can be
    hundreds of times as many as letters, so letters are joined and put in order with lists of labels, and
    only the result has a row for each pair: none of them is shuffled or sorted.
    """
    of_letter = lambda pairs, into: pairs.join(_spellings(g, into), "e").groupBy("letter").agg(F.sort_array(F.flatten(F.collect_list(into))).alias(into))
    mentioned = of_letter(g.of(SCHEMA + "mentions", "letter", "e").join(g.typed(SCHEMA + "Place", "e"), "e", "left_semi"), "mentioned")
    written = of_letter(g.of(SCHEMA + "locationCreated", "letter", "e"), "written")
    rows = g.letters.join(mentioned, "letter").join(g.of(SCHEMA + "dateSent", "letter", "date"), "letter", "left").join(written, "letter", "left")
    rows = rows.orderBy(F.asc_nulls_first("date"), "letter").select("letter", "date", "written", F.explode("mentioned").alias("mentioned_place_label"))
    return rows.select("letter", "date", F.explode_outer("written").alias("written_place_label"), "mentioned_place_label")


def entity_network(g: Graph) -> DataFrame:
    """(letter, entity, label, type) of every mention in a letter."""
    rows = g.letters.join(g.of(SCHEMA + "mentions", "letter", "entity"), "letter").join(g.of(RDFS_LABEL, "entity", "label", "entity"), "entity").join(g.of(DCTERMS + "type", "entity", "type", "entity"), "entity")
    return rows.select("letter", "entity", "label", "type").orderBy("letter", "type", "label")
