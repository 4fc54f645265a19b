"""Queries in text and files, on a small graph."""

import pytest

from quillgraph.config import Config
from quillgraph.operators.triples import Sources
from quillgraph.plans import graph_queries, sparql
from tests.test_operators import _graph

HEAD = "PREFIX ex: <https://example.org/letters/>\nPREFIX schema: <https://schema.org/>\nPREFIX rdfs: <http://www.w3.org/2000/01/rdf-schema#>\n"
PATTERNS = {
    "letters_by_date": "SELECT ?letter ?date ?place_label ?recipient_label WHERE { ?letter a ex:Letter . OPTIONAL { ?letter schema:dateSent ?date } OPTIONAL { ?letter schema:locationCreated ?p . ?p rdfs:label ?place_label . } OPTIONAL { ?letter schema:recipient ?r . ?r rdfs:label ?recipient_label . } } ORDER BY ?date",
    "mentioned_persons": "SELECT ?person ?label (COUNT(?letter) AS ?mentions) WHERE { ?letter a ex:Letter ; schema:mentions ?person . ?person a schema:Person ; rdfs:label ?label . } GROUP BY ?person ?label ORDER BY DESC(?mentions)",
    "letters_mentioning_places": "SELECT ?letter ?date ?written_place_label ?mentioned_place_label { ?letter a ex:Letter ; schema:mentions ?m . ?m a schema:Place ; rdfs:label ?mentioned_place_label . OPTIONAL { ?letter schema:dateSent ?date . } OPTIONAL { ?letter schema:locationCreated ?w . ?w rdfs:label ?written_place_label . } } ORDER BY ?date ?letter",
    "entity_network": "SELECT ?letter ?entity ?label ?type WHERE { ?letter a ex:Letter ; schema:mentions ?entity . ?entity rdfs:label ?label ; <http://purl.org/dc/terms/type> ?type . } ORDER BY ?letter ?type ?label",
}


@pytest.fixture(scope="module")
def graph(spark):
    return graph_queries.Graph(Sources(*_graph(spark), Config()))


@pytest.mark.parametrize("name", sorted(PATTERNS))
def test_same_as_the_pattern(graph, name):
    own, want = sparql.select(graph, HEAD + PATTERNS[name]), getattr(graph_queries, name)(graph)
    assert own.columns == want.columns and sorted(map(str, own.collect())) == sorted(map(str, want.collect()))
    stored = graph_queries.Graph(graph.triples, graph.config)
    assert sorted(map(str, sparql.select(stored, HEAD + PATTERNS[name]).collect())) == sorted(map(str, want.collect()))


def test_forms(graph, tmp_path):
    (tmp_path / "q.rq").write_text(HEAD + 'SELECT DISTINCT ?l WHERE { ?l a ex:Letter ; schema:dateSent ?d ; schema:mentions ?e, ?f . ?e rdfs:label "Niš" . FILTER(?d >= "1925-01-01") } LIMIT 5')
    assert [r["l"] for r in sparql.select_file(graph, str(tmp_path / "q.rq")).collect()] == ["https://example.org/letters/letter/letter_0001"]
    assert sparql.select(graph, HEAD + "SELECT (COUNT(*) AS ?n) WHERE { ?s ?p ?o }").first()["n"] == graph.triples.select("s", "p", "o").distinct().count()
    for bad in ("SELECT ?a ?b { ?a a ex:X . ?b a ex:Y }", "SELECT ?a { ?a ^ex:p ?b }", "SELECT ?a { ?a no:p ?b }", "SELECT ?a { ?a a ex:X } HAVING", "ASK { ?a a ex:X }"):
        with pytest.raises(ValueError):
            sparql.select(graph, HEAD + bad)
