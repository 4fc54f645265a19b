"""Explicit schemas of the relations; missing values are null."""

from __future__ import annotations





#: DDL of each relation, parsed by Spark where it is used.
PAGE_LINES = "page_file string, page_number int, region_id string, line_id string, seq bigint, text string"
LETTERS = "letter_id string, source_page_files string, source_pages string, raw_header string, text string, sender string, recipient string, date_iso string, place_written string, date_header_match string"
MENTIONS = "letter_id string, text string, label string, start int, end int, score double, model string"
ENTITIES = "entity_id string, label string, type string, wikidata_uri string, mention_count bigint"
EDGES = "source string, target string, source_type string, target_type string, weight bigint"
TRIPLES = "s string, p string, o string, o_kind string, datatype string, lang string"
LINKS = "label string, type string, wikidata_uri string"
