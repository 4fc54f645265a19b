"""Queries of this subpackage by name; each takes a session and a dataset folder and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm import gazetteer, language, names, ocr, packing, refine, residue, skeleton, tokenize
from quillgraph.session import read_table


def p1_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Every name of a person or organisation and the entity it stands for."""
    return names.entities(read_table(spark, folder, "ner_entities"), read_table(spark, folder, "letters_fixed"), read_table(spark, folder, "given_name_forms"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of names that stand for the same person or organisation."""
    return names.variant_pairs(p1_entities(spark, folder)).distinct()


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of the letters whose label is missing or wrong or whose text has several."""
    return language.wrong_or_mixed(read_table(spark, folder, "letters_fixed"), read_table(spark, folder, "letter_intake"))


def p2_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every letter's passages with their languages and confidence, one row each."""
    letters = read_table(spark, folder, "letters_fixed")
    dictionaries = language.fit(language.sampled(letters, read_table(spark, folder, "letter_intake"), "letter_id", "text", "lang_label"))
    found = language.passages(letters, dictionaries)
    return found.select("letter_id", F.posexplode("passages").alias("passage_no", "p")).select("letter_id", "passage_no", "p.start", "p.end", "p.lang", "p.confidence", "p.sentences", "p.rejected")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the entity table whose link is not one of the list as it stands, with the URI meant or ''."""
    return gazetteer.canonical_links(read_table(spark, folder, "ner_nel_entities"), read_table(spark, folder, "manual_links"), read_table(spark, folder, "given_name_forms"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that look the same and are different strings."""
    mentions = skeleton.look_same_pairs(read_table(spark, folder, "ner_entities"), ["letter_id", "label"], "ordinal", "text")
    entities = skeleton.look_same_pairs(read_table(spark, folder, "ner_nel_entities"), ["type"], "ordinal", "label")
    return mentions.select(F.lit("ner_entities").alias("tab"), "*").unionByName(entities.select(F.lit("ner_nel_entities").alias("tab"), "*"))


def p4_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Every entity label in its one consistent form."""
    return skeleton.same_form(read_table(spark, folder, "ner_nel_entities"), "label").select("ordinal", "form")


def p4_table_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Every mention and every entity label in its one consistent form."""
    mentions = skeleton.spelled_forms(read_table(spark, folder, "ner_entities"), "ordinal", "text")
    entities = skeleton.spelled_forms(read_table(spark, folder, "ner_nel_entities"), "ordinal", "label")
    return mentions.select(F.lit("ner_entities").alias("tab"), "*").unionByName(entities.select(F.lit("ner_nel_entities").alias("tab"), "*"))


def edge_entities(edges: DataFrame) -> DataFrame:
    """(ordinal, letter_id, entity_type, entity) of edges, whichever end the letter is at; of two letter ends the target is the entity."""
    at_target = F.col("target_type") == "LETTER"
    swapped = at_target & (F.coalesce(F.col("source_type"), F.lit("")) != "LETTER")
    pick = lambda a, b: F.when(swapped, F.col(a)).otherwise(F.col(b))
    return edges.where("source_type = 'LETTER' OR target_type = 'LETTER'").select("ordinal", pick("target", "source").alias("letter_id"), pick("source_type", "target_type").alias("entity_type"), pick("source", "target").alias("entity"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """What scanning left in each line of the letters' text and header."""
    letters = read_table(spark, folder, "letters_fixed")
    editor = ocr.fit(letters, read_table(spark, folder, "ner_entities"))
    return ocr.noise(letters.where("letter_id is not null"), editor).distinct()


def p5_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Every letter as continuous paragraphs."""
    letters = read_table(spark, folder, "letters_fixed")
    return ocr.repaired(letters, ocr.fit(letters, read_table(spark, folder, "ner_entities")))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Copies hidden by formatting, each with the smallest ordinal of its group."""
    mentions = refine.copies(read_table(spark, folder, "ner_entities"), ["letter_id", "label"], "ordinal", "text")
    edges = refine.copies(edge_entities(read_table(spark, folder, "entity_network_edges")), ["letter_id", "entity_type"], "ordinal", "entity")
    return mentions.select(F.lit("ner_entities").alias("tab"), "*").unionByName(edges.select(F.lit("entity_network_edges").alias("tab"), "*"))


def p6_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    """One record for each group of mentions, with the number of its copies."""
    return refine.collapsed(read_table(spark, folder, "ner_entities"), ["letter_id", "label"], "ordinal", "text")


def p6_records(spark: SparkSession, folder: str) -> DataFrame:
    """One record for each group of mentions and of edges, with the number of its copies; an edge without a letter stands alone."""
    edges = read_table(spark, folder, "entity_network_edges")
    apart = edges.where("NOT coalesce(source_type = 'LETTER' OR target_type = 'LETTER', false)").select("ordinal", F.lit(1).cast("bigint").alias("n_copies"))
    linked = refine.collapsed(edge_entities(edges), ["letter_id", "entity_type"], "ordinal", "entity").unionByName(apart)
    return p6_collapsed(spark, folder).select(F.lit("ner_entities").alias("tab"), "*").unionByName(linked.select(F.lit("entity_network_edges").alias("tab"), "*"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return tokenize.token_ids(read_table(spark, folder, "documents"))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces and their containers, for each kind of container."""
    sizes = tokenize.token_sizes(read_table(spark, folder, "documents"))
    return packing.pack(sizes, read_table(spark, folder, "container_sizes"))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Containers of each kind against the least number by volume."""
    return packing.fill(p8_containers(spark, folder), read_table(spark, folder, "container_sizes"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with template residue, filler, error pages or notices."""
    return residue.residue(read_table(spark, folder, "documents")).distinct()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_entities, p2_found, p2_passages, p3_found, p4_found, p4_forms, p4_table_forms, p5_found, p5_repaired, p6_found, p6_collapsed, p6_records, p7_ids, p8_containers, p8_fill, p9_found)}
