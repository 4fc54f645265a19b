"""Settings of a corpus, with the defaults the pipeline runs on."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Config:
    base_uri: str = "https://example.org/letters/"
    collection_id: str = "collection"
    collection_label: str = "Collected letters"
    source_label: str = "Printed edition"
    language: str = "sr-Latn"
    keep_text: bool = True
    default_sender: str = ""
    default_recipient: str = ""
    #: Spellings of the author that sign a letter, as a pattern; none by default.
    author_pattern: str = ""
    min_score: float = 0.60
    lookup_enabled: bool = True
    lookup_types: tuple[str, ...] = ("PER", "LOC", "ORG", "WORK", "PUBLICATION")
    split_letters: bool = True
    places: tuple[str, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, nested: dict[str, Any]) -> Config:
        """From a nested mapping, as a YAML file gives; unknown keys are left alone."""
        project, extraction, linking, ner = (nested.get(k) or {} for k in ("project", "extraction", "linking", "ner"))
        known = {"base_uri": project.get("base_uri"), "collection_id": project.get("collection_id"), "collection_label": project.get("collection_label"), "source_label": project.get("source_label"), "language": project.get("language"),
                 "keep_text": extraction.get("keep_transcription_text_in_rdf"), "default_sender": extraction.get("default_sender"), "default_recipient": extraction.get("default_recipient"), "split_letters": extraction.get("split_letters"),
                 "min_score": ner.get("min_score"), "lookup_enabled": linking.get("enable_wikidata_lookup")}
        return cls(**{k: v for k, v in known.items() if v is not None})

    @classmethod
    def from_yaml(cls, path: str) -> Config:
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f) or {})
