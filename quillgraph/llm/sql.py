"""SQL with the results of some queries, for an engine that reads the same tables.

Compatibility decomposition is spelled out there for full-width forms, spaces, Roman numerals and digraphs.
"""

from __future__ import annotations

from quillgraph.llm.refine import LATIN_SMALL, OTHER_SMALL
from quillgraph.llm.skeleton import _TABLE

# Signs that stand for several letters.
SEVERAL = {"Ⅷ": "VIII", "Ⅶ": "VII", "Ⅻ": "XII", "Ⅲ": "III", "Ⅵ": "VI", "Ⅳ": "IV", "Ⅸ": "IX", "Ⅺ": "XI", "Ⅱ": "II", "Ⅰ": "I", "Ⅴ": "V", "Ⅹ": "X", "ⅷ": "viii", "ⅶ": "vii", "ⅻ": "xii", "ⅲ": "iii", "ⅵ": "vi", "ⅳ": "iv", "ⅸ": "ix", "ⅺ": "xi", "ⅱ": "ii", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x", "ǈ": "Lj", "ǉ": "lj", "Ǉ": "LJ", "ǋ": "Nj", "ǌ": "nj", "Ǌ": "NJ"}
_FORMAT = "­​‌‍⁠﻿"
_SPACES = " " + "".join(map(chr, range(0x2000, 0x200B))) + "  　"
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_NARROW = "".join(map(chr, range(0x21, 0x7F)))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def form(x: str) -> str:
    """The printed form of a text."""
    x = f"translate({x}, {_q(_WIDE + _SPACES + _FORMAT)}, {_q(_NARROW + ' ' * len(_SPACES))})"
    for a, b in SEVERAL.items():
        x = f"replace({x}, '{a}', '{b}')"
    return f"translate(nfc_normalize({x}), {_q(''.join(map(chr, _TABLE)))}, {_q(''.join(_TABLE.values()))})"


def key(x: str) -> str:
    """Words and numbers in order, or the printed form of a text without any."""
    small = f"translate(lower({x}), '{OTHER_SMALL}', '{LATIN_SMALL}')"
    folded = f"translate(lower({form(small)}), '{OTHER_SMALL}', '{LATIN_SMALL}')"
    return rf"(SELECT CASE WHEN len(_w) > 0 THEN array_to_string(_w, ' ') ELSE chr(1) || _f END FROM (SELECT _f, regexp_extract_all(_f, '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}\p{{M}}]*') AS _w FROM (SELECT {folded} AS _f)))"


_pairs = lambda tab, scope, text: f"SELECT DISTINCT '{tab}' AS tab, a.ordinal AS ordinal_a, b.ordinal AS ordinal_b FROM {tab}_f a JOIN {tab}_f b ON {' AND '.join(f'a.{s} = b.{s}' for s in scope)} AND a.f = b.f AND a.{text} <> b.{text} AND a.ordinal < b.ordinal"
_copies = lambda tab: f"SELECT DISTINCT '{tab}' AS tab, m AS ordinal_a, ordinal AS ordinal_b FROM (SELECT ordinal, min(ordinal) OVER (PARTITION BY letter_id, kind, k) AS m FROM {tab}_k) WHERE ordinal <> m"
_mentions = f"ner_entities_k AS (SELECT ordinal, letter_id, label AS kind, {key('text')} AS k FROM ner_entities WHERE letter_id IS NOT NULL AND label IS NOT NULL AND text IS NOT NULL)"
_swap = "target_type = 'LETTER' AND coalesce(source_type, '') <> 'LETTER'"
_edges = f"""e AS (SELECT ordinal, CASE WHEN {_swap} THEN target ELSE source END AS letter_id, CASE WHEN {_swap} THEN source_type ELSE target_type END AS kind, CASE WHEN {_swap} THEN source ELSE target END AS entity FROM entity_network_edges WHERE source_type = 'LETTER' OR target_type = 'LETTER'),
    entity_network_edges_k AS (SELECT ordinal, letter_id, kind, {key('entity')} AS k FROM e WHERE letter_id IS NOT NULL AND kind IS NOT NULL AND entity IS NOT NULL)"""

ORACLES: dict[str, str] = {
    "p4_found": f"WITH ner_entities_f AS (SELECT *, {form('text')} AS f FROM ner_entities), ner_nel_entities_f AS (SELECT *, {form('label')} AS f FROM ner_nel_entities) {_pairs('ner_entities', ['letter_id', 'label'], 'text')} UNION ALL {_pairs('ner_nel_entities', ['type'], 'label')}",
    "p4_forms": f"SELECT ordinal, {form('label')} AS form FROM ner_nel_entities",
    "p6_found": f"WITH {_mentions}, {_edges} {_copies('ner_entities')} UNION ALL {_copies('entity_network_edges')}",
    "p6_collapsed": f"WITH {_mentions}, g AS (SELECT min(ordinal) AS ordinal, count(*) AS n_copies FROM ner_entities_k GROUP BY letter_id, kind, k) SELECT ordinal, n_copies FROM g UNION ALL SELECT ordinal, 1 FROM ner_entities WHERE letter_id IS NULL OR label IS NULL OR text IS NULL",
    "p4_table_forms": f"SELECT 'ner_entities' AS tab, ordinal, {form('text')} AS form FROM ner_entities UNION ALL SELECT 'ner_nel_entities', ordinal, {form('label')} FROM ner_nel_entities",
    "p6_records": f"""WITH {_mentions}, {_edges}, g AS (SELECT 'ner_entities' AS tab, min(ordinal) AS ordinal, count(*) AS n_copies FROM ner_entities_k GROUP BY letter_id, kind, k UNION ALL SELECT 'entity_network_edges', min(ordinal), count(*) FROM entity_network_edges_k GROUP BY letter_id, kind, k)
        SELECT * FROM g UNION ALL SELECT 'ner_entities', ordinal, 1 FROM ner_entities WHERE letter_id IS NULL OR label IS NULL OR text IS NULL
        UNION ALL SELECT 'entity_network_edges', ordinal, 1 FROM entity_network_edges WHERE ordinal NOT IN (SELECT ordinal FROM entity_network_edges_k)""",
}
