"""SQL with the results of the core's queries, for an engine that reads the same tables as views.

Regular expressions there know ASCII classes only, so spaces and digits of other kinds are spelled out.
"""

from __future__ import annotations

from quillgraph.dimensions import DROPPED_PARTS, DROPPED_SURFACES, GENITIVE_MONTHS, LINE_START_PLACES, MONTHS, PLACE_FORMS, SCHEMA_TYPES, TEXT_MONTHS
from quillgraph.operators.segment import ADDRESS, SALUTATIONS, SIGNATURES

SP = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
DG = "[0-9０-９]"
L = "(SELECT DISTINCT ON (letter_id) * FROM letters_fixed)"
LINES = f"(SELECT letter_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS seq FROM {L} WHERE text IS NOT NULL)"
ENDS = """' ,.;:()[]{}"''“”„'"""


#: Spellings of the usual sender in the test data, and the form they are given.
ALIASES = {"V. Zvelmorić": "Vukan Zvelmorić", "Zvelmorić": "Vukan Zvelmorić", "Вукан Звелморић": "Vukan Zvelmorić", "Vukana Zvelmorića": "Vukan Zvelmorić"}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{SP}+|{SP}+$')}, '', 'g')"


def light(x: str) -> str:
    return f"coalesce({strip(f'''regexp_replace(regexp_replace(translate({x}, chr(65279) || chr(65534) || chr(173), ''), '[ ' || chr(9) || ']+', ' ', 'g'), chr(10) || '{{3,}}', chr(10) || chr(10), 'g')''')}, '')"


def collapsed(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {q(SP + '+')}, ' ', 'g'), '^ | $', '', 'g')"


def canonical(x: str) -> str:
    return f"trim({collapsed(light(x))}, {ENDS})"


def surface(x: str) -> str:
    return f"trim({collapsed(f'''replace(replace({x}, '##', ''), ' - ', '-')''')}, {ENDS})"


def safe(x: str) -> str:
    return f"coalesce({strip(x)}, '')"


_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_NARROW = "".join(map(chr, range(0x21, 0x7F)))
_ROMAN = {"Ⅰ": "I", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "Ⅴ": "V", "Ⅵ": "VI", "Ⅶ": "VII", "Ⅷ": "VIII", "Ⅸ": "IX", "Ⅹ": "X", "Ⅺ": "XI", "Ⅻ": "XII", "ǈ": "Lj", "ǉ": "lj", "Ǉ": "LJ", "ǋ": "Nj", "ǌ": "nj", "Ǌ": "NJ"}


def slug(x: str) -> str:
    x = strip(f"coalesce({x}, '')")
    for a, b in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("đ", "dj"), ("Đ", "Dj")):
        x = f"replace({x}, '{a}', '{b}')"
    x = f"translate({x}, 'øåØÅ', 'oaOA')"
    for a, b in _ROMAN.items():
        x = f"replace({x}, '{a}', '{b}')"
    x = f"strip_accents(translate({x}, {q(_WIDE)}, {q(_NARROW)}))"
    x = "regexp_replace(" + x + ", '[\\x{A0}\\x{2000}-\\x{200A}\\x{202F}\\x{3000}]', ' ', 'g')"
    sp = SP[1:-1]
    x = strip("regexp_replace(" + x + ", '[^\\p{L}\\p{N}_" + sp + "-]', '', 'g')")
    return f"regexp_replace(lower(replace({x}, ' ', '_')), '_{{2,}}', '_', 'g')"


def uri_slug(x: str) -> str:
    return f"(SELECT CASE WHEN _s = '' THEN 'unknown' WHEN regexp_matches(_s, '^[0-9]') THEN 'entity_' || _s ELSE _s END FROM (SELECT {slug(x)} AS _s))"


def spans(table: str, keys: str, pattern: str, matched: str = "text") -> str:
    """Spans of a pattern in ``matched``, which has the length of ``text``, with the words of ``text``."""
    return f"""(SELECT {keys}, substring(text, s + 1, n) AS text, s AS "start", s + n AS "end" FROM (
        SELECT {keys}, text, CAST(list_sum([length(x) for x in g[1:i]]) + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0) AS BIGINT) AS s, length(m[i]) AS n FROM (
            SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT {keys}, text, regexp_extract_all({matched}, {q(pattern)}) AS m, string_split_regex({matched}, {q(pattern)}) AS g FROM {table}))))"""


_month_word = "|".join(sorted(TEXT_MONTHS, key=lambda m: (-len(m), m)))
_dates = [rf"(?i)\b\d{{1,2}}{SP}*\.{SP}*(?:[IVXLCDM]+|\d{{1,2}})(?:{SP}*\.{SP}*|{SP}+)\d{{2,4}}\b", rf"(?i)\b\d{{1,2}}{SP}*\.?{SP}+(?:{_month_word})\.?{SP}+\d{{2,4}}\b", r"\b\d{4}\b"]
_ascii = "translate(text, '０１２３４５６７８９', '0123456789')"
_texts = f"(SELECT letter_id, text FROM {L} WHERE text IS NOT NULL)"
_found = " UNION ".join(f"SELECT * FROM {spans(_texts, 'letter_id', p, _ascii)}" for p in _dates)
DATES = f"""(WITH f AS ({_found}) SELECT letter_id, {canonical('text')} AS text, 'DATE' AS label, CAST("start" AS INT) AS "start", CAST("end" AS INT) AS "end", 1.0::DOUBLE AS score, 'rule-based-date-v1' AS model FROM f
    WHERE NOT EXISTS (SELECT 1 FROM f o WHERE o.letter_id = f.letter_id AND o."start" <= f."start" AND o."end" >= f."end" AND (o."start" <> f."start" OR o."end" <> f."end")))"""

_months = "CASE " + " ".join(f"WHEN lower(trim(m, ' .,')) = '{k}' THEN {v}" for k, v in MONTHS.items()) + " END"
_place = rf"([A-ZČĆŽŠĐ][\p{{L}}\p{{N}}\p{{M}}_\-. ]{{1,40}}?)[, ]+{SP}*"
_word = "[A-Za-zČĆŽŠĐčćžšđ]+"
_heads = [
    (rf"(?i){_place}({DG}{{1,2}}){SP}*\.{SP}*([IVXLCDM]+|{_word})\.?{SP}*({DG}{{2,4}})", (1, 2, 3, 4)),
    (rf"(?i){_place}({DG}{{1,2}}){SP}+({_word}){SP}+({DG}{{2,4}})", (1, 2, 3, 4)),
    (rf"(?i)\(?{_place}({DG}{{1,2}}){SP}*\.{SP}*({DG}{{1,2}}){SP}*\.{SP}*({DG}{{2,4}})", (1, 2, 3, 4)),
    (rf"(?i)({DG}{{1,2}}){SP}*\.{SP}*([IVXLCDM]+|{DG}{{1,2}}|{_word})\.?{SP}*({DG}{{2,4}})", (0, 1, 2, 3)),
]
_nar = lambda x: f"translate({x}, '０１２３４５６７８９', '0123456789')"
_tries = " UNION ALL ".join(
    f"SELECT letter_id, {k} AS k, {f'''trim(regexp_extract(head, {q(p)}, {g[0]}), ' ,.;:()[]')''' if g[0] else 'NULL'} AS place, {_nar(f'regexp_extract(head, {q(p)}, {g[1]})')} AS d, {_nar(f'regexp_extract(head, {q(p)}, {g[2]})')} AS m, {_nar(f'regexp_extract(head, {q(p)}, {g[3]})')} AS y, regexp_extract(head, {q(p)}, 0) AS matched FROM heads"
    for k, (p, g) in enumerate(_heads)
)
HEADS = f"""(WITH heads AS (SELECT letter_id, array_to_string(list_slice(string_split(coalesce(text, ''), chr(10)), 1, 12), chr(10)) AS head FROM {L}),
    tries AS ({_tries}),
    valid AS (SELECT *, CASE WHEN regexp_matches(trim(m, ' .,'), '^[0-9]+$') THEN CASE WHEN try_cast(trim(m, ' .,') AS INT) BETWEEN 1 AND 12 THEN try_cast(trim(m, ' .,') AS INT) END ELSE {_months} END AS mon FROM tries WHERE matched <> ''),
    first AS (SELECT DISTINCT ON (letter_id) * FROM valid WHERE mon IS NOT NULL ORDER BY letter_id, k)
    SELECT h.letter_id, f.place, CASE WHEN f.mon IS NOT NULL THEN printf('%04d-%02d-%02d', CASE WHEN y::INT < 100 THEN y::INT + 1900 ELSE y::INT END, mon, d::INT) END AS date_iso, f.matched FROM heads h LEFT JOIN first f USING (letter_id))"""

_sep = rf"{SP}*[., ]{SP}*"
_header = rf"(?i)^{SP}*(?:\p{{L}}+(?: \p{{L}}+)?){SP}*[,.\-:]?{SP}+.*(?:{DG}{{1,2}}{_sep}[IVXLCDM]{{1,5}}{SP}*[., ]*{SP}*{DG}{{2,4}}|[IVXLCDM]{{1,5}}{_sep}[IVXLCDM]{{1,5}}{SP}*[., ]*{SP}*{DG}{{2,4}}|{DG}{{1,2}}{SP}+(?:{'|'.join(GENITIVE_MONTHS)}){SP}+{DG}{{4}})"
_address = "(?i)" + ADDRESS.replace(r"\s", SP)


def line_start(places: list[str]) -> str:
    """The first listed place that one of the first four lines with text begins with."""
    lines = f"list_slice(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {strip('x')}), lambda x: x <> ''), 1, 4)"
    return f"list_filter(list_transform({lines}, lambda x: regexp_extract(x, {q('^(' + '|'.join(places) + ')')}, 1)), lambda x: x <> '')[1]"


def formed(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = {q(k)} THEN {q(v)}" for k, v in PLACE_FORMS.items()) + f" ELSE {x} END"


BASE = "https://example.org/letters/"
S, D, P, K = "https://schema.org/", "http://purl.org/dc/terms/", "http://www.w3.org/ns/prov#", "http://www.w3.org/2004/02/skos/core#"
_classes = "CASE type " + " ".join(f"WHEN '{k}' THEN '{S}{v}'" for k, v in SCHEMA_TYPES.items()) + f" ELSE '{S}Thing' END"
_type_or = lambda c: f"upper(coalesce(nullif({c}, ''), 'MISC'))"
GRAPH = f"""WITH lt AS (SELECT *, {canonical('place_written')} AS pl, {canonical('sender')} AS se, {canonical('recipient')} AS re, '{BASE}letter/' || {uri_slug("coalesce(letter_id, 'letter')")} AS letter FROM {L}),
    mt0 AS (SELECT *, {canonical('text')} AS lab, {_type_or('label')} AS type FROM ner_entities),
    mt1 AS (SELECT * FROM mt0 WHERE lab <> ''),
    listed AS (SELECT {canonical('label')} AS label, {_type_or('type')} AS type, nullif(wikidata_uri, '') AS wuri, ordinal FROM ner_nel_entities WHERE {canonical('label')} <> ''),
    named AS (SELECT se AS label, 'PER' AS type, 1 AS part, 0 AS nth FROM lt UNION ALL SELECT re, 'PER', 2, 0 FROM lt UNION ALL SELECT pl, 'LOC', 3, 0 FROM lt UNION ALL SELECT lab, type, 4, ordinal FROM mt1),
    minted AS (SELECT first(label ORDER BY part, nth, label) AS label, type, lower(label) AS key FROM named WHERE label <> '' GROUP BY lower(label), type),
    every AS (SELECT label, type, wuri, ordinal FROM listed UNION ALL SELECT label, type, NULL, 0 FROM minted m WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE lower(l.label) = m.key AND l.type = m.type)),
    known AS (SELECT *, lower(label) AS key, '{BASE}entity/' || {uri_slug("type || '_' || label")} AS uri FROM (SELECT DISTINCT * FROM every)),
    idx AS (SELECT key, type, last(uri ORDER BY ordinal) AS uri FROM known GROUP BY key, type),
    ml AS (SELECT m.*, i.uri, '{BASE}letter/' || {uri_slug("coalesce(m.letter_id, 'letter')")} AS letter FROM mt1 m JOIN idx i ON lower(m.lab) = i.key AND m.type = i.type),
    t_mentions AS (SELECT DISTINCT letter, uri FROM ml),
    t_label AS (SELECT DISTINCT uri, label FROM known),
    t_dtype AS (SELECT DISTINCT uri, type FROM known),
    t_date AS (SELECT letter, date_iso AS date FROM lt WHERE date_iso <> ''),
    t_place AS (SELECT letter, i.uri FROM lt JOIN idx i ON i.key = lower(pl) AND i.type = 'LOC'),
    t_recipient AS (SELECT letter, i.uri FROM lt JOIN idx i ON i.key = lower(re) AND i.type = 'PER'),
    t_sender AS (SELECT letter, i.uri FROM lt JOIN idx i ON i.key = lower(se) AND i.type = 'PER'),
    t_class AS (SELECT DISTINCT uri, {_classes} AS class FROM known)"""


def _predicates() -> str:
    rows = [
        ("http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "1 + (SELECT count(*) FROM t_class) + 2 * (SELECT count(*) FROM lt) + (SELECT count(*) FROM ml)"),
        ("http://www.w3.org/2000/01/rdf-schema#label", "1 + (SELECT count(*) FROM t_label)"),
        (D + "source", "1 + (SELECT count(*) FROM (SELECT DISTINCT uri, wuri FROM known WHERE wuri IS NOT NULL))"),
        (D + "type", "(SELECT count(*) FROM t_dtype) + (SELECT count(*) FROM ml)"),
        (K + "exactMatch", "(SELECT count(*) FROM (SELECT DISTINCT uri, wuri FROM known WHERE wuri IS NOT NULL))"),
        (D + "isPartOf", "(SELECT count(*) FROM lt)"),
        (D + "identifier", "(SELECT count(*) FROM lt WHERE letter_id <> '')"),
        (P + "hadPrimarySource", "(SELECT count(*) FROM lt WHERE source_page_files <> '')"),
        (S + "pagination", "(SELECT count(*) FROM lt WHERE source_pages <> '')"),
        (S + "dateSent", "(SELECT count(*) FROM t_date)"),
        (S + "text", "(SELECT count(*) FROM lt WHERE text <> '')"),
        (S + "sender", "(SELECT count(*) FROM t_sender)"),
        (S + "recipient", "(SELECT count(*) FROM t_recipient)"),
        (S + "locationCreated", "(SELECT count(*) FROM t_place)"),
        (S + "mentions", "(SELECT count(*) FROM t_mentions)"),
        (BASE + "hasMention", "(SELECT count(*) FROM ml)"),
        (BASE + "mentionOf", "(SELECT count(*) FROM ml)"),
        (BASE + "mentionText", "(SELECT count(*) FROM ml)"),
        (BASE + "startOffset", '(SELECT count(*) FROM ml WHERE "start" IS NOT NULL)'),
        (BASE + "endOffset", '(SELECT count(*) FROM ml WHERE "end" IS NOT NULL)'),
        (BASE + "confidence", "(SELECT count(*) FROM ml WHERE score IS NOT NULL)"),
        (P + "wasGeneratedBy", "(SELECT count(*) FROM ml WHERE model <> '')"),
    ]
    return GRAPH + " SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{p}' AS p, CAST({n} AS BIGINT) AS n" for p, n in rows) + ") WHERE n > 0"


def _esc(x: str) -> str:
    for code, written in ((92, "chr(92) || chr(92)"), (34, "chr(92) || chr(34)"), (10, "chr(92) || 'n'"), (13, "chr(92) || 'r'"), (9, "chr(92) || 't'")):
        x = f"replace({x}, chr({code}), {written})"
    return f"chr(34) || {x} || chr(34)"


def _lines() -> str:
    """Every triple as a line of N-Triples."""
    rdf, rdfs, xsd, lang = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://www.w3.org/2000/01/rdf-schema#label", "http://www.w3.org/2001/XMLSchema#", "'@sr-Latn'"
    iri = lambda x: f"'<' || {x} || '>'"
    text = lambda x, tail="''": f"{_esc(x)} || {tail}"
    typed = lambda x, t: text(x, f"'^^<{xsd}{t}>'")
    c = f"'{BASE}collection'"
    rows = [
        ("(SELECT 1)", c, rdf, iri(f"'{S}Collection'")), ("(SELECT 1)", c, rdfs, text("'Collected letters'", lang)), ("(SELECT 1)", c, D + "source", text("'Printed edition'", lang)),
        ("t_class", "uri", rdf, iri("class")), ("t_label", "uri", rdfs, text("label", lang)), ("t_dtype", "uri", D + "type", text("type")), ("(SELECT DISTINCT uri, wuri FROM known)", "uri", K + "exactMatch", iri("wuri")), ("(SELECT DISTINCT uri, wuri FROM known)", "uri", D + "source", iri("wuri")),
        ("lt", "letter", rdf, iri(f"'{BASE}Letter'")), ("lt", "letter", rdf, iri(f"'{S}Message'")), ("lt", "letter", D + "isPartOf", iri(c)), ("lt", "letter", D + "identifier", text("nullif(letter_id, '')")), ("lt", "letter", P + "hadPrimarySource", text("nullif(source_page_files, '')")), ("lt", "letter", S + "pagination", text("nullif(source_pages, '')")),
        ("t_date", "letter", S + "dateSent", typed("date", "date")), ("lt", "letter", S + "text", text("nullif(text, '')", lang)), ("t_sender", "letter", S + "sender", iri("uri")), ("t_recipient", "letter", S + "recipient", iri("uri")), ("t_place", "letter", S + "locationCreated", iri("uri")), ("t_mentions", "letter", S + "mentions", iri("uri")),
        ("mn", "letter", BASE + "hasMention", iri("mention")), ("mn", "mention", rdf, iri(f"'{BASE}EntityMention'")), ("mn", "mention", BASE + "mentionOf", iri("uri")), ("mn", "mention", BASE + "mentionText", text("lab", lang)), ("mn", "mention", D + "type", text("type")),
        ("mn", "mention", BASE + "startOffset", typed('"start"::VARCHAR', "integer")), ("mn", "mention", BASE + "endOffset", typed('"end"::VARCHAR', "integer")), ("mn", "mention", BASE + "confidence", typed("score::VARCHAR", "float")), ("mn", "mention", P + "wasGeneratedBy", text("nullif(model, '')")),
    ]
    parts = " UNION ALL ".join(f"SELECT '<' || {s} || '> <{p}> ' || {o} || ' .' AS value FROM {t}" for t, s, p, o in rows)
    return GRAPH + f", mn AS (SELECT *, '{BASE}mention/' || {uri_slug("coalesce(letter_id, 'letter')")} || '/' || ordinal AS mention FROM ml) SELECT value FROM ({parts}) WHERE value IS NOT NULL"


_counter = lambda t, a, b, c, where="true": f"SELECT {a} AS letter_id, {strip(b)} AS text, upper(trim({c})) AS label, count(*) AS n FROM {t} WHERE upper(trim({c})) IN ('PER', 'LOC', 'ORG', 'MISC') AND {strip(b)} <> '' AND {where} GROUP BY 1, 2, 3"
BOTH = f"""b AS (SELECT letter_id, text, label, sum(g) AS g, sum(p) AS p FROM (SELECT letter_id, text, label, n AS g, 0 AS p FROM ({_counter("(SELECT CASE WHEN source_type = 'LETTER' THEN source ELSE target END AS l, CASE WHEN source_type = 'LETTER' THEN target ELSE source END AS e, CASE WHEN source_type = 'LETTER' THEN target_type ELSE source_type END AS k FROM entity_network_edges WHERE source_type = 'LETTER' OR target_type = 'LETTER')", 'l', 'e', 'k')}) UNION ALL SELECT letter_id, text, label, 0, n FROM ({_counter('ner_entities', 'letter_id', 'text', 'label')})) GROUP BY 1, 2, 3)"""
NER = f"""WITH {BOTH}, t AS (SELECT k.label AS type, coalesce(sum(g), 0) AS gold, coalesce(sum(p), 0) AS predicted, coalesce(sum(least(g, p)), 0) AS correct FROM (VALUES ('PER'), ('LOC'), ('ORG'), ('MISC')) k(label) LEFT JOIN b USING (label) GROUP BY 1),
    u AS (SELECT * FROM t UNION ALL SELECT 'micro avg.', sum(gold), sum(predicted), sum(correct) FROM t),
    s AS (SELECT *, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS precision, CASE WHEN gold > 0 THEN correct / gold ELSE 0 END AS recall FROM u),
    r AS (SELECT type, gold::BIGINT AS gold, predicted::BIGINT AS predicted, correct::BIGINT AS correct, precision::DOUBLE AS precision, recall::DOUBLE AS recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END::DOUBLE AS f1 FROM s)"""
_map = lambda t, o: f"SELECT lower(trim(label)) AS key, upper(trim(type)) AS type, last(wikidata_uri ORDER BY {o}) AS uri FROM {t} WHERE wikidata_uri <> '' GROUP BY 1, 2"
NEL = f"""WITH k AS (SELECT key, type, g.uri AS g, s.uri AS s FROM ({_map('manual_links', '1')}) g FULL JOIN ({_map('ner_nel_entities', 'ordinal')}) s USING (key, type)),
    per AS (SELECT type, count(g) AS gold, count(s) AS predicted, count(*) FILTER (g = s) AS correct, count(*) AS keys FROM k GROUP BY 1),
    u AS (SELECT x.type, coalesce(gold, 0) AS gold, coalesce(predicted, 0) AS predicted, coalesce(correct, 0) AS correct, coalesce(keys, 0) AS keys FROM (VALUES ('PER'), ('LOC'), ('ORG')) x(type) LEFT JOIN per USING (type) UNION ALL SELECT 'micro avg.', sum(gold), sum(predicted), sum(correct), sum(keys) FROM per),
    sc AS (SELECT *, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS precision, CASE WHEN gold > 0 THEN correct / gold ELSE 0 END AS recall, CASE WHEN keys > 0 THEN correct / keys ELSE 0 END AS accuracy FROM u)"""
_named = "CASE WHEN m.block IS NOT NULL THEN"
PERSONS = "(SELECT letter_id, list({'o': ordinal, 't': text, 's': \"start\"} ORDER BY ordinal) AS ps FROM ner_entities WHERE label = 'PER' AND text IS NOT NULL AND letter_id IS NOT NULL GROUP BY 1)"
_greet = rf"(?im)^{SP}*(?:Dragi|Draga|Poštovani|Poštovana){SP}+(.+?)[,!]?$"
_cap = r"[\p{L}\p{N}\p{M}_]"
_name = rf"(?:Dr\.?|Gospodica|Gospođa|Gospoda)?{SP}*([A-ZČĆŽŠĐ]{_cap}+{SP}+[A-ZČĆŽŠĐ]{_cap}+)"
RECIPIENTS = f"""WITH a AS (SELECT letter_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l, ps FROM {L} LEFT JOIN {PERSONS} USING (letter_id)),
    b AS (SELECT *, list_position(list_transform(l, lambda x: regexp_matches(x, '(?i)adresa')), true) AS pos, array_to_string(list_slice(l, 1, 12), chr(10)) AS head FROM a),
    c AS (SELECT *, CASE WHEN pos > 0 THEN array_to_string(list_slice(l, pos, pos + 7), chr(10)) END AS block, regexp_matches(head, {q(_greet)}) AS greets, {canonical(f"regexp_extract(head, {q(_greet)}, 1)")} AS tail FROM b),
    d AS (SELECT *, (SELECT p.t FROM (SELECT unnest(ps) AS p) WHERE contains(block, p.t) ORDER BY length(p.t) DESC, p.o LIMIT 1) AS longest, (SELECT p.t FROM (SELECT unnest(ps) AS p) WHERE p.s < 300 ORDER BY p.o LIMIT 1) AS near, nullif(regexp_extract(block, {q(_name)}, 1), '') AS plain FROM c)
    SELECT letter_id, coalesce(nullif(CASE WHEN block IS NOT NULL THEN coalesce(longest, CASE WHEN plain IS NOT NULL THEN {canonical('plain')} ELSE '' END) END, ''), nullif(CASE WHEN greets THEN CASE WHEN len(string_split(tail, ' ')) >= 2 AND NOT regexp_matches(tail, '(?i)gospodic|gospodj|prijatelj|vojko') THEN tail ELSE near END END, ''), 'unknown') AS recipient FROM d"""
_loc = "SELECT letter_id, list(translate(text, '–—-', '') ORDER BY ordinal) AS l FROM ner_entities WHERE label = 'LOC' AND letter_id IS NOT NULL AND text IS NOT NULL GROUP BY 1"

_joined = f"regexp_replace(array_to_string(list_filter(c, lambda x: {strip('x')} <> ''), chr(10)), {q(f'([A-Za-zÀ-žА-Яа-яЉЊЂЋЏљњђћџ]){SP}*[-‐‑]{SP}*' + chr(92) + 'n' + f'{SP}*([A-Za-zÀ-žА-Яа-яЉЊЂЋЏљњђћџ])')}, '\\1\\2', 'g')"
_letter_text = light(f"nfc_normalize({_joined})")
_body = rf"(?i)(^|[^\p{{L}}\p{{N}}_])({'|'.join(SALUTATIONS + SIGNATURES)})([^\p{{L}}\p{{N}}_]|$)"
# a line begins a letter by what the lines before it in its letter are, so lines follow each other
SEGMENTS = f"""WITH RECURSIVE n AS (SELECT coalesce(source_page_files, chr(0)) AS pf, try_cast(string_split(source_pages, ';')[1] AS INT) AS page, letter_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS seq FROM {L} WHERE text IS NOT NULL),
    o AS (SELECT pf, page, text, row_number() OVER (PARTITION BY pf ORDER BY letter_id, seq) AS i FROM n),
    f AS (SELECT *, length({light('text')}) <= 160 AND regexp_matches({light('text')}, {q(_header)}) AS head, coalesce(max(regexp_matches({light('text')}, {q(_address)})::INT) OVER (PARTITION BY pf ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 0) = 1 AS follows FROM o),
    r AS (SELECT pf, i, [text] AS c, [page] AS pages, 1 AS seg FROM f WHERE i = 1
        UNION ALL SELECT pf, i, CASE WHEN s THEN [text] ELSE list_append(c, text) END, CASE WHEN s THEN [page] ELSE list_append(pages, page) END, seg + s::INT FROM (
            SELECT f.pf, f.i, f.text, f.page, r.c, r.pages, r.seg, f.head AND NOT (len(r.c) <= 3 AND NOT b) AND NOT (b AND f.follows) AS s FROM (SELECT *, regexp_matches({_letter_text}, {q(_body)}) AS b FROM r) r JOIN f ON f.pf = r.pf AND f.i = r.i + 1)),
    g AS (SELECT pf, seg, max_by(c, i) AS c, max_by(pages, i) AS pages FROM r GROUP BY 1, 2),
    t AS (SELECT *, {_letter_text} AS text FROM g),
    k AS (SELECT nullif(pf, chr(0)) AS page_file, row_number() OVER (PARTITION BY pf ORDER BY seg) AS letter_no, pages, array_to_string(list_filter(c[1:8], lambda x: {strip('x')} <> ''), ' | ') AS raw_header, text FROM t WHERE text <> '')"""
JSONLD = f"""SELECT s, '{{"@id": "' || s || '", ' || string_agg(m, ', ' ORDER BY m) || '}}' AS node FROM (
    SELECT s, '"' || p || '": [' || string_agg(v, ', ' ORDER BY v) || ']' AS m FROM (
        SELECT s, CASE WHEN p = 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' THEN '@type' ELSE p END AS p, CASE WHEN p = 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' THEN '"' || rest[2:-2] || '"' WHEN rest[1] = '<' THEN '{{"@id":"' || rest[2:-2] || '"}}'
            WHEN tail[1:1] = '@' THEN '{{"@language":"' || tail[2:] || '","@value":' || said || '}}' WHEN tail[1:1] = '^' THEN '{{"@type":"' || tail[4:-2] || '","@value":' || said || '}}' ELSE '{{"@value":' || said || '}}' END AS v FROM (
            SELECT *, regexp_extract(rest, '(?s)^(".*")[^"]*$', 1) AS said, regexp_extract(rest, '(?s)^".*"([^"]*)$', 1) AS tail FROM (
                SELECT regexp_extract(value, '^<([^>]*)>', 1) AS s, regexp_extract(value, '^<[^>]*> <([^>]*)>', 1) AS p, regexp_extract(value, '(?s)^<[^>]*> <[^>]*> (.*) \\.$', 1) AS rest FROM ({_lines()}))))
    GROUP BY s, p) GROUP BY s"""

ORACLES: dict[str, str] = {
    "segment_letters": SEGMENTS + " SELECT page_file, CAST(letter_no AS INT) AS letter_no, coalesce(page_file, '') AS source_page_files, raw_header, text FROM k",
    "stored_letters": SEGMENTS + " SELECT printf('letter_%04d', row_number() OVER (ORDER BY page_file NULLS FIRST, letter_no)) AS letter_id, coalesce(page_file, '') AS source_page_files, array_to_string(list_sort(list_transform(list_distinct(list_filter(pages, lambda x: x IS NOT NULL)), lambda x: x::VARCHAR)), ';') AS source_pages, raw_header, text FROM k",
    "jsonld_nodes": JSONLD,
    "tagger_mentions": f"SELECT * FROM (SELECT ordinal, letter_id, {canonical("nfc_normalize(CASE WHEN m.\"start\" >= 0 AND m.\"end\" > m.\"start\" AND m.\"end\" <= length(l.t) THEN substring(l.t, m.\"start\" + 1, m.\"end\" - m.\"start\") ELSE replace(m.text, '##', '') END)")} AS text, upper(coalesce(nullif(label, ''), 'MISC')) AS label, \"start\", \"end\", score, 'tagger-v1' AS model FROM ner_entities m LEFT JOIN (SELECT letter_id, text AS t FROM {L}) l USING (letter_id)) WHERE length(text) >= 2 AND score >= 0.6",
    "recognised_mentions": f"""SELECT * FROM {DATES} UNION SELECT letter_id, w.text, 'LOC', CAST(w."start" AS INT), CAST(w."end" AS INT), 1.0::DOUBLE, 'gazetteer-v1' FROM {spans(_texts, 'letter_id', '[' + chr(92) + 'p{L}' + chr(92) + 'p{M}]+')} w JOIN (SELECT DISTINCT label FROM manual_links WHERE type = 'LOC') d ON d.label = w.text""",
    "text_normalize": f"SELECT letter_id, {light('nfc_normalize(text)')} AS text_norm FROM letters_fixed",
    "dehyphenate": f"SELECT letter_id, regexp_replace(coalesce(text, ''), {q(f'([A-Za-zÀ-žА-Яа-яЉЊЂЋЏљњђћџ]){SP}*[-‐‑]{SP}*' + chr(92) + 'n' + f'{SP}*([A-Za-zÀ-žА-Яа-яЉЊЂЋЏљњђћџ])')}, '\\1\\2', 'g') AS text_joined FROM letters_fixed",
    "canonical_label": f"SELECT ordinal, {canonical('nfc_normalize(text)')} AS label, {surface('text')} AS surface, {safe('letter_id')} AS letter FROM ner_entities",
    "slug": f"SELECT name, {slug('name')} AS slug, {uri_slug('name')} AS uri_slug FROM (SELECT type || '_' || label AS name FROM manual_links UNION ALL SELECT p_name FROM part UNION ALL SELECT o_orderkey::VARCHAR FROM orders)",
    "date_normalize": """SELECT o_orderkey, form, CASE WHEN form <> 'none' THEN CASE WHEN form = 'word' THEN strftime(o_orderdate, '%Y-10-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END END AS date_iso, CAST(1900 + CAST(strftime(o_orderdate, '%y') AS INT) AS INT) AS year FROM orders, (VALUES ('numeric'), ('roman'), ('dotted'), ('none'), ('word')) f(form)""",
    "date_spans": f"SELECT * FROM {DATES}",
    "place_date_header": f"SELECT * FROM {HEADS}",
    "place_repair": f"SELECT letter_id, coalesce({formed(f'''nullif(nullif({strip('place_written')}, ''), 'nan')''')}, {line_start(['Gornji', 'Novi', 'Stari', 'Нови', 'Стари'])}) AS place FROM {L}",
    "header_lines": f"SELECT letter_id, seq::INT AS seq, text FROM {LINES} WHERE length({light('text')}) <= 160 AND regexp_matches({light('text')}, {q(_header)})",
    "address_lookahead": f"SELECT letter_id, seq::INT AS seq, text FROM (SELECT *, max(regexp_matches({light('text')}, {q(_address)})::INT) OVER (PARTITION BY letter_id ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS a FROM {LINES}) WHERE a = 1",
    "page_markup": f"SELECT l.letter_id || '.xml' AS page_file, try_cast(nullif(regexp_extract(source_page_files, '[0-9]+'), '') AS INT) AS page_number, 'r1' AS region_id, 'l' || seq AS line_id, {light('nfc_normalize(l.text)')} AS text FROM {LINES} l JOIN {L} f USING (letter_id) WHERE {light('nfc_normalize(l.text)')} <> ''",
    "page_spec": "SELECT source_pages, CAST(unnest(list_concat(range(CAST(string_split(source_pages, ';')[1] AS INT), CAST(string_split(source_pages, ';')[-1] AS INT) + 1), [3])) AS INT) AS page FROM (SELECT DISTINCT source_pages FROM letters_fixed WHERE source_pages IS NOT NULL)",
    "wordpiece_merge": """SELECT ordinal, text, label, "start", "end", score FROM ner_entities""",
    "wordpiece_merge_inference": """WITH r AS (SELECT *, coalesce(label <> 'DATE' AND length(text) > 3 AND "end" - "start" > 3, false) AND label = 'LOC' AS apart FROM ner_entities)
        SELECT ordinal * 2 AS ordinal, text AS word, label AS tag, "start", "end", score FROM r WHERE NOT coalesce(apart, false) UNION ALL SELECT ordinal * 2, text[1:2], label, "start", "start" + 2, score FROM r WHERE apart UNION ALL SELECT ordinal * 2 + 1, '##' || substring(text, 3), label, "start" + 3, "end", score FROM r WHERE apart""",
    "contained_spans": """WITH r AS (SELECT ordinal, letter_id, text, label, "start", "end" FROM ner_entities UNION ALL SELECT ordinal, letter_id, right(text, 4), label, "end" - 4, "end" FROM ner_entities WHERE label = 'DATE' AND length(text) > 4 AND "start" IS NOT NULL)
        SELECT * FROM r WHERE NOT (label = 'DATE' AND EXISTS (SELECT 1 FROM r o WHERE o.label = 'DATE' AND o.letter_id = r.letter_id AND o."start" <= r."start" AND o."end" >= r."end" AND length(o.text) > length(r.text)))""",
    "drop_filter": f"SELECT ordinal, surface, label FROM (SELECT *, {surface('text')} AS surface FROM ner_entities) WHERE surface <> '' AND letter_id <> '' AND score >= 0.6 AND length(surface) >= 2 AND surface NOT IN ({', '.join(map(q, DROPPED_SURFACES))}) AND NOT ({' OR '.join(f'contains(surface, {q(p)})' for p in DROPPED_PARTS)}) AND NOT (label IN ('PER', 'LOC', 'ORG') AND length(surface) <= 2) AND NOT starts_with(surface, '##')",
    "alias_normalize": f"SELECT ordinal, coalesce(f.g, w) AS given_name, alias FROM (SELECT ordinal, string_split({surface('text')}, ' ')[1] AS w, CASE {surface('text')} {' '.join(f'WHEN {q(k)} THEN {q(v)}' for k, v in ALIASES.items())} ELSE {surface('text')} END AS alias FROM ner_entities WHERE label = 'PER') LEFT JOIN (SELECT short_form, min(given_name) AS g FROM given_name_forms GROUP BY 1) f ON w = short_form",
    "split_merged": f"""WITH a AS ({_loc}), e AS (SELECT letter_id, len(l) AS n, i, l[i] AS e, l FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM a)),
        m AS (SELECT letter_id, n, i, e, CASE WHEN i > 1 THEN ' ' ELSE '' END || e || CASE WHEN i < n THEN ' ' ELSE '' END AS m FROM e),
        p AS (SELECT *, coalesce(sum(length(m) + 1) OVER (PARTITION BY letter_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM m),
        c AS (SELECT *, {surface('m')} AS clean, length(m) - length(regexp_replace(m, {q(f'^{SP}+')}, '')) AS lead FROM p)
        SELECT letter_id, CASE WHEN n = 1 THEN e ELSE clean END AS text, 'LOC' AS label, CAST(5 + pos + CASE WHEN n = 1 THEN 0 ELSE lead END AS INT) AS "start", CAST(5 + pos + CASE WHEN n = 1 THEN length(e) ELSE lead + length(clean) END AS INT) AS "end" FROM c WHERE n = 1 OR clean <> ''""",
    "mention_union_dedupe": f"""SELECT letter_id, text, label, "start", "end", min(ordinal) AS ordinal FROM (SELECT letter_id, text, label, "start", "end", ordinal FROM ner_entities WHERE label <> 'DATE' UNION ALL SELECT letter_id, text, label, "start", "end", 1099511627776 FROM {DATES}) GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5"),
    "gazetteer_mentions": f"""SELECT letter_id, w.text, 'LOC' AS label, CAST(w."start" AS INT) AS "start", CAST(w."end" AS INT) AS "end", 1.0::DOUBLE AS score, 'gazetteer-v1' AS model FROM {spans(_texts, 'letter_id', '[' + chr(92) + 'p{L}' + chr(92) + 'p{M}]+')} w JOIN (SELECT DISTINCT label FROM manual_links WHERE type = 'LOC') d ON d.label = w.text""",
    "clean_mentions": f"""WITH r AS (SELECT * FROM ner_entities WHERE "start" IS NOT NULL AND "end" IS NOT NULL AND letter_id IS NOT NULL),
        d AS (SELECT *, {surface('text')} AS t FROM r WHERE NOT (label = 'DATE' AND EXISTS (SELECT 1 FROM r o WHERE o.label = 'DATE' AND o.letter_id = r.letter_id AND o."start" <= r."start" AND o."end" >= r."end" AND length(o.text) > length(r.text))))
        SELECT min(ordinal) AS ordinal, letter_id, t AS text, label, "start", "end", model FROM d WHERE t NOT IN ({', '.join(map(q, DROPPED_SURFACES))}) AND NOT ({' OR '.join(f'contains(t, {q(p)})' for p in DROPPED_PARTS)}) AND NOT (label IN ('PER', 'LOC', 'ORG') AND length(t) <= 2) AND NOT starts_with(t, '##') GROUP BY letter_id, t, label, "start", "end", model""",
    "recipient_inference": RECIPIENTS,
    "letter_enrich": f"SELECT h.letter_id, 'Vukan Zvelmorić' AS sender, 'Darinka Stolburić' AS recipient, h.date_iso, coalesce({formed('''nullif(nullif(h.place, ''), 'nan')''')}, {formed(line_start(LINE_START_PLACES))}) AS place_written, h.matched AS date_header_match FROM {HEADS} h JOIN {L} USING (letter_id)",
    "entity_table": f"SELECT first(label ORDER BY ordinal) AS label, type, count(*) AS mention_count FROM (SELECT {canonical('text')} AS label, upper(coalesce(label, 'MISC')) AS type, ordinal FROM ner_entities) WHERE label <> '' GROUP BY lower(label), type",
    "entity_link": f"""WITH e AS (SELECT first(label ORDER BY ordinal) AS label, type, count(*) AS mention_count FROM (SELECT {canonical('text')} AS label, upper(coalesce(label, 'MISC')) AS type, ordinal FROM ner_entities) WHERE label <> '' GROUP BY lower(label), type),
        d AS (SELECT lower({canonical('label')}) AS k, upper(type) AS type, max(wikidata_uri) AS u FROM manual_links WHERE type <> 'PER' GROUP BY 1, 2), a AS (SELECT lower(label) AS k, min(wikidata_uri) AS u FROM manual_links WHERE type = 'PER' GROUP BY 1), b AS (SELECT lower(label) AS k, min(wikidata_uri) AS u FROM manual_links WHERE type = 'LOC' GROUP BY 1)
        SELECT e.label, e.type, mention_count, coalesce(d.u, CASE WHEN e.type IN ('PER', 'LOC', 'ORG', 'WORK', 'PUBLICATION') THEN coalesce(a.u, b.u) END) AS wikidata_uri FROM e LEFT JOIN d ON lower(e.label) = d.k AND e.type = d.type LEFT JOIN a ON lower(e.label) = a.k LEFT JOIN b ON lower(e.label) = b.k""",
    "triples_by_predicate": _predicates(),
    "triple_lines": _lines(),
    "q_letters_by_date": GRAPH + " SELECT l.letter, d.date, pl.label AS place_label, rl.label AS recipient_label FROM lt l LEFT JOIN t_date d USING (letter) LEFT JOIN (SELECT letter, label FROM t_place JOIN t_label USING (uri)) pl USING (letter) LEFT JOIN (SELECT letter, label FROM t_recipient JOIN t_label USING (uri)) rl USING (letter)",
    "q_mentioned_persons": GRAPH + f" SELECT uri AS person, label, count(*) AS mentions FROM t_mentions JOIN (SELECT letter FROM lt) USING (letter) JOIN t_label USING (uri) WHERE uri IN (SELECT uri FROM t_class WHERE class = '{S}Person') GROUP BY 1, 2",
    "q_letters_places": GRAPH + f" SELECT m.letter, d.date, pl.label AS written_place_label, t.label AS mentioned_place_label FROM t_mentions m JOIN (SELECT letter FROM lt) USING (letter) JOIN t_label t USING (uri) LEFT JOIN t_date d USING (letter) LEFT JOIN (SELECT letter, label FROM t_place JOIN t_label USING (uri)) pl USING (letter) WHERE uri IN (SELECT uri FROM t_class WHERE class = '{S}Place')",
    "q_entity_network": GRAPH + " SELECT letter, uri AS entity, label, type FROM t_mentions JOIN (SELECT letter FROM lt) USING (letter) JOIN t_label USING (uri) JOIN t_dtype USING (uri)",
    "network_edges": f"""SELECT source, target, 'LETTER' AS source_type, coalesce(nullif(listed, ''), nullif(own, ''), 'ENTITY') AS target_type, CAST(count(*) AS BIGINT) AS weight FROM (SELECT {safe('letter_id')} AS source, {safe('text')} AS target, {safe('label')} AS own FROM ner_entities) LEFT JOIN (SELECT {safe('label')} AS target, last({safe('type')} ORDER BY ordinal) AS listed FROM ner_nel_entities GROUP BY 1) USING (target) WHERE source <> '' AND target <> '' GROUP BY 1, 2, 4""",
    "node_degree": f"""WITH k AS (SELECT ordinal, {safe('source')} AS a, {safe('target')} AS b, coalesce(nullif({safe('source_type')}, ''), 'LETTER') AS ta, coalesce(nullif({safe('target_type')}, ''), 'ENTITY') AS tb FROM entity_network_edges),
        h AS (SELECT a AS node, b AS other, ta AS t, ordinal * 2 AS o FROM k WHERE a <> '' AND b <> '' UNION ALL SELECT b, a, tb, ordinal * 2 + 1 FROM k WHERE a <> '' AND b <> '')
        SELECT node, last(t ORDER BY o, t) AS node_type, count(DISTINCT other) AS degree, count(*) AS row_degree, 1100 + 120 * count(DISTINCT other) AS size, 18 + least(3 * count(*), 30) AS html_size FROM h GROUP BY 1""",
    "drawn_edges": f"""SELECT a AS source, b AS target, last(w ORDER BY ordinal) AS weight, greatest(0.6, least(3.0, last(w ORDER BY ordinal)))::DOUBLE AS width FROM (SELECT ordinal, least({safe('source')}, {safe('target')}) AS a, greatest({safe('source')}, {safe('target')}) AS b, coalesce(weight, 1) AS w FROM entity_network_edges) WHERE a <> '' AND b <> '' GROUP BY 1, 2""",
    "ner_metrics": NER + " SELECT type, gold, predicted, correct, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM r",
    "metric_lines": NER + " SELECT type, gold, predicted, correct, printf('%.3f', precision) AS precision, printf('%.3f', recall) AS recall, printf('%.3f', f1) AS f1 FROM r",
    "ner_errors": f"WITH {BOTH} SELECT 'FN' AS error_type, letter_id, text, label, CAST(g - p AS BIGINT) AS n FROM b WHERE g > p UNION ALL SELECT 'FP', letter_id, text, label, CAST(p - g AS BIGINT) FROM b WHERE p > g",
    "nel_metrics": NEL + " SELECT type, gold::BIGINT AS gold, predicted::BIGINT AS predicted, correct::BIGINT AS correct, round(precision, 6)::DOUBLE AS precision, round(recall, 6)::DOUBLE AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6)::DOUBLE AS f1, round(accuracy, 6)::DOUBLE AS accuracy FROM sc",
    "nel_errors": NEL + " SELECT 'FN' AS error_type, key AS label, type, g AS wikidata_uri FROM k WHERE g IS NOT NULL AND g IS DISTINCT FROM s UNION ALL SELECT 'FP', key, type, s FROM k WHERE s IS NOT NULL AND g IS DISTINCT FROM s",
    "link_coverage": "SELECT round((SELECT count(*) FROM ner_nel_entities) / (SELECT count(*) FROM manual_links), 6) AS coverage",
    "label_histogram": "SELECT label, count(*) AS n FROM ner_entities GROUP BY 1",
    "word_spans": f"""SELECT wikidata_uri, text, CAST("start" AS INT) AS "start", CAST("end" AS INT) AS "end" FROM {spans('(SELECT wikidata_uri, label AS text FROM manual_links)', 'wikidata_uri', '[' + chr(92) + 'p{L}]+')}""",
}
