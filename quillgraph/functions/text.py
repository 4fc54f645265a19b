"""Scalar functions on text. Each takes a column (or its name) and gives a column; null in, null out unless said."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgraph.functions.arrow import mapped

#: Signs that are no part of a label's ends.
LABEL_ENDS = " ,.;:()[]{}\"'“”„"
_LETTER = r"[A-Za-zÀ-žА-Яа-яЉЊЂЋЏљњђћџ]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Blocks of Latin, Cyrillic, marks, punctuation and full-width forms: what is folded by a table made from Unicode's own rules.
_BLOCKS = [(0x00, 0x250), (0x300, 0x370), (0x400, 0x530), (0x1E00, 0x1F00), (0x2000, 0x2070), (0xFF01, 0xFF5F)]


def _folds() -> tuple[str, str, str, str]:
    """(characters, what each becomes, characters that go, characters that become several), for marks dropped after compatibility decomposition."""
    one, to, gone, several = [], [], [], []
    for a, b in _BLOCKS:
        for c in map(chr, range(a, b)):
            r = _unmarked(c)
            if r == c:
                continue
            if len(r) == 1:
                one.append(c)
                to.append(r)
            else:
                (several if r else gone).append(c)
    return "".join(one), "".join(to), "".join(gone), "".join(several)


def _nfc(text: str) -> str:
    return unicodedata.normalize("NFC", text)


def _unmarked(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


_ONE, _TO, _GONE, _SEVERAL = _folds()
_INSIDE = "".join(f"\\x{{{a:x}}}-\\x{{{b - 1:x}}}" for a, b in _BLOCKS)
_ODD = f"[^{_INSIDE}]|[{_SEVERAL}]"
#: Composed text of these blocks is in normal form unless a mark follows a letter.
_MAY_COMPOSE = "[\\x{300}-\\x{36f}]|[^\\x{0}-\\x{2ff}\\x{370}-\\x{52f}\\x{1e00}-\\x{1eff}\\x{2010}-\\x{2070}\\x{ff01}-\\x{ff5e}]"


def light(c: Column | str) -> Column:
    """``normalized`` of text that is composed already, wholly in built-in functions."""
    plain = F.translate(col(c), "﻿￾­", "")
    spaced = F.regexp_replace(F.regexp_replace(plain, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.coalesce(F.regexp_replace(spaced, r"(?U)^\s+|\s+$", ""), F.lit(""))


def normalized(c: Column | str) -> Column:
    """Composed form without byte order marks and soft hyphens, blanks and blank lines collapsed; null becomes empty."""
    # only text that may not be composed yet goes through Python
    composed = mapped(_nfc, F.when(col(c).rlike(_MAY_COMPOSE), col(c)))
    return light(F.coalesce(composed, col(c)))


def dehyphenated(c: Column | str) -> Column:
    """Words cut at a line end by a hyphen put together; dashes stay."""
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), rf"({_LETTER})(?U)\s*[-‐‑]\s*\n\s*(?-U)({_LETTER})", "$1$2")


def collapsed(c: Column | str) -> Column:
    """White space as single spaces, none at the ends."""
    return F.regexp_replace(F.regexp_replace(col(c), r"(?U)\s+", " "), r"^ | $", "")


def canonical(c: Column | str) -> Column:
    """A label in normal form, without punctuation at its ends."""
    return F.trim(collapsed(normalized(c)), F.lit(LABEL_ENDS))


def canonical_composed(c: Column | str) -> Column:
    """``canonical`` of text that is composed already."""
    return F.trim(collapsed(light(c)), F.lit(LABEL_ENDS))


def surface(c: Column | str) -> Column:
    """A mention as it is compared: no continuation marks, tight dashes, no punctuation at its ends."""
    return F.trim(collapsed(F.replace(F.replace(col(c), F.lit("##"), F.lit("")), F.lit(" - "), F.lit("-"))), F.lit(LABEL_ENDS))


def safe(c: Column | str) -> Column:
    """Null as empty, no white space at the ends."""
    return F.coalesce(F.regexp_replace(col(c), r"(?U)^\s+|\s+$", ""), F.lit(""))


def slug(c: Column | str, separator: str = "_") -> Column:
    """Small letters without accents, words joined by the separator, other signs dropped."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)^\s+|\s+$", "")
    for wide, plain in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("đ", "dj"), ("Đ", "Dj")):
        text = F.replace(text, F.lit(wide), F.lit(plain))
    text = F.translate(text, "øåØÅ", "oaOA")
    # only text with other characters than the table has goes through Python
    text = F.coalesce(mapped(_unmarked, F.when(text.rlike(_ODD), text)), F.translate(text, _ONE + _GONE, _TO))
    text = F.regexp_replace(F.regexp_replace(text, r"(?U)[^\p{L}\p{N}_\s-]", ""), r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(F.lower(F.replace(text, F.lit(" "), F.lit(separator))), f"{separator}{{2,}}", separator)


def uri_slug(c: Column | str, prefix: str = "entity") -> Column:
    """A slug that can stand in a URI: never empty, never a digit first."""
    s = slug(c)
    return F.when(s == "", "unknown").when(s.rlike(r"^\d"), F.concat(F.lit(f"{prefix}_"), s)).otherwise(s)


def aliased(c: Column | str, aliases: dict[str, str]) -> Column:
    """The canonical form of a surface by exact look-up in a small table, else itself."""
    if not aliases:
        return col(c)
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col(c)), col(c))
