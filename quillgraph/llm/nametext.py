"""Names as typed, brought to comparable words: one alphabet, no accents, small letters."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import regex

from quillgraph.llm.skeleton import LOOK_ALIKES, skeleton

# Serbian Cyrillic letters and their Latin spelling.
CYRILLIC = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "ђ": "đ", "е": "e", "ж": "ž", "з": "z", "и": "i", "ј": "j", "к": "k", "л": "l", "љ": "lj", "м": "m", "н": "n", "њ": "nj", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "ћ": "ć", "у": "u", "ф": "f", "х": "h", "ц": "c", "ч": "č", "џ": "dž", "ш": "š", "і": "i", "ѕ": "s", "й": "j", "ы": "y", "э": "e", "ю": "ju", "я": "ja", "щ": "šč", "ъ": "", "ь": "", "ё": "e", "ї": "i", "є": "e"}
_TO_LATIN = str.maketrans(CYRILLIC | {k.upper(): v.capitalize() for k, v in CYRILLIC.items()})
_LOOKS_CYRILLIC = {latin: other for other, latin in LOOK_ALIKES.items() if "Ѐ" <= other <= "ӿ" and other.lower() in CYRILLIC}
_TO_CYRILLIC = str.maketrans(_LOOKS_CYRILLIC)
_LOOKED_LATIN = {c for c in LOOK_ALIKES if "Ѐ" <= c <= "ӿ"}
_STROKES = str.maketrans({"đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ø": "o", "ß": "ss", "æ": "ae"})
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*\.?|\p{N}+\.?|,|\(")


def _one_alphabet(word: str) -> str:
    """A word in Latin letters: look-alikes of the other alphabet first become letters of the word's own."""
    cyrillic = [c for c in word if "Ѐ" <= c <= "ӿ"]
    if not cyrillic:
        return skeleton(word)
    latin = [c for c in word if c.isalpha() and not "Ѐ" <= c <= "ӿ"]
    if any(c not in _LOOKED_LATIN for c in cyrillic) and all(skeleton(c)[0] in _LOOKS_CYRILLIC for c in latin):
        return "".join(c if "Ѐ" <= c <= "ӿ" else skeleton(c).translate(_TO_CYRILLIC) for c in word).translate(_TO_LATIN)
    return skeleton(word) if latin else word.translate(_TO_LATIN)


@lru_cache(200_000)
def latin(text: str) -> str:
    """``text`` in composed Latin letters, without format characters and with plain spaces."""
    plain = unicodedata.normalize("NFC", unicodedata.normalize("NFKD", "".join(c for c in text if unicodedata.category(c) != "Cf")))
    words = regex.split(r"(\s+)", plain)
    return unicodedata.normalize("NFC", "".join(w if not w.strip() else _one_alphabet(w) for w in words))


def fold(text: str) -> str:
    """Small letters without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", text.lower().translate(_STROKES)) if not unicodedata.combining(c))


def words(text: str) -> list[str]:
    """Folded words; an abbreviation keeps its full stop, commas and opening brackets stay as words; dj, which also spells đ, is d."""
    return [fold(w).replace("dj", "d") for w in _WORD.findall(latin(text))]


def written(name: str) -> dict[str, str]:
    """Folded words as they are written in small Latin letters, where the name has accents at all: a name without may have lost them."""
    plain = latin(name).lower()
    if plain.isascii():
        return {}
    return {fold(w).replace("dj", "d"): w for w in regex.findall(r"\p{L}[\p{L}\p{M}]*", plain)}


def distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or ``most`` + 1 if it is above ``most``; bit-parallel over the columns of the table."""
    if a == b:
        return 0
    m, n = len(a), len(b)
    if abs(m - n) > most or not m or not n:
        return max(m, n) if max(m, n) <= most else most + 1
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << m - 1
    up, down, d = full, 0, m
    for c in b:
        eq = place.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up) & full, up & xh
        if ph & last:
            d += 1
        elif mh & last:
            d -= 1
        ph = (ph << 1 | 1) & full
        up, down = ((mh << 1) & full) | ~(xv | ph) & full, ph & xv
    return d if d <= most else most + 1


def one_slip(a: str, b: str) -> bool:
    """Whether one letter too many, too few or wrong, or two neighbours that changed places, make ``b`` of ``a``."""
    if a == b:
        return True
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


#: What the distance of far strings is taken for; a metric cut off at a bound is a metric too.
FAR = 64


def _laid(keys: list[str], alphabet: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(letters of each key by number, lengths); letters that are new get a number."""
    sizes = np.array([len(k) for k in keys], np.int64)
    out = np.zeros((len(keys), int(sizes.max(initial=0))), np.int32)
    for row, key in zip(out, keys):
        row[: len(key)] = [alphabet.setdefault(c, len(alphabet) + 1) for c in key]
    return out, sizes


def edit_distances(a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray, letters: int) -> np.ndarray:
    """Unrestricted Damerau-Levenshtein distance of each pair of rows, all pairs side by side; FAR if it is FAR or more."""
    out = np.full(len(a), FAR, np.int64)
    near = np.flatnonzero(np.abs(a_size - b_size) < FAR)
    order = near[np.argsort(np.maximum(a_size[near], b_size[near]), kind="stable")]
    at = 0
    while at < len(order):
        # as many pairs as fit into a table of bounded size
        step = max(1, 20_000_000 // ((int(max(a_size[order[at:]].max(), b_size[order[at:]].max())) + 2) ** 2 * 2))
        own = order[at : at + step]
        at += step
        x, y, n, m = a[own], b[own], a_size[own], b_size[own]
        p, every = len(own), np.arange(len(own))
        rows, columns = int(n.max(initial=0)), int(m.max(initial=0))
        d = np.full((rows + 2, columns + 2, p), 30_000, np.int16)
        d[1:, 1] = np.arange(rows + 1, dtype=np.int16)[:, None]
        d[1, 1:] = np.arange(columns + 1, dtype=np.int16)[:, None]
        # the last row in which each letter stood
        row_of = np.zeros((letters + 1, p), np.int32)
        for i in range(1, rows + 1):
            last = np.zeros(p, np.int32)
            for j in range(1, columns + 1):
                same = x[:, i - 1] == y[:, j - 1]
                k = row_of[y[:, j - 1], every]
                swapped = d[k, last, every] + (i + j - 1 - k - last).astype(np.int16)
                d[i + 1, j + 1] = np.minimum(np.minimum(d[i, j] + ~same, np.minimum(d[i + 1, j], d[i, j + 1]) + np.int16(1)), swapped)
                last[same] = j
            row_of[x[:, i - 1], every] = i
        out[own] = np.minimum(d[n + 1, m + 1, every], FAR)
    return out


class BkTree:
    """Strings under Damerau-Levenshtein distance; a search leaves out subtrees by the triangle inequality and returns every entry within the radius.

    Built and searched level by level, all pairs of a level in one table. A string of more
    than LONGEST letters is near nothing but itself.
    """

    LONGEST = 256

    def __init__(self, keys: list[str]):
        own = list(dict.fromkeys(keys))
        self.long = {k for k in own if len(k) > self.LONGEST}
        self.key = [k for k in own if k not in self.long]
        self.alphabet: dict[str, int] = {}
        self.codes, self.sizes = _laid(self.key, self.alphabet)
        n = len(self.key)
        # every key hangs below a node until it is one itself
        edge, parent = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        left = np.arange(1, n)
        under = np.zeros(len(left), np.int64)
        while len(left):
            d = self._between(under, left)
            order = np.lexsort((left, d, under))
            left, under, d = left[order], under[order], d[order]
            first = np.concatenate([[True], (under[1:] != under[:-1]) | (d[1:] != d[:-1])])
            made = left[first]
            parent[made], edge[made] = under[first], d[first]
            under = made[np.cumsum(first) - 1]
            left, under = left[~first], under[~first]
        # children of a node side by side
        self.child = np.argsort(parent, kind="stable")[1 if n else 0 :]
        self.edge = edge[self.child]
        self.start = np.searchsorted(parent[self.child], np.arange(n + 1))

    def _between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return edit_distances(self.codes[a], self.sizes[a], self.codes[b], self.sizes[b], len(self.alphabet))

    def within(self, keys: list[str], most: int) -> list[list[tuple[int, str]]]:
        """For each key every entry within ``most`` edits, as (distance, entry), nearest first."""
        out: list[list[tuple[int, str]]] = [[(0, k)] if k in self.long else [] for k in keys]
        longest = int(self.sizes.max(initial=0))
        asked = [i for i, k in enumerate(keys) if self.key and len(k) <= longest + most]
        codes, sizes = _laid([keys[i] for i in asked], self.alphabet)
        at, node = np.arange(len(asked)), np.zeros(len(asked), np.int64)
        while len(at):
            d = edit_distances(codes[at], sizes[at], self.codes[node], self.sizes[node], len(self.alphabet))
            for i in np.flatnonzero(d <= most):
                out[asked[at[i]]].append((int(d[i]), self.key[node[i]]))
            n = self.start[node + 1] - self.start[node]
            again = np.repeat(np.arange(len(at)), n)
            place = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[node], n)
            # a distance that was cut off may be any greater one
            far = d[again]
            kept = (np.abs(self.edge[place] - far) <= most) | ((far >= FAR) & (self.edge[place] >= FAR - most))
            at, node = at[again[kept]], self.child[place[kept]]
        return [sorted(x) for x in out]
