"""Template residue, filler and error pages, by character n-gram models.

Three kinds of text are modelled by counts of character 4-grams in hashed tables of
fixed size: residue (filler, error messages, notices, navigation), unfilled slots, and
natural prose. Residue starts from a few general seeds, prose from all texts of the
corpus; every text is scored, what scores as residue joins the residue and leaves the
prose, and the models are fitted again until no text changes sides. A text is scored by
the log likelihood ratios of its 4-grams; windows of WINDOW characters whose sum is above
a threshold are residue, and a document is excluded if they cover at least COVERAGE of it.

A slot is localised by the window of any length whose ratio is greatest. Its 4-grams are
counted twice, as characters and as shapes (every letter one sign), against prose and
against the marks that editors set in prose, which are learnt as the marked strings that
recur in the corpus. A document with a window above SLOT_THRESHOLD is excluded.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.session import checkpointed

#: Counts of a corpus of more documents are brought to those of so many, so that smoothing, seeds and caps weigh the same at every size.
WEIGHT_DOCUMENTS = 6000
WINDOW, THRESHOLD = 28, 9.0
COVERAGE = 0.55
#: Coverage from which a text joins the residue while the models are still rough.
JOIN_COVERAGE = 0.4
SLOT_THRESHOLD = 12.0
#: A marked string in at least this share of the documents, and MARK_LEAST of them, is an editor's mark.
MARK_SHARE, MARK_LEAST = 0.004, 5
#: A 4-gram of letters alone says at most this much for a slot.
PLAIN_MOST = 2.0
_BITS, _GRAM = 20, 4
_PAD = WINDOW + _GRAM
#: Characters looked at together, so few that their arrays stay in a processor's cache.
_PART = 64_000

# General filler, notices and navigation in the languages of the corpus, for the first fit.
FILLER = [
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.",
    "This is placeholder text for the page layout; real content will be added soon.", "Sample text, replace it with your own.", "Testing, testing, one two three.", "blah blah, foo bar baz, asdf qwerty",
    "Ovo je probni tekst koji služi samo za izgled strane. Pravi sadržaj će biti dodat kasnije.", "Ovde unesite svoj tekst.", "Primer sadržaja, zameniti pravim.", "proba, test, tekst, naslov, pasus",
    "Dies ist ein Blindtext für das Layout; der echte Inhalt folgt später.", "Hier Ihren Text einfügen.", "Beispieltext, bitte ersetzen.",
    "Ceci est un texte provisoire pour la mise en page; le vrai contenu viendra plus tard.", "Insérez votre texte ici.", "Texte d'exemple, remplacez-le.",
    "Questo è un testo di esempio per l'impaginazione; il contenuto arriverà più tardi.", "Inserire qui il testo.", "Testo segnaposto, sostituirlo.",
    "To jest przykładowy tekst, właściwa treść zostanie dodana później.", "Tutaj wstaw swój tekst.", "Wpisz tu krótki opis.",
    "Это пример текста, настоящее содержание появится позже.", "Вставьте сюда свой текст.", "Описание будет добавлено.",
]
NOTICES = [
    "404 Not Found. The requested URL was not found on this server.", "500 Internal Server Error. Please try again later or contact the administrator.", "502 Bad Gateway", "503 Service Unavailable. The server is overloaded or down for maintenance.", "403 Forbidden. You do not have permission to access this page.",
    "Your session has expired. Please log in again.", "The connection was refused or timed out (error code 12).", "Too many requests, slow down.", "Unhandled exception at line 12: null pointer, index out of range, key not found.", "Enable JavaScript and cookies in your browser to continue.", "This site requires a modern browser that supports scripts.",
    "Checking that you are not a robot, please wait a few seconds.", "Accept cookies to view this content.", "Oops, something went wrong. If the problem continues, contact support and quote this reference number.",
    "Stranica koju tražite nije pronađena. Vratite se na početnu.", "Greška na serveru. Pokušajte kasnije.", "Pristup odbijen, nemate dozvolu. Prijavite se.", "Uključite JavaScript i kolačiće u pregledaču da biste videli sadržaj.", "Sesija je istekla, prijavite se ponovo.", "Veza sa bazom nije uspela. Osvežite stranicu.", "Vaš pregledač nije podržan. Dozvolite skripte.",
    "Die angeforderte Seite wurde nicht gefunden. Fehler 404.", "Interner Serverfehler, versuchen Sie es später noch einmal.", "Der Dienst ist vorübergehend nicht erreichbar.", "Aktivieren Sie JavaScript und Cookies in Ihrem Browser, um die Seite anzuzeigen.", "Zugriff verweigert, bitte melden Sie sich an.",
    "La page demandée n'a pas été trouvée. Erreur 404.", "Erreur interne du serveur, réessayez plus tard.", "Le service est temporairement indisponible.", "Activez JavaScript et les cookies dans votre navigateur pour afficher la page.", "Accès interdit, veuillez vous connecter.",
    "La pagina richiesta non è stata trovata. Errore 404.", "Errore del server, riprovare più tardi.", "Abilitare JavaScript e i cookie nel browser per visualizzare la pagina.", "Accesso non consentito, effettuare il login.",
    "Strona, której szukasz, nie została znaleziona. Błąd 404.", "Wewnętrzny błąd serwera, spróbuj później.", "Włącz JavaScript i ciasteczka w przeglądarce, aby wyświetlić stronę.", "Dostęp zabroniony, zaloguj się.",
    "Запрашиваемая страница не найдена. Ошибка 404.", "Внутренняя ошибка сервера, попробуйте позже.", "Включите JavaScript и файлы cookie в браузере, чтобы открыть страницу.", "Доступ закрыт, войдите снова.",
]
NAVIGATION = ["Home | About | Contact | Search | Login", "Početna · O nama · Pretraga · Prijava", "Start > Archiv > Suche > Hilfe", "Accueil | Recherche | Aide", "© All rights reserved. Powered by"]
# Names that fields of a letter or record commonly have.
FIELDS = (
    "name surname first_name last_name full_name date place city street address country sender recipient title subject text body content number phone email signature year author page "
    "ime prezime datum mesto grad ulica adresa pošiljalac primalac naslov tekst broj potpis godina autor strana nachname vorname ort straße anschrift absender empfänger betreff titel nummer "
    "nom prénom lieu ville rue adresse expéditeur destinataire titre objet texte numéro nome cognome data luogo città mittente destinatario titolo oggetto testo numero imię nazwisko miejsce miasto nadawca odbiorca tytuł treść "
    "имя фамилия дата место город отправитель получатель адресат тема текст номер подпись име презиме датум пошиљалац прималац наслов број"
).split()
# Signs that template languages and forms set around a field.
SLOT_FORMS = [
    "{{%s}}", "{{ %s }}", "{%s}", "{%% %s %%}", "{%% if %s %%}", "<%%= %s %%>", "<%% %s %%>", "<<%s>>", "«%s»", "[[%s]]", "[%s]", "<%s>", "${%s}", "#{%s}", "$%s$", "%%%s%%", "@@%s@@", "__%s__", "____ (%s)", "{0} {1} %s:{2}", "todo: %s", "xxx %s xxx",
    "[insert %s here]", "[enter %s]", "[your %s]", "<your %s>", "<enter: %s>", "[%s here]", "[uneti %s]", "[upisati %s]", "<unesite: %s>", "[vaš %s]", "[%s ovde]", "[ihr %s]", "<ihr %s>", "[%s eintragen]", "[votre %s]", "<votre %s>", "[insérer %s]", "[il tuo %s]", "[inserire %s]", "[twój %s]", "[wpisz %s]", "[ваш %s]", "[вставить %s]",
]
#: Something between signs that prose has few of: what may be an editor's mark if it recurs.
_MARKED = re.compile(r"[\[{<«$#%@_|]+[^\[\]{}<>«»\n]{0,40}?[\]}>»$%@_|]+")
#: Shapes: letters are one sign, digits another, all else is itself.
_LETTER, _DIGIT, _RUN, _SIGN = 97, 48, 1, 2
_COMMON = np.array([0, _LETTER, _DIGIT, *map(ord, " \n\t.,;:!?'\"()-–—„”“’")], np.uint32)
_SHAPES = np.array([_LETTER if chr(i).isalpha() else _DIGIT if chr(i).isdigit() else i for i in range(0x600)], np.uint32)


def _codes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((c >= 48) & (c <= 57), np.uint32(48), c)


def _shapes(c: np.ndarray) -> np.ndarray:
    """Shapes of characters; a letter that stands three times in a row is a sign like others."""
    shape = np.where(c < len(_SHAPES), _SHAPES[np.minimum(c, len(_SHAPES) - 1)], np.uint32(_LETTER))
    run = (c[2:] == c[1:-1]) & (c[1:-1] == c[:-2]) & (shape[2:] == _LETTER)
    for k in range(3):
        shape[k : len(shape) - 2 + k][run] = _RUN
    return shape


def _grams(c: np.ndarray) -> np.ndarray:
    """Hashes of the 4-grams that start at each place."""
    if len(c) < _GRAM:
        return np.zeros(0, np.uint32)
    h = c[:-3] * np.uint32(2654435761)
    h ^= c[1:-2] * np.uint32(2246822519)
    h += c[2:-1] * np.uint32(3266489917)
    h ^= c[3:] * np.uint32(668265263)
    h *= np.uint32(2654435761)
    return h >> np.uint32(32 - _BITS)


def _counts(texts: list[str], of=_codes) -> np.ndarray:
    # in parts, as the lists may be long
    out, part, size = np.zeros(1 << _BITS), [], 0
    for t in [*texts, None]:
        if t is None or size > 4_000_000:
            out += np.bincount(_grams(of(("\0" * 3).join(["", *part, ""]))), minlength=1 << _BITS)
            part, size = [], 0
        if t is not None:
            part.append(t)
            size += len(t)
    return out


def _shape_codes(text: str) -> np.ndarray:
    return _shapes(_codes(text))


def _rough(shape: np.ndarray) -> np.ndarray:
    """Shapes with one sign for all but letters, digits, spaces and common punctuation."""
    return np.where(np.isin(shape, _COMMON), shape, np.uint32(_SIGN))


def _rough_codes(text: str) -> np.ndarray:
    return _rough(_shape_codes(text))


def _ratio(of: np.ndarray, against: np.ndarray, marks: np.ndarray | None = None) -> np.ndarray:
    """Log likelihood ratio of each 4-gram, smoothed, against the likelier of prose and marks; a 4-gram unknown to all says little."""
    a, b = of.sum() + 1, against.sum() + 1
    own = np.log((of + 0.02 * a / b + 1e-4) / a)
    r = own - np.log((against + 0.3) / b)
    if marks is not None and marks.any():
        r = np.minimum(r, np.where(marks > 0, own - np.log((marks + 0.3) / (marks.sum() + 1)), np.inf))
    r = np.where((of == 0) & (against == 0), -0.2, r)
    return np.clip(r, -5, 4).astype(np.float32)


def _single_less(counts: np.ndarray) -> np.ndarray:
    """Counts in which a 4-gram met once weighs what Good and Turing estimate for it, from the numbers of those met once and twice."""
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return np.where(counts == 1, 2 * twice / once, counts) if 0 < 2 * twice < once else counts


def _shape_ratio(own: np.ndarray, against: np.ndarray, editors: np.ndarray) -> np.ndarray:
    """Ratios of shapes; a shape unknown to all is null, so that rough shapes, in which every sign is the same, decide."""
    fine = _ratio(own, against, editors)
    fine[(own == 0) & (against == 0) & (editors == 0)] = np.nan
    return fine


@dataclass(frozen=True)
class ResidueModel:
    """Ratios of residue's 4-grams, and of slots' by character and by shape."""

    residue: np.ndarray
    slot: np.ndarray
    slot_shape: np.ndarray
    slot_rough: np.ndarray
    window: int = WINDOW
    threshold: float = THRESHOLD
    coverage: float = COVERAGE
    slot_threshold: float = SLOT_THRESHOLD

    def coverages(self, texts: list[str]) -> np.ndarray:
        """Share of each text's characters, without white space, that residue windows cover."""
        c, starts, sizes = _laid(texts)
        score = np.concatenate([[0.0], np.cumsum(self.residue[_grams(c)], dtype=np.float64)])
        w = self.window
        hot = (score[w:] - score[:-w]) > self.threshold
        sums = np.concatenate([np.zeros(w + 1), np.cumsum(hot)])
        covered = np.zeros(len(c), bool)
        covered[: len(sums) - w] = (sums[w:] - sums[:-w]) > 0
        # a window covers its last 4-gram whole, but ends at the text's own end
        solid = (c > 32) & (c != 160)
        inside = np.concatenate([[0], np.cumsum(covered & solid)])
        all_ = np.concatenate([[0], np.cumsum(solid)])
        ends = starts + sizes
        return (inside[ends] - inside[starts]) / np.maximum(1, all_[ends] - all_[starts])

    def slot_scores(self, texts: list[str]) -> np.ndarray:
        """The greatest ratio that any window of each text has for a slot."""
        if not texts:
            return np.zeros(0)
        # a slot that begins a text has a space before it, as those it is held against
        c, starts, sizes = _laid([" " + t if t else t for t in texts])
        g, shape = _grams(c), _shapes(c)
        plain = (shape == _LETTER) | (shape == 32) | (shape == _DIGIT)
        plain = plain[:-3] & plain[1:-2] & plain[2:-1] & plain[3:]
        x = self.slot[g]
        fine = self.slot_shape[_grams(shape)]
        unknown = np.flatnonzero(np.isnan(fine))
        if len(unknown):
            fine[unknown] = self.slot_rough[_grams(_rough(shape))[unknown]]
        x = np.where(plain, np.minimum(x, PLAIN_MOST), x) + fine
        # a line of one sign is one sign
        x[1:][(g[1:] == g[:-1]) & (x[1:] > 0)] = 0
        # between texts nothing goes on
        x[c[: len(x)] == 0] = np.minimum(x[c[: len(x)] == 0], -5)
        total = np.cumsum(x, dtype=np.float64)
        best = total - np.minimum.accumulate(np.concatenate([[0.0], total]))[:-1]
        # the end of the text before is far enough away to be forgotten
        return np.where(sizes > 0, np.maximum.reduceat(best, np.minimum(starts, len(best) - 1)), 0.0)

    def excluded(self, lowered: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(coverage, whether there is a slot) of each text in small letters."""
        return self.coverages(lowered), self.slot_scores(lowered) > self.slot_threshold


def _laid(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts one after another, apart by more than a window; the start and size of each."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + _PAD)[:-1]]) + _PAD if len(texts) else sizes
    return _codes("\0" * _PAD + ("\0" * _PAD).join(texts) + "\0" * _PAD), starts, sizes


@dataclass(frozen=True)
class _Corpus:
    """What a fit asks of all texts that are not blank, in small letters.

    ``grams`` are the counts of their 4-grams as characters, shapes and rough shapes, ``marked`` the texts that have each marked
    string, all or those of editors' marks; ``residues`` gives the counts of 4-grams of the texts that a model covers by JOIN_COVERAGE and by COVERAGE.
    """

    size: int
    grams: np.ndarray
    marked: Mapping[str, int]
    residues: Callable[[ResidueModel], np.ndarray]


def _parts(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts that are not blank, in small letters, about _PART characters at a time."""
    part, size = [], 0
    for t in texts:
        if t and not t.isspace():
            part.append(t.lower())
            size += len(t) + _PAD
        if size >= _PART:
            yield part
            part, size = [], 0
    if part:
        yield part


def _joined(part: list[str]) -> np.ndarray:
    return _codes(("\0" * 3).join(["", *part, ""]))


def _add_grams(part: list[str], into: np.ndarray) -> None:
    """Add the 4-grams of a part as characters, shapes and rough shapes."""
    c = _joined(part)
    shape = _shapes(c)
    for k, x in enumerate((c, shape, _rough(shape))):
        np.add.at(into[k], _grams(x), 1)


def _add_residues(part: list[str], model: ResidueModel, into: np.ndarray) -> None:
    """Add the 4-grams of the texts of a part that a model covers by each of the two coverages."""
    coverage = model.coverages(part)
    for k, least in enumerate((JOIN_COVERAGE, COVERAGE)):
        found = [t for t, x in zip(part, coverage >= least) if x]
        if found:
            np.add.at(into[k], _grams(_joined(found)), 1)


def _marked(part: list[str]) -> Iterator[str]:
    for t in part:
        yield from set(_MARKED.findall(re.sub(r"\d", "0", t)))


def _no_counts(kinds: int) -> np.ndarray:
    return np.zeros((kinds, 1 << _BITS), np.int64)


def _of_texts(texts: list[str]) -> _Corpus:
    parts = list(_parts(texts))
    grams = _no_counts(3)
    for part in parts:
        _add_grams(part, grams)

    def residues(model: ResidueModel) -> np.ndarray:
        out = _no_counts(2)
        for part in parts:
            _add_residues(part, model, out)
        return out

    return _Corpus(sum(map(len, parts)), grams, Counter(w for part in parts for w in _marked(part)), residues)


_COUNTED = "kind int, gram int, mark string, n bigint"
_COUNTED_ARROW = pa.schema([("kind", pa.int32()), ("gram", pa.int32()), ("mark", pa.string()), ("n", pa.int64())])
#: Kinds of counts after the three of 4-grams.
_MARK, _TEXTS = 3, 4


def _count_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for kind, of in enumerate(counts):
        at = np.flatnonzero(of)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.nulls(len(at), pa.string()), pa.array(of[at])], schema=_COUNTED_ARROW)


def _mark_rows(marks: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([_MARK] * len(marks), pa.int32()), pa.nulls(len(marks), pa.int32()), pa.array(list(marks), pa.string()), pa.array(list(marks.values()), pa.int64())], schema=_COUNTED_ARROW)


def _summed(counted: DataFrame, kinds: int) -> np.ndarray:
    """Counts of 4-grams by kind: tables of fixed size, whatever the corpus."""
    got, out = counted.where(F.col("kind") < kinds).select("kind", "gram", "n").toArrow(), _no_counts(kinds)
    out[got["kind"].to_numpy(), got["gram"].to_numpy()] = got["n"].to_numpy()
    return out


def _of_rows(df: DataFrame, text_col: str) -> _Corpus:
    rows = df.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    total = F.sum("n").alias("n")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, marks, n = _no_counts(3), Counter(), 0
        for batch in batches:
            for part in _parts(batch.column(0).to_pylist()):
                _add_grams(part, grams)
                marks.update(_marked(part))
                n += len(part)
                if len(marks) > 100_000:
                    yield _mark_rows(marks)
                    marks = Counter()
        yield from _count_rows(grams)
        yield _mark_rows(marks)
        yield pa.RecordBatch.from_arrays([pa.array([_TEXTS], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()), pa.array([n], pa.int64())], schema=_COUNTED_ARROW)

    counted = checkpointed(rows.mapInArrow(count, _COUNTED).groupBy("kind", "gram", "mark").agg(total))
    size = sum(r["n"] for r in counted.where(F.col("kind") == _TEXTS).collect())
    # each is in a share of the texts, so their number does not grow with the corpus
    marked = {r["mark"]: r["n"] for r in counted.where((F.col("kind") == _MARK) & (F.col("n") >= _mark_least(size))).collect()}

    def residues(model: ResidueModel) -> np.ndarray:
        none = np.zeros(0, np.float32)
        shared = df.sparkSession.sparkContext.broadcast(replace(model, slot=none, slot_shape=none, slot_rough=none))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, out = shared.value, _no_counts(2)
            for batch in batches:
                for part in _parts(batch.column(0).to_pylist()):
                    _add_residues(part, own, out)
            yield from _count_rows(out)

        out = _summed(rows.mapInArrow(count, _COUNTED).groupBy("kind", "gram").agg(total), 2)
        shared.destroy()
        return out

    return _Corpus(size, _summed(counted, 3), marked, residues)


def _key(counts: np.ndarray) -> bytes:
    return hashlib.sha256(counts.tobytes()).digest()


def _mark_least(size: int) -> float:
    return max(MARK_LEAST, MARK_SHARE * size)


def _mark_counts(marked: Mapping[str, int], of) -> np.ndarray:
    """Counts of the 4-grams of marks, each as often as it was met."""
    out = np.zeros(1 << _BITS)
    for w, n in marked.items():
        np.add.at(out, _grams(of(f"\0\0\0 {w} \0\0\0")), n)
    return out


def _fitted(corpus: _Corpus, seeds: list[str] | None, forms: list[str] | None, fields: list[str] | None) -> ResidueModel:
    weight = min(1.0, WEIGHT_DOCUMENTS / max(1, corpus.size))
    seeded = _counts([s.lower() for s in (seeds or FILLER + NOTICES + NAVIGATION)])
    slots = [(" " + f % n + " ").lower() for f, n in product(forms or SLOT_FORMS, fields or FIELDS)]
    marks = {w: n for w, n in corpus.marked.items() if n >= _mark_least(corpus.size)}
    own = [(_single_less(_counts(slots, of)), prose * weight, _mark_counts(marks, of) * weight) for of, prose in zip((_codes, _shape_codes, _rough_codes), corpus.grams)]
    slot = _ratio(*own[0]), _shape_ratio(*own[1]), _ratio(*own[2])
    base = corpus.grams[0]
    model, fitted = ResidueModel(_ratio(seeded, base * weight), *slot), b""
    # each round takes in what was found, first generously; ends when the same is found again, and at the latest when all that can be found has been
    least, seen = 0, set()
    while True:
        both = corpus.residues(model)
        if least == 0 and _key(both[0]) in seen:
            least, seen = 1, {fitted}
        residue, key = both[least], _key(both[least])
        if key in seen:
            return model
        seen.add(key)
        fitted = key
        model = ResidueModel(_ratio(seeded + np.minimum(residue * weight, 50), np.maximum(base - residue, 0) * weight), *slot)


def fit(texts: list[str], seeds: list[str] | None = None, forms: list[str] | None = None, fields: list[str] | None = None) -> ResidueModel:
    """The models from texts and the seeds."""
    return _fitted(_of_texts(texts), seeds, forms, fields)


def fit_rows(df: DataFrame, text_col: str = "text", seeds: list[str] | None = None, forms: list[str] | None = None, fields: list[str] | None = None) -> ResidueModel:
    """The same models from all texts of a table, each counted; the table is read once for the counts and once a round."""
    return _fitted(_of_rows(df, text_col), seeds, forms, fields)


def scored(df: DataFrame, model: ResidueModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, coverage DOUBLE, has_slot BOOLEAN) of every row, in one pass without a shuffle.

    A null, empty or blank text has coverage 0 and no slot; repeated rows each come out.
    """
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                part, size, first = [], 0, at
                while at < len(texts) and (not part or size < _PART):
                    part.append(texts[at] or "")
                    size += len(part[-1]) + _PAD
                    at += 1
                lowered = [t.lower() for t in part]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, at - first), *map(pa.array, own.excluded(lowered))], ["id", "coverage", "has_slot"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, coverage double, has_slot boolean").withColumnRenamed("id", id_col)


def residue(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id): the rows to exclude."""
    model = fit_rows(df, text_col)
    return scored(df, model, id_col, text_col).where((F.col("coverage") >= model.coverage) | F.col("has_slot")).select(id_col)
