"""Corpus encoding with a byte-level BPE vocabulary, by a tokenization automaton.

The automaton accepts exactly the token sequences that merging in rank order gives.
It starts as one state with an arc for each byte; every merge (u, v) -> w then adds
one gadget: the state that u leads to is copied without its arc v, the arcs u are
led to the copy, and an arc w is added wherever u could be taken, to where v led.
As all arcs of one label lead to one state, a state is kept as what was removed from
its arcs, by the number of the merge, over the state it was copied from; an arc w is
there if the arcs it was added beside were there at that time. A word is encoded by
one pass over its bytes: each prefix has one accepted path, so the pass keeps one state
for each position, takes the arcs that spell the next bytes, and emits their labels.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_TOKENIZER = os.environ.get("QUILLGRAPH_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
#: Words whose ids a worker remembers; beyond this many it forgets all and goes on. Results do not depend on it.
REMEMBERED_WORDS = 400_000
_sent: set[tuple[str, str]] = set()


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files of this kind: printable Latin-1 stands for itself, the rest follows from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}


class State:
    """Where a label leads: the arcs of ``above`` up to merge ``since``, without those in ``removed``."""

    __slots__ = ("removed", "above", "since", "labels", "known")

    def __init__(self, above: State | None, since: int, labels: int):
        self.removed: dict[int, int] = {}
        self.above, self.since, self.labels = above, since, labels
        self.known: dict[int, bool] = {}

    def removed_at(self, label: int) -> int | None:
        """Number of the merge that took the arc away, in this state or one it was copied from."""
        state, before, found = self, sys.maxsize, None
        while state is not None:
            k = state.removed.get(label)
            if k is not None and k < before:
                found = k if found is None else min(found, k)
            before, state = state.since, state.above
        return found


class Automaton:
    def __init__(self, pieces: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.start = State(None, 0, 1)
        self.left: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.leads: dict[int, State] = {}
        for label, piece in pieces.items():
            if len(piece) == 1:
                self.leads[label] = self.start
                self.start.labels += 1
        for k, (u, v, w) in enumerate(merges, 1):
            self._add_gadget(k, u, v, w)
        self.next: dict[int, int] = {}
        self.label: list[int] = [-1]
        for label in self.leads:
            node = 0
            for byte in pieces[label]:
                key = node << 8 | byte
                node = self.next.get(key, 0)
                if not node:
                    node = self.next[key] = len(self.label)
                    self.label.append(-1)
            self.label[node] = label

    def _add_gadget(self, k: int, u: int, v: int, w: int) -> None:
        state, to = self.leads.get(u), self.leads.get(v)
        if state is None or to is None or w in self.leads or not self.has_arc(state, v):
            return
        if state.labels > 1 or u == v:
            state.labels -= 1
            state = self.leads[u] = State(state, k, 1)
        state.removed[v] = k
        self.leads[w] = to
        to.labels += 1
        self.left[w], self.born[w] = u, k

    def has_arc(self, state: State, label: int) -> bool:
        before = sys.maxsize
        while True:
            k = state.removed_at(label)
            if k is not None and k <= before:
                return False
            if label not in self.left:
                return True
            before, label = self.born[label], self.left[label]

    def encode(self, word: bytes) -> list[int]:
        n = len(word)
        label_at = [-1] * (n + 1)
        state_at: list[State | None] = [None] * (n + 1)
        state_at[0] = self.start
        follow, labels, leads = self.next, self.label, self.leads
        for i in range(n):
            state = state_at[i]
            if state is None:
                continue
            node, known = 0, state.known
            for j in range(i, n):
                node = follow.get(node << 8 | word[j], 0)
                if not node:
                    break
                label = labels[node]
                if label >= 0 and label_at[j + 1] < 0:
                    there = known.get(label)
                    if there is None:
                        there = known[label] = self.has_arc(state, label)
                    if there:
                        label_at[j + 1], state_at[j + 1] = label, leads[label]
        out, at = [], n
        while at > 0:
            out.append(label_at[at])
            at -= self.length[label_at[at]]
        return out[::-1]

    @classmethod
    def from_json(cls, path: str) -> Automaton:
        """From a tokenizer file that lists its vocabulary and its merges in rank order."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        ids: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        spelled = {i: s for s, i in ids.items() if all(c in alphabet for c in s)}
        pieces = {i: bytes(alphabet[c] for c in s) for i, s in spelled.items()}
        own = cls(pieces, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        own.pieces = pieces
        own.length = {i: len(p) for i, p in pieces.items()}
        return own

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.pieces[i] for i in ids).decode("utf-8", "replace")


#: The pre-split of byte-level BPE: contractions, then runs of letters, numbers or other signs with at most one space before each, then white space.
WORDS = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class WordIds(dict):
    """Ids of a word with its leading space, computed by the automaton when first asked for."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> array:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        out = self[word] = array("i", self.automaton.encode(word.encode("utf-8")))
        return out


class WordSizes(WordIds):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        out = self[word] = len(self.automaton.encode(word.encode("utf-8")))
        return out


_loaded: dict[str, tuple[regex.Pattern, WordIds, WordSizes]] = {}


def loaded(path: str) -> tuple[regex.Pattern, WordIds, WordSizes]:
    """What a worker needs to encode, built once for each of its processes."""
    if path not in _loaded:
        automaton = Automaton.from_json(path)
        _loaded[path] = WORDS, WordIds(automaton), WordSizes(automaton)
    return _loaded[path]


def encode_text(text: str | None, path: str = DEFAULT_TOKENIZER) -> list[int]:
    """Ids of one text; none for a null or empty one."""
    words, ids, _ = loaded(path)
    out = array("i")
    for w in words.findall(text or ""):
        out.extend(ids[w])
    return out.tolist()


def sent(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file to the executors, once a session; the name under which ``loaded`` finds it there."""
    app = spark.sparkContext.applicationId
    if (app, path) not in _sent:
        spark.sparkContext.addFile(path)
        _sent.add((app, path))
    return path


def _here(path: str) -> str:
    """The file as this machine has it: the one sent, else the one at the path."""
    own = SparkFiles.get(os.path.basename(path)) if SparkFiles._is_running_on_worker else path
    return own if os.path.exists(own) else path


def token_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, ids ARRAY<INT>) of every row, in one pass without a shuffle.

    A null and an empty text have an empty list; strings that look like special tokens
    are ordinary text; a null id stays null; repeated rows each come out. Other columns,
    whatever their names, are left out.
    """
    kind = df.schema[id_col].dataType.simpleString()
    path = sent(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids, _ = loaded(_here(path))
        find = words.findall
        for batch in batches:
            texts, at = batch.column(1), 0
            while at < len(texts):
                flat, offsets, first = array("i"), array("i", [0]), at
                while at < len(texts) and len(flat) < 4_000_000:
                    for w in find(texts[at].as_py() or ""):
                        flat.extend(ids[w])
                    offsets.append(len(flat))
                    at += 1
                lists = pa.ListArray.from_arrays(pa.array(memoryview(offsets), pa.int32()), pa.array(memoryview(flat), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, at - first), lists], ["id", "ids"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def token_sizes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, n_tokens BIGINT) of every row; 0 for a null and an empty text."""
    kind = df.schema[id_col].dataType.simpleString()
    path = sent(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, _, sizes = loaded(_here(path))
        find, size = words.findall, sizes.__getitem__
        for batch in batches:
            counts = [sum(map(size, find(t.as_py() or ""))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["id", "n_tokens"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint").withColumnRenamed("id", id_col)


def decode_text(ids: Iterable[int], path: str = DEFAULT_TOKENIZER) -> str:
    return loaded(path)[1].automaton.decode(ids)
