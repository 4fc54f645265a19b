import base64
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.llm import tokenize

pytestmark = pytest.mark.skipif(not os.path.exists(tokenize.DEFAULT_TOKENIZER), reason="no vocabulary")


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    p = pytest.importorskip("public_tokenizers")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(p.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def small_bpe(word, merges):
    """Merging in rank order, the plain way."""
    parts = list(word)
    while True:
        found = [(merges[a, b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in merges]
        if not found:
            return parts
        rank, _ = min(found)
        pair = next(p for p, r in merges.items() if r == rank)
        out, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                out.append(parts[i] + parts[i + 1])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out


def test_gadgets_equal_merging_for_random_merges():
    chance = random.Random(5)
    for _ in range(120):
        pieces, merges = ["a", "b", "c"], {}
        while len(merges) < 8:
            a, b = chance.choice(pieces), chance.choice(pieces)
            if (a, b) not in merges and a + b not in pieces and small_bpe(a + b, merges) == [a, b]:
                merges[a, b] = len(merges)
                pieces.append(a + b)
        ids = {p: i for i, p in enumerate(pieces)}
        auto = tokenize.Automaton({i: p.encode() for p, i in ids.items()}, [(ids[a], ids[b], ids[a + b]) for a, b in merges])
        auto.length = {i: len(p) for p, i in ids.items()}
        for _ in range(40):
            w = "".join(chance.choice("abc") for _ in range(chance.randint(1, 12)))
            assert [pieces[i] for i in auto.encode(w.encode())] == small_bpe(w, merges), (merges, w)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(reference, t):
    t = t.encode("utf-8", "ignore").decode()
    ids = tokenize.encode_text(t)
    assert ids == reference.encode_ordinary(t)
    assert tokenize.decode_text(ids) == t


def test_special_strings_are_text(reference):
    t = "kraj <|endoftext|> i dalje"
    assert tokenize.encode_text(t) == reference.encode_ordinary(t) and 50256 not in tokenize.encode_text(t)


def test_rows(spark, reference):
    long = "Драга госпођице, " * 20_000
    rows = [(1, None, 5), (2, "", 5), (3, "isto", 5), (3, "isto", 5), (None, "x", 5), (4, long, 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = sorted(((r["doc_id"], list(r["ids"])) for r in tokenize.token_ids(df).collect()), key=lambda x: (x[0] is None, x[0] or 0))
    assert got[0] == (1, []) and got[1] == (2, []) and got[2] == got[3] and got[4][1] == reference.encode_ordinary(long) and got[5][0] is None
    sizes = {r["doc_id"]: r["n_tokens"] for r in tokenize.token_sizes(df).collect()}
    assert sizes[1] == sizes[2] == 0 and sizes[4] == len(got[4][1])
    assert tokenize.token_ids(df.limit(0)).count() == 0


def test_memory_of_words_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(tokenize, "REMEMBERED_WORDS", 3)
    t = "a b c d e f a b c d e f"
    assert tokenize.encode_text(t) == reference.encode_ordinary(t)
