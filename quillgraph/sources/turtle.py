"""Turtle, both ways, with the prefixes of the graph."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.operators.triples import PREFIXES, RDF_TYPE
from quillgraph.schemas import TRIPLES
from quillgraph.sources.sinks import quoted

XSD = "http://www.w3.org/2001/XMLSchema#"
#: What may stand behind a prefix without escapes.
_LOCAL = r"[A-Za-z_][A-Za-z0-9_-]*"
_TOKEN = regex.compile(r'\s+|\#[^\n]*|(?P<iri><[^<>"{}|^`\\\s]*>)|(?P<text>"""(?:[^"\\]|\\.|"(?!""))*"""|"(?:[^"\\\n]|\\.)*")|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<number>[+-]?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(?P<name>[\p{L}_]?[\p{L}\p{N}_-]*:[\p{L}\p{N}_.%-]*[\p{L}\p{N}_%-]|[\p{L}_]?[\p{L}\p{N}_-]*:|a\b|true\b|false\b|PREFIX\b|BASE\b)|(?P<sign>\^\^|[.;,])', regex.DOTALL)
_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def _short(iri: Column, prefixes: dict[str, str]) -> Column:
    """An IRI by the prefix it begins with, if the rest may stand behind one."""
    out = F.concat(F.lit("<"), iri, F.lit(">"))
    for name, space in sorted(prefixes.items(), key=lambda x: len(x[1])):
        rest = F.substr(iri, F.lit(len(space) + 1))
        out = F.when(iri.startswith(space) & rest.rlike(f"^{_LOCAL}$"), F.concat(F.lit(f"{name}:"), rest)).otherwise(out)
    return out


def header(prefixes: dict[str, str]) -> str:
    return "\n".join(f"@prefix {name}: <{space}> ." for name, space in prefixes.items())


def blocks(triples: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """(value): a block of Turtle for each subject, its predicates and objects in order."""
    known = PREFIXES if prefixes is None else prefixes
    tail = F.when(F.col("lang").isNotNull(), F.concat(F.lit("@"), "lang")).when(F.col("datatype").isNotNull(), F.concat(F.lit("^^"), _short(F.col("datatype"), known))).otherwise("")
    thing = F.when(F.col("o_kind") == "iri", _short(F.col("o"), known)).otherwise(F.concat(quoted(F.col("o")), tail))
    verb = F.when(F.col("p") == RDF_TYPE, F.lit("a")).otherwise(_short(F.col("p"), known))
    by = triples.select(_short(F.col("s"), known).alias("s"), verb.alias("p"), thing.alias("o")).groupBy("s", "p").agg(F.array_join(F.array_sort(F.collect_list("o")), ",\n        ").alias("os"))
    lines = by.groupBy("s").agg(F.array_sort(F.collect_list(F.struct((F.col("p") != "a").alias("later"), F.concat_ws(" ", "p", "os").alias("po")))).alias("pos"))
    return lines.select(F.concat(F.col("s"), F.lit(" "), F.array_join(F.transform("pos", lambda x: x["po"]), " ;\n    "), F.lit(" .")).alias("value"))


def write(triples: DataFrame, path: str, base_uri: str | None = None, base_prefix: str = "ex") -> None:
    """Turtle files that each stand alone: every one begins with the prefixes, that of the base too."""
    prefixes = ({base_prefix: base_uri} if base_uri else {}) | PREFIXES
    head = header(prefixes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([head], pa.string())], ["value"])
        yield from batches

    blocks(triples, prefixes).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def _unescaped(s: str) -> str:
    return regex.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _ESCAPES.get(m[1], m[1]), s, flags=regex.DOTALL)


def parse(text: str) -> list[tuple[str, str, str, str, str | None, str | None]]:
    """(s, p, o, o_kind, datatype, lang) of a Turtle document without blank nodes and collections; what it can't read is an error."""
    tokens: list[tuple[str, str]] = []
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"no Turtle at character {at}: {text[at : at + 30]!r}")
        if m.lastgroup:
            tokens.append((m.lastgroup, m.group()))
        at = m.end()
    prefixes: dict[str, str] = {}
    base = ""
    out: list[tuple] = []
    i = 0

    def iri(kind: str, word: str) -> str:
        if kind == "iri":
            inner = _unescaped(word[1:-1])
            return inner if regex.match(r"[A-Za-z][A-Za-z0-9+.-]*:", inner) else base + inner
        name, _, rest = word.partition(":")
        if kind != "name" or name not in prefixes or ":" not in word:
            raise ValueError(f"no IRI: {word!r}")
        return prefixes[name] + rest

    def directive(i: int) -> int:
        nonlocal base
        word = tokens[i][1].lstrip("@").lower()
        if word == "prefix":
            prefixes[tokens[i + 1][1].rstrip(":")] = iri(*tokens[i + 2])
            i += 3
        else:
            base = iri(*tokens[i + 1])
            i += 2
        return i + 1 if i < len(tokens) and tokens[i] == ("sign", ".") and tokens[i - 1][0] == "iri" else i

    while i < len(tokens):
        if tokens[i][1].lower() in ("@prefix", "@base", "prefix", "base"):
            i = directive(i)
            continue
        s = iri(*tokens[i])
        i += 1
        while True:
            p = RDF_TYPE if tokens[i] == ("name", "a") else iri(*tokens[i])
            i += 1
            while True:
                kind, word = tokens[i]
                i += 1
                if kind == "text":
                    value = _unescaped(word[3:-3] if word.startswith('"""') else word[1:-1])
                    datatype = lang = None
                    if i < len(tokens) and tokens[i][0] == "lang":
                        lang = tokens[i][1][1:]
                        i += 1
                    elif i < len(tokens) and tokens[i] == ("sign", "^^"):
                        datatype = iri(*tokens[i + 1])
                        i += 2
                    out.append((s, p, value, "literal", datatype, lang))
                elif kind == "number" or word in ("true", "false"):
                    own = "boolean" if kind != "number" else "integer" if regex.fullmatch("[+-]?[0-9]+", word) else "double" if regex.search("[eE]", word) else "decimal"
                    out.append((s, p, word, "literal", XSD + own, None))
                else:
                    out.append((s, p, iri(kind, word), "iri", None, None))
                if tokens[i] != ("sign", ","):
                    break
                i += 1
            while tokens[i] == ("sign", ";"):
                i += 1
            if tokens[i] == ("sign", "."):
                i += 1
                break
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """Triples of a Turtle file or folder; each file is read whole by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["s", "p", "o", "o_kind", "datatype", "lang"]
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows = parse(text)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(6)], names)

    return spark.read.text(path, wholetext=True).select("value").mapInArrow(run, TRIPLES).distinct()
