"""Writers: CSV, lines by tabs, N-Triples, JSON-LD and network pages; Turtle is in ``turtle``."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.dimensions import NODE_COLOURS, NODE_TYPES

XSD = "http://www.w3.org/2001/XMLSchema#"


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header, null as empty; one file only for results known to be small."""
    (df.coalesce(1) if single else df).write.mode("overwrite").options(header="true", escape='"', quoteAll="false", nullValue="", emptyValue="").csv(path)


def quoted(c: Column) -> Column:
    for sign, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(sign), F.lit(written))
    return F.concat(F.lit('"'), c, F.lit('"'))


def ntriples(triples: DataFrame) -> DataFrame:
    """(value): a line of N-Triples for each triple, written wherever the triple is."""
    tail = F.when(F.col("lang").isNotNull(), F.concat(F.lit("@"), "lang")).when(F.col("datatype").isNotNull(), F.concat(F.lit("^^<"), "datatype", F.lit(">"))).otherwise("")
    thing = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), "o", F.lit(">"))).otherwise(F.concat(quoted(F.col("o")), tail))
    return triples.select(F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> "), thing, F.lit(" .")).alias("value"))


def write_ntriples(triples: DataFrame, path: str) -> None:
    ntriples(triples).write.mode("overwrite").text(path)


def read_ntriples(spark, path: str) -> DataFrame:
    """Triples of an N-Triples file or folder."""
    line = r'^<([^>]*)> <([^>]*)> (?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?) \.$'
    part = lambda g: F.nullif(F.regexp_extract("value", line, g), F.lit(""))
    rows = spark.read.text(path).where(F.col("value").rlike(line))
    text = F.regexp_extract("value", line, 4)
    for written, sign in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"'), ("\\\\", "\\")):
        text = F.replace(text, F.lit(written), F.lit(sign))
    iri = part(3)
    return rows.select(part(1).alias("s"), part(2).alias("p"), F.coalesce(iri, text).alias("o"), F.when(iri.isNotNull(), "iri").otherwise("literal").alias("o_kind"), part(6).alias("datatype"), part(5).alias("lang"))


def jsonld_nodes(triples: DataFrame) -> DataFrame:
    """(s, node): every subject as an object of expanded JSON-LD."""
    kind = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    value = F.when(F.col("o_kind") == "iri", F.to_json(F.struct(F.col("o").alias("@id")))).when(F.col("lang").isNotNull(), F.to_json(F.struct(F.col("lang").alias("@language"), F.col("o").alias("@value")))).when(F.col("datatype").isNotNull(), F.to_json(F.struct(F.col("datatype").alias("@type"), F.col("o").alias("@value")))).otherwise(F.to_json(F.struct(F.col("o").alias("@value"))))
    value = F.when(F.col("p") == kind, F.to_json(F.array("o")).substr(F.lit(2), F.length(F.to_json(F.array("o"))) - 2)).otherwise(value)
    named = F.when(F.col("p") == kind, "@type").otherwise(F.col("p"))
    by = triples.select("s", named.alias("p"), value.alias("v")).groupBy("s", "p").agg(F.array_sort(F.collect_list("v")).alias("vs"))
    member = F.concat(F.to_json(F.array("p")).substr(F.lit(2), F.length(F.to_json(F.array("p"))) - 2), F.lit(": ["), F.array_join("vs", ", "), F.lit("]"))
    nodes = by.select("s", member.alias("m")).groupBy("s").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    return nodes.select("s", F.concat(F.lit('{"@id": '), F.to_json(F.array("s")).substr(F.lit(2), F.length(F.to_json(F.array("s"))) - 2), F.lit(", "), F.array_join("ms", ", "), F.lit("}")).alias("node"))


def write_jsonld(triples: DataFrame, path: str) -> None:
    """The expanded document: files that are each one array of objects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = lambda *x: pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["value"])
        sign = "["
        for batch in batches:
            for node in batch.column(0).to_pylist():
                yield rows(sign + node)
                sign = ","
        yield rows("]" if sign == "," else "[]")

    jsonld_nodes(triples).select("node").mapInArrow(run, "value string").write.mode("overwrite").text(path)


def tsv(rows: DataFrame) -> DataFrame:
    """(value): a line for each row, columns by tabs, a missing value as None; tabs and line ends in values are blanks."""
    plain = [F.coalesce(F.regexp_replace(F.col(f"`{c}`").cast("string"), r"[\t\r\n]", " "), F.lit("None")) for c in rows.columns]
    return rows.select(F.concat_ws("\t", *plain).alias("value"))


def write_tsv(rows: DataFrame, path: str) -> int:
    """Rows as lines in their order, with their number as the result."""
    tsv(rows).write.mode("overwrite").text(path)
    return rows.sparkSession.read.text(path).count()


def network_page(nodes: DataFrame, edges: DataFrame, path: str, most: int = 5000) -> None:
    """A page that draws a network, for networks small enough to draw; larger ones are refused."""
    drawn = nodes.limit(most + 1).collect()
    if len(drawn) > most:
        raise ValueError(f"a network of more than {most} nodes can't be drawn; filter it first")
    at = {r["node"]: {"id": r["node"], "type": NODE_TYPES.get(r["node_type"], "Other"), "colour": NODE_COLOURS.get(r["node_type"], "#dddddd"), "size": r["html_size"]} for r in drawn}
    # edges meet the nodes that are drawn before any is collected; of two nodes one edge is drawn, so their number is bounded by that of the nodes
    listed = nodes.sparkSession.createDataFrame([(n,) for n in at], "node string") if at else nodes.select("node")
    inside = edges.join(F.broadcast(listed.withColumnRenamed("node", "source")), "source").join(F.broadcast(listed.withColumnRenamed("node", "target")), "target")
    links = [{"a": r["source"], "b": r["target"], "w": r["w"]} for r in inside.groupBy("source", "target").agg(F.max("weight").alias("w")).collect()]
    data = json.dumps({"nodes": list(at.values()), "links": links}, ensure_ascii=False).replace("</", "<\\/")
    Path(path).write_text(
        "<!doctype html><meta charset='utf-8'><title>Network</title><canvas id='c' width='1200' height='900'></canvas><script>const d=" + data + ";"
        "const n=d.nodes,r=380;n.forEach((x,i)=>{const t=2*Math.PI*i/n.length;x.x=600+r*Math.cos(t);x.y=450+r*Math.sin(t)});const by=Object.fromEntries(n.map(x=>[x.id,x]));"
        "const c=document.getElementById('c');const g=c.getContext('2d');d.links.forEach(l=>{g.lineWidth=Math.min(3,Math.max(.6,l.w));g.strokeStyle='#9996';g.beginPath();g.moveTo(by[l.a].x,by[l.a].y);g.lineTo(by[l.b].x,by[l.b].y);g.stroke()});"
        "const at=e=>n.find(x=>Math.hypot(x.x-e.offsetX,x.y-e.offsetY)<x.size/2);c.onmousemove=e=>{const x=at(e);c.title=x?x.id+' ('+x.type+'), '+d.links.filter(l=>l.a==x.id||l.b==x.id).length+' links':''};"
        "n.forEach(x=>{g.fillStyle=x.colour;g.beginPath();g.arc(x.x,x.y,x.size/4,0,7);g.fill();g.fillStyle='#222';g.fillText(x.id,x.x+8,x.y)})</script>",
        encoding="utf-8",
    )
