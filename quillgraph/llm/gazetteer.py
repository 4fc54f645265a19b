"""Free-entered labels mapped to a canonical list, by BK-trees over its entries.

A label is read as words of one alphabet without accents. Words that the list itself
puts before many others (kinds of organisation, Upper and Lower, given names) are its
frame; the longest other word is the proper name. Frame words, given names and familiar
forms, listed or learnt from the labels, are tables, and words meet them in joins, so
none of them has to fit anywhere.

The proper names of the list's entries, without the endings of their cases, stand in one
BK-tree for each type under the Damerau-Levenshtein distance, in which a letter added,
left out or wrong and two neighbours that changed places are one edit each, and which is
a metric. A search returns every entry within the radius by the triangle inequality; of
them those stay whose frame agrees with the label's, and the radius grows until one does.
The list is spread over shards of at most SHARD_ENTRIES entries, each with its own
trees, every label visits every shard, in parts of at most PART_LABELS labels, and the
shards' winners are merged. A short list is one shard; there is no other way.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.nametext import BkTree, fold, one_slip, words, written
from quillgraph.session import checkpointed

#: Entries of a shard and labels of a part, at most; what one task holds.
SHARD_ENTRIES, PART_LABELS = 50_000, 20_000
#: A part has not fewer labels than this while there are cores to keep busy.
LEAST_PART = 400
#: Edits of a proper name, at most, by its least letters; with two, names of nine letters and more meet entries that look like other places.
EDITS = ((5, 1),)
PERSON = "PER"
#: A word that stands before as many different last words as this share of a type's entries, and two at least, belongs to the frame.
FRAME_SHARE = 0.002
#: Links are looked up in trees of their own, which allow no edit.
LINK = "link:"

# Words that stand around a name without being part of it, folded.
TITLES = {"dr", "prof", "g", "gdin", "gosp", "gospodin", "gospodina", "gospodinu", "gdica", "gdice", "gdici", "gospodica", "gospodice", "gospodici", "gda", "gospoda", "gospode", "gospodi", "mr", "mrs", "inz", "ing", "sv"}
AROUND = {"u", "iz", "kod", "na", "do", "mestu", "mesta", "mesto", "grad", "grada", "gradu", "varos", "varosi", "okolina", "okolini", "okoline", "posta", "poste", "selo", "sela", "selu", "stanica", "stanici", "opstina", "srez", "kraj", "blizu"}

_CASE_ENDING = regex.compile(r"(?:[aeiou]|(?<=[sc]k)(?:om|og|oj|im|em)|(?<=ic)em)$")


def stem(word: str) -> str:
    """A folded name without the ending of its case; names of three letters and less stay whole."""
    word = word.rstrip(".")
    if len(word) > 7 and word.endswith("om"):
        return word[:-2]
    return _CASE_ENDING.sub("", word) if len(word) > 3 else word


def frame_stem(word: str) -> str:
    """Like ``stem``, but also for adjectives, whose endings have two or three letters."""
    return regex.sub(r"(?:[aeiou]g|[aeiou]m|[aeiou]mu|[aeiou]j|[aeiou]h|[aeiou])$", "", word.rstrip(".")) if len(word) > 3 else word.rstrip(".")


_WORD = "struct<at:int,word:string,stem:string,frame:string,said:string,title:boolean,around:boolean>"


def _split(df: DataFrame) -> DataFrame:
    """(type, label, own): each label's words in order, as they stand and without endings; ``said`` is a person's word as written, where the label has accents."""
    item = pa.list_(pa.struct([("at", pa.int32()), ("word", pa.string()), ("stem", pa.string()), ("frame", pa.string()), ("said", pa.string()), ("title", pa.bool_()), ("around", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kind, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                said = written(label) if kind == PERSON else {}
                left_out = TITLES if kind == PERSON else AROUND
                own = [w for w in words(label) if w not in ",("]
                out.append([{"at": n, "word": w, "stem": stem(w), "frame": frame_stem(w), "said": said.get(w.rstrip(".")), "title": w in TITLES, "around": w.rstrip(".") in left_out} for n, w in enumerate(own)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, item)], ["type", "label", "own"])

    # a table of labels is small for its work, so it is spread before Python
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, f"type string, label string, own array<{_WORD}>")


def known_forms(forms: DataFrame) -> DataFrame:
    """(short, full, said): familiar forms by stem, the given name each stands for, and how the form is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(stem(fold(b)), frame_stem(fold(a).replace("dj", "d")), b.lower(), stem(fold(a))) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)], ["short", "full", "said", "full_name"])

    return forms.select("given_name", "short_form").dropna().distinct().mapInArrow(run, "short string, full string, said string, full_name string")


def _frame_words(entries: DataFrame, forms: DataFrame) -> DataFrame:
    """(type, frame): words each type puts before many others, first words of persons, and given names that have a familiar form."""
    before = entries.select("type", "own", F.try_element_at("own", F.lit(-1))["word"].alias("last")).select("type", "last", F.posexplode(F.slice("own", 1, F.greatest(F.size("own") - 1, F.lit(0)))).alias("i", "w"))
    counted = before.groupBy("type", F.col("w.frame").alias("frame")).agg(F.count_distinct("last").alias("n"), F.max((F.col("type") == PERSON) & (F.col("i") == 0)).alias("given"))
    total = entries.groupBy("type").agg(F.count("*").alias("of"))
    common = counted.join(total, "type").where((F.col("n") >= F.greatest(F.lit(2), F.lit(FRAME_SHARE) * F.col("of"))) | F.col("given")).select("type", "frame")
    return common.unionByName(forms.select(F.lit(PERSON).alias("type"), F.col("full").alias("frame"))).distinct()


def _marked(split: DataFrame, common: DataFrame, forms: DataFrame) -> DataFrame:
    """``split`` with what the tables say of each word: ``common`` if it is a frame word, ``listed`` if it may be one (also as its beginning or a familiar form), and the given names it may stand for."""
    each = split.select("type", "label", F.explode("own").alias("w"))
    whole = common.select("type", F.col("frame").alias("_f"), F.lit(True).alias("common"))
    begun = common.select("type", F.explode(F.transform(F.sequence(F.lit(1), F.length("frame")), lambda n: F.col("frame").substr(F.lit(1), n))).alias("_p"), F.lit(True).alias("begun")).distinct()
    stands = forms.groupBy("short").agg(F.collect_set(F.struct("full", "said")).alias("for"))
    short = F.when(F.col("type") == PERSON, F.col("w.stem"))
    bare = F.when(F.col("type") == PERSON, F.col("w.word"))
    each = each.join(whole, (whole["type"] == each["type"]) & (F.col("_f") == F.col("w.frame")), "left").select(each["*"], "common")
    each = each.join(begun, (begun["type"] == each["type"]) & (F.col("_p") == F.when(F.col("w.word").endswith("."), F.rtrim(F.col("w.word"), F.lit(".")))), "left").select(each["*"], "begun")
    each = each.join(stands, F.col("short") == short, "left").drop("short")
    each = each.join(stands.select(F.col("short").alias("_b"), F.lit(True).alias("is_form")), F.col("_b") == bare, "left").drop("_b")
    no = F.lit(False)
    # Mica and Mića are forms of different names; without accents either
    said = F.filter("for", lambda f: F.col("w.said").isNull() | f["said"].isNull() | (F.regexp_replace("w.said", _ENDING, "") == F.regexp_replace(f["said"], _ENDING, "")))
    fulls = F.array_distinct(F.transform(F.when(F.size(said) > 0, said).otherwise(F.col("for")), lambda f: f["full"]))
    seen = F.struct("w.*", F.coalesce("common", no).alias("common"), (F.coalesce("common", "begun", "is_form", no) | F.col("for").isNotNull()).alias("listed"), F.coalesce(fulls, F.array().cast("array<string>")).alias("fulls"))
    return each.select("type", "label", seen.alias("w")).groupBy("type", "label").agg(F.array_sort(F.collect_list("w")).alias("own"))


#: The ending that tells a form's case, as ``stem`` takes it off.
_ENDING = "(?<=...)[aeiou]$"


def _readings(marked: DataFrame) -> DataFrame:
    """(type, label, name, key, frame): the proper name, as it stands and without its ending, and the other words; labels without a proper name of four letters have none."""
    bare = lambda w: F.rtrim(w["word"], F.lit("."))
    rest = F.filter("own", lambda w: ~w["around"])
    kept = marked.withColumn("own", F.when(F.size(rest) > 0, rest).otherwise(F.col("own")))
    named = F.filter("own", lambda w: ~w["listed"] & (F.length(bare(w)) > 1) & ~w["word"].rlike(r"^[0-9]"))
    longest = kept.withColumn("_names", named).withColumn("_most", F.array_max(F.transform("_names", lambda w: F.length(bare(w)))))
    own = longest.where("_most >= 4").withColumn("_name", F.filter("_names", lambda w: F.length(bare(w)) == F.col("_most"))).withColumn("_name", F.get("_name", F.lit(0)))
    frame = F.filter("own", lambda w: (w["at"] != F.col("_name.at")) & ~w["title"])
    return own.select("type", "label", F.rtrim("_name.word", F.lit(".")).alias("name"), F.col("_name.stem").alias("key"), frame.alias("frame"))


def _learnt(labels: DataFrame, entries: DataFrame) -> DataFrame:
    """(short, full): familiar forms that the labels themselves show.

    An unknown word beside a listed person's family name may be a familiar form; beside the
    full name it is. Readings of labels and entries meet in a join by the family name.
    """
    of = lambda df: df.where((F.col("type") == PERSON) & (F.size("frame") > 0))
    listed = of(entries).select("name", F.get("frame", F.lit(0))["frame"].alias("full")).distinct()
    unknown = F.filter("frame", lambda w: ~w["listed"] & (F.length(w["word"]) > 2) & ~w["word"].endswith("."))
    asked = of(labels).select("name", F.transform("frame", lambda w: w["frame"]).alias("stems"), F.transform(unknown, lambda w: w["stem"]).alias("unknown")).where("size(unknown) > 0").distinct()
    met = asked.join(listed, "name")
    whole = F.array_contains("stems", F.col("full"))
    hints = met.where(whole | (F.size("stems") == 1)).select(F.explode("unknown").alias("short"), "full", "name", F.when(whole, 2).otherwise(1).alias("weight"))
    found = hints.groupBy("short", "full", "name").agg(F.max("weight").alias("w")).groupBy("short", "full").agg(F.sum("w").alias("w"))
    return found.withColumn("all", F.sum("w").over(Window.partitionBy("short"))).where((F.col("w") >= 2) & (F.col("w") >= 0.6 * F.col("all"))).select("short", "full")


def _same(kind: str, word: dict, own: dict) -> bool:
    """Whether a word of a label may be a word of an entry; accents count in an initial and in a familiar form if they are written."""
    short = word["word"].rstrip(".")
    if len(short) == 1 and word["said"] and own["said"]:
        return own["said"].startswith(word["said"])
    if (len(short) == 1 or word["word"].endswith(".")) and own["word"].startswith(short):
        return True
    a, b = word["frame"], own["frame"]
    if a == b or (len(a) > 3 and one_slip(a, b) and not word["common"]):
        return True
    if kind != PERSON:
        return False
    return b in word["fulls"] or any(len(w) > 3 and one_slip(word["stem"], w) for w in own["shorts"])


def _agrees(kind: str, said: list[dict], own: list[dict]) -> bool:
    """Whether the frame of a label may stand for that of an entry.

    Persons: no given name, or one that is the same, familiar, begins or slips. Places:
    the same words on both sides. Organisations: what the label says of the kind is so.
    """
    if kind == "LOC" and len(said) != len(own):
        return False
    left = list(own)
    for w in said:
        hit = next((o for o in left if _same(kind, w, o)), None)
        if hit is None:
            return False
        if kind != PERSON:  # a person may have the full and the familiar given name
            left.remove(hit)
    return True


def edits(kind: str, key: str) -> int:
    """Edits that a proper name of this type may have."""
    return 0 if kind.startswith(LINK) else max((n for least, n in EDITS if len(key) >= least), default=0)


def _meet(asked: pa.Table, listed: pa.Table) -> pa.Table:
    """Winners of one shard for one part of the labels: (type, label, uri, distance)."""
    entries: dict[str, dict[str, list[dict]]] = defaultdict(lambda: defaultdict(list))
    for e in listed.to_pylist():
        entries[e["type"]][e["key"]].append(e)
    rows: list[tuple[str, str, str, int]] = []
    by_kind: dict[str, list[dict]] = defaultdict(list)
    for label in asked.to_pylist():
        by_kind[label["type"]].append(label)
    for kind, labels in by_kind.items():
        of = entries.get(kind)
        if not of:
            continue
        tree = BkTree(list(of))
        # the radius grows while no entry agrees
        for radius in range(1 + max((n for _, n in EDITS), default=0)):
            keys = sorted({x["key"] for x in labels if edits(kind, x["key"]) >= radius})
            near = dict(zip(keys, tree.within(keys, radius)))
            open_ = []
            for x in labels:
                uris: dict[int, set[str]] = defaultdict(set)
                for d, key in near.get(x["key"], ()):
                    for e in of[key]:
                        if d == radius and _agrees(kind, x["frame"] or [], e["frame"] or []):
                            uris[0 if d == 0 and e["name"] == x["name"] else 1 + d].add(e["uri"])
                if uris:
                    best = min(uris)
                    rows += [(kind, x["label"], uri, best) for uri in sorted(uris[best])]
                else:
                    open_.append(x)
            labels = open_
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int32()))], names=["type", "label", "uri", "distance"])


def nearest_entries(labels: DataFrame, entries: DataFrame, forms: DataFrame | None = None, shard_entries: int = SHARD_ENTRIES, part_labels: int = PART_LABELS) -> DataFrame:
    """(type, label, uri, distance INT) for each distinct (type, label) that has a nearest entry of its type.

    distance is 0 for the same name, 1 for the same stem, then 1 more for each edit. A label
    as near to two entries is not mapped; entries with a null label, type or URI are left
    out. Labels of a type LINK + type are looked up as they are among entries of that type.
    """
    spark = labels.sparkSession
    wanted = labels.select("type", "label").dropna().distinct()
    entries = entries.select("type", "label", F.col("wikidata_uri").alias("uri")).dropna().distinct()
    link = F.col("type").startswith(LINK)
    known = known_forms(forms if forms is not None else spark.createDataFrame([], "given_name string, short_form string")).select("short", "full", "said")
    listed = checkpointed(_split(entries.where(~link).select("type", "label").distinct()))
    asked = checkpointed(_split(wanted.where(~link)))
    common = checkpointed(_frame_words(listed, known))
    own = _readings(_marked(listed, common, known))
    learnt = _learnt(_readings(_marked(asked, common, known)), own).join(known.select("short", "full"), ["short", "full"], "left_anti")
    every = checkpointed(known.unionByName(learnt.select("short", "full", F.lit(None).cast("string").alias("said"))))
    shorts = every.groupBy("full").agg(F.collect_set("short").alias("shorts"))
    said = _readings(_marked(asked, common, every)).select("type", "label", "name", "key", "frame")
    own = _readings(_marked(listed, common, every))
    # an entry's words bring the familiar forms they have
    words_ = own.select("type", "label", "name", "key", F.explode_outer("frame").alias("w")).join(shorts, (F.col("type") == PERSON) & (F.col("full") == F.col("w.frame")), "left")
    frame = F.array_sort(F.collect_list(F.when(F.col("w").isNotNull(), F.struct("w.at", "w.word", "w.frame", "w.said", F.coalesce("shorts", F.array().cast("array<string>")).alias("shorts")))))
    own = words_.groupBy("type", "label", "name", "key").agg(frame.alias("frame")).join(entries, ["type", "label"]).select("type", "uri", "name", "key", "frame")
    as_is = lambda df, *c: df.where(link).select("type", *c, F.col("label").alias("name"), F.col("label").alias("key"))
    own = checkpointed(own.unionByName(as_is(entries, "uri"), allowMissingColumns=True))
    said = checkpointed(said.unionByName(as_is(wanted, "label"), allowMissingColumns=True))
    shards = max(1, -(-own.count() // shard_entries))
    n = said.count()
    parts = max(1, -(-n // part_labels), min(2 * spark.sparkContext.defaultParallelism, n // LEAST_PART))
    visits = said.withColumn("part", F.expr(f"pmod(xxhash64(type, label), {parts})")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = own.withColumn("shard", F.expr(f"pmod(xxhash64(type, name, uri), {shards})")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    # the number is given, as parts of few bytes and much work must not be put together again
    spread = lambda df: df.withColumn("shard", F.col("shard").cast("int")).repartition(2 * shards * parts, "shard", "part").groupBy("shard", "part")
    found = spread(visits).cogroup(spread(held)).applyInArrow(_meet, "type string, label string, uri string, distance int")
    # the winners of all shards; a label has few entries that agree with it
    winners = found.groupBy("type", "label").agg(F.min("distance").alias("distance"), F.collect_set(F.struct("distance", "uri")).alias("all"))
    nearest = F.array_distinct(F.transform(F.filter("all", lambda x: x["distance"] == F.col("distance")), lambda x: x["uri"]))
    return winners.withColumn("nearest", nearest).where("size(nearest) = 1").select("type", "label", F.col("nearest")[0].alias("uri"), "distance")


#: An entity id in any of the ways it is written: the list's own form, another host path, a prefix, bare, other case, with a fragment or slash after it.
ENTITY_ID = r"(?i)^\s*(?:https?://[^\s]*/|[a-z]+:)?(q[0-9]+)(?:[/#?].*)?\s*$"


def _link(uri: Column) -> Column:
    """A link as it is looked up: its entity id in capitals; null if it has none."""
    return F.nullif(F.upper(F.regexp_extract(uri, ENTITY_ID, 1)), F.lit(""))


def canonical_links(rows: DataFrame, entries: DataFrame, forms: DataFrame | None = None, types: tuple[str, ...] = ("LOC", "ORG", "PER"), shard_entries: int = SHARD_ENTRIES, part_labels: int = PART_LABELS) -> DataFrame:
    """(ordinal, ref_uri): rows of ``types`` whose link is not a URI of the list as it stands, with the URI meant or ''.

    A link that names an entry of the row's type in another way comes first, then the
    label. A null label with no such link is reported with ''. Repeated rows come out once.
    """
    rows = rows.where(F.col("type").isin(*types)).select("ordinal", "label", "type", "wikidata_uri")
    listed = entries.select("wikidata_uri").dropna().distinct()
    open_ = checkpointed(rows.join(listed, "wikidata_uri", "left_anti").withColumn("link", _link(F.col("wikidata_uri"))))
    linked = lambda df, label: df.where(label.isNotNull()).select(F.concat(F.lit(LINK), "type").alias("type"), label.alias("label"), "wikidata_uri")
    asked = open_.select("type", "label").unionByName(linked(open_, F.col("link")).select("type", "label"))
    listed = entries.select("type", "label", "wikidata_uri").unionByName(linked(entries, _link(F.col("wikidata_uri"))))
    found = checkpointed(nearest_entries(asked, listed, forms, shard_entries, part_labels))
    by_label = found.select("type", "label", F.col("uri").alias("by_label"))
    by_link = found.where(F.col("type").startswith(LINK)).select(F.expr(f"substring(type, {len(LINK) + 1})").alias("type"), F.col("label").alias("link"), F.col("uri").alias("by_link"))
    meant = open_.join(by_link, ["type", "link"], "left").join(by_label, ["type", "label"], "left")
    return meant.select("ordinal", F.coalesce("by_link", "by_label", F.lit("")).alias("ref_uri")).distinct()
