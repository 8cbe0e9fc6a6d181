"""Reference-shaped JSON documents derived from the driver tables.

The workload lands nested JSON documents (entities with stats/type arrays,
text entries with a language, trees of named nodes) and normalises them.
The driver supplies relational tables instead, so these builders derive
documents of the same shapes, **one document per source row** (no grouping,
hence no unbounded group ever gathered into one value):

``entity_docs(part)``    {id, name, species{name}, height, weight,
                          stats[{base_stat}], types[{type{name}}], type{url}}
``family_docs(part)``    tree brand -> type -> name (family id = part key)
``text_entity_docs(documents ⟕ labels)``
                         {id, species{name}, n_chars, quality (JSON null when
                          unlabelled), stats[...], types[...]}
``entries_docs(documents)``
                         {id, flavor_text_entries[{flavor_text, language{name}}]}
``outline_docs(documents)``
                         {id, chain: source -> lines -> sentences}
``responses(events)``    landed HTTP responses {id, url, status, body}

Each document is JSON text; consumers parse it with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.functions.jsonpath import to_json_doc
from nestrel.operators.tree import node_schema

API = "https://api.example.com/"
CHILD = "evolves_to"


def _node(name, children=None):
    fields = [F.struct(name.alias("name")).alias("species")]
    if children is not None:
        fields.append(children.alias(CHILD))
    return F.struct(*fields)


# ---------------------------------------------------------------- entities
ENTITY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("species", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("height", T.IntegerType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("stats", T.ArrayType(T.StructType([T.StructField("base_stat", T.DoubleType())]))),
    T.StructField("types", T.ArrayType(T.StructType([
        T.StructField("type", T.StructType([T.StructField("name", T.StringType())]))]))),
    T.StructField("type", T.StructType([T.StructField("url", T.StringType())])),
])


def entity_docs(part: DataFrame) -> DataFrame:
    """``(id, body)`` entity documents, one per part row. Two stats only, so
    stats[2..5] are out of range (NULL)."""
    words = F.split(F.col("p_name"), " ")
    body = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("name")).alias("species"),
        F.col("p_size").alias("height"),
        F.col("p_retailprice").alias("weight"),
        F.array(F.struct(F.col("p_size").cast("double").alias("base_stat")),
                F.struct(F.col("p_retailprice").alias("base_stat"))).alias("stats"),
        F.transform(words, lambda w: F.struct(F.struct(w.alias("name")).alias("type"))).alias("types"),
        F.struct(F.concat(F.lit(API + "type/"), F.col("p_size").cast("string"), F.lit("/"))
                 .alias("url")).alias("type"),
    )
    return part.select(F.col("p_partkey").alias("id"), to_json_doc(body).alias("body"))


FAMILY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("chain", node_schema(3, CHILD)),
])


def family_docs(part: DataFrame) -> DataFrame:
    """``(id, body)`` trees brand -> type -> name, one per part row."""
    leaf = _node(F.col("p_name"), F.array().cast(T.ArrayType(node_schema(1, CHILD))))
    mid = _node(F.col("p_type"), F.array(leaf))
    root = _node(F.col("p_brand"), F.array(mid))
    body = F.struct(F.col("p_partkey").alias("id"), root.alias("chain"))
    return part.select(F.col("p_partkey").alias("id"), to_json_doc(body).alias("body"))


# ---------------------------------------------------------------- texts
# Three staged sources per document, like separate landing tables for the
# entity, its text entries and its family tree: each consumer parses only
# the source it needs.
_NAME = T.StructType([T.StructField("name", T.StringType())])

TEXT_ENTITY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("species", _NAME),
    T.StructField("n_chars", T.LongType()),
    T.StructField("quality", T.IntegerType()),
    T.StructField("stats", T.ArrayType(T.StructType([T.StructField("base_stat", T.LongType())]))),
    T.StructField("types", T.ArrayType(T.StructType([T.StructField("type", _NAME)]))),
])

ENTRIES_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("flavor_text_entries", T.ArrayType(T.StructType([
        T.StructField("flavor_text", T.StringType()),
        T.StructField("language", _NAME)]))),
])

OUTLINE_DEPTH = 4
OUTLINE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("chain", node_schema(OUTLINE_DEPTH, CHILD)),
])


def _lines():
    return F.split(F.col("text"), "\n")


def text_entity_docs(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(id, body)``: species = source, n_chars, quality (JSON ``null`` when
    the document is unlabelled), stats = [line count, word count], types = [lang]."""
    d = documents.join(labels.select("doc_id", "quality"), "doc_id", "left")
    body = F.struct(
        F.col("doc_id").alias("id"),
        F.struct(F.col("source").alias("name")).alias("species"),
        F.col("n_chars"),
        F.col("quality"),
        F.array(F.struct(F.size(_lines()).cast("bigint").alias("base_stat")),
                F.struct(F.size(F.split(F.col("text"), " ")).cast("bigint").alias("base_stat"))).alias("stats"),
        F.array(F.struct(F.struct(F.col("lang").alias("name")).alias("type"))).alias("types"),
    )
    return d.select(F.col("doc_id").alias("id"), to_json_doc(body).alias("body"))


def entries_docs(documents: DataFrame) -> DataFrame:
    """``(id, body)``: the text's lines as entries, each tagged with the language."""
    body = F.struct(
        F.col("doc_id").alias("id"),
        F.transform(_lines(), lambda l: F.struct(
            l.alias("flavor_text"), F.struct(F.col("lang").alias("name")).alias("language"))
        ).alias("flavor_text_entries"))
    return documents.select(F.col("doc_id").alias("id"), to_json_doc(body).alias("body"))


def outline_docs(documents: DataFrame) -> DataFrame:
    """``(id, body)``: the outline tree source -> lines -> sentences."""
    empty = F.array().cast(T.ArrayType(node_schema(1, CHILD)))
    chain = _node(F.col("source"), F.transform(_lines(), lambda l: _node(
        l, F.transform(F.split(l, r"\. "), lambda s: _node(s, empty)))))
    body = F.struct(F.col("doc_id").alias("id"), chain.alias("chain"))
    return documents.select(F.col("doc_id").alias("id"), to_json_doc(body).alias("body"))


def thread_docs(documents: DataFrame) -> DataFrame:
    """``(id, body)``: a tree as deep as the text has lines. The root is the source; a line's
    children are its sentences and then the next line."""
    def name(x):
        return F.concat(F.lit('{"species":{"name":'), F.substring(F.to_json(F.array(x)), 2, 2147483647))

    def node(x):            # to_json wrote ["..."]: its last bracket is cut with the substring's first
        return F.regexp_replace(name(x), r"\]$", "}")

    lines = F.transform(_lines(), lambda l: F.concat(
        node(l), F.lit(f',"{CHILD}":['),
        F.array_join(F.transform(F.split(l, r"\. "), lambda s: F.concat(node(s), F.lit("}"))), ",")))
    body = F.concat(node(F.col("source")), F.lit(f',"{CHILD}":['), F.array_join(lines, ","),
                    F.repeat(F.lit("]}"), F.size(_lines()) + 1))
    return documents.where("text IS NOT NULL AND source IS NOT NULL").select(
        F.col("doc_id").alias("id"), F.concat(F.lit('{"chain":'), body, F.lit("}")).alias("body"))


DESCRIBED_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("effect_entries", T.ArrayType(T.StructType([
        T.StructField("effect", T.StringType()), T.StructField("language", _NAME)]))),
    T.StructField("flavor_text_entries", T.ArrayType(T.StructType([
        T.StructField("flavor_text", T.StringType()), T.StructField("language", _NAME)]))),
])


def described_docs(documents: DataFrame) -> DataFrame:
    """``(id, body)`` described documents: flavour entries are the lines (in
    the document's language); the single effect entry is the whole text with
    sentence ends written as blank lines, always tagged ``en`` - the fallback
    for documents without an English flavour line."""
    body = F.struct(
        F.col("doc_id").alias("id"),
        F.col("source").alias("name"),
        F.array(F.struct(F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n")).alias("effect"),
                         F.struct(F.lit("en").alias("name")).alias("language"))).alias("effect_entries"),
        F.transform(_lines(), lambda l: F.struct(
            l.alias("flavor_text"), F.struct(F.col("lang").alias("name")).alias("language"))
        ).alias("flavor_text_entries"))
    return documents.select(F.col("doc_id").alias("id"), to_json_doc(body).alias("body"))


# ---------------------------------------------------------------- listings, links, moves
def _part_words():
    return F.split(F.col("p_name"), " ")


def listing_docs(part: DataFrame) -> DataFrame:
    """``(id, body)`` listing pages, one per part: its words, each with a URL that ends in
    ten times the part's key plus the word's place."""
    results = F.transform(_part_words(), lambda w, i: F.struct(
        w.alias("name"),
        F.concat(F.lit(API + "type/"), (F.col("p_partkey") * 10 + i).cast("string"), F.lit("/")).alias("url")))
    return part.select(F.col("p_partkey").alias("id"), to_json_doc(F.struct(results.alias("results"))).alias("body"))


def link_docs(part: DataFrame) -> DataFrame:
    """``(id, body)`` entities whose ``moves`` link every word twice, by its length; words of
    odd length have an entry without a URL."""
    moves = F.transform(F.concat(_part_words(), _part_words()), lambda w: F.struct(F.struct(
        F.when(F.length(w) % 2 == 0, F.concat(F.lit(API + "move/"), F.length(w).cast("string"), F.lit("/")))
        .alias("url")).alias("move")))
    body = F.struct(F.col("p_partkey").alias("id"), moves.alias("moves"))
    return part.select(F.col("p_partkey").alias("id"), to_json_doc(body, keep_nulls=False).alias("body"))


def move_docs(part: DataFrame) -> DataFrame:
    """``(id, body)`` moves, one per part: power, accuracy and the type's URL are JSON
    ``null`` for some sizes; even sizes have an English flavour text of several lines,
    all have an English effect text with double blanks."""
    size, english = F.col("p_size"), F.struct(F.lit("en").alias("name")).alias("language")
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit("\n"))
    other = F.when(size % 2 == 0, F.lit("en")).otherwise(F.lit("fr"))
    body = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), size.alias("pp"),
        F.when(size % 2 == 0, F.col("p_retailprice")).alias("power"),
        F.when(size % 3 == 0, size).alias("accuracy"),
        F.struct(F.when(size % 5 > 0, F.concat(F.lit(API + "type/"), size.cast("string"), F.lit("/")))
                 .alias("url")).alias("type"),
        F.array(F.struct(F.replace(F.col("p_name"), F.lit(" "), F.lit("  ")).alias("effect"), english)).alias("effect_entries"),
        F.array(F.struct(brand.alias("flavor_text"), F.struct(other.alias("name")).alias("language")))
        .alias("flavor_text_entries"))
    return part.select(F.col("p_partkey").alias("id"), to_json_doc(body).alias("body"))


# ---------------------------------------------------------------- responses
def responses(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed HTTP responses: an ``error`` event plays a failed (404) fetch.
    ``keep`` carries extra event columns along (no join back later)."""
    return events.select(
        *keep,
        F.col("event_id").alias("id"),
        F.concat(F.lit(API + "user/"), F.col("user_id").cast("string"), F.lit("/")).alias("url"),
        F.when(F.col("event_type") == "error", F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.col("props").alias("body"))
