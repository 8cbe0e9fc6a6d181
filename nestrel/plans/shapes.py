"""Schemas of the staged document kinds (the shapes the JSON paths imply).

Only the fields the normalisation reads are declared; ``from_json`` ignores
the rest of each document. Numbers that the relational target stores as
unconstrained NUMERIC are read as DECIMAL(20,6) (an explicit scale: a bare
DECIMAL in Spark has scale 0 and would round 7.25 to 7).
"""

from __future__ import annotations

from pyspark.sql import types as T

from nestrel.operators.tree import node_schema

NUM = T.DecimalType(20, 6)
NAME = T.StructType([T.StructField("name", T.StringType())])
URL = T.StructType([T.StructField("url", T.StringType())])


def _entries(text_field: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(text_field, T.StringType()),
                                     T.StructField("language", NAME)]))


ENTITY = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("height", NUM),
    T.StructField("weight", NUM),
    T.StructField("species", NAME),
    T.StructField("stats", T.ArrayType(T.StructType([T.StructField("base_stat", NUM)]))),
    T.StructField("types", T.ArrayType(T.StructType([T.StructField("type", NAME)]))),
    T.StructField("moves", T.ArrayType(T.StructType([T.StructField("move", URL)]))),
    T.StructField("abilities", T.ArrayType(T.StructType([T.StructField("ability", URL)]))),
])

TEXTS = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("flavor_text_entries", _entries("flavor_text")),
])

LISTING = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([T.StructField("name", T.StringType()),
                                                       T.StructField("url", T.StringType())]))),
])


def tree(depth: int = 4, child_key: str = "evolves_to") -> T.StructType:
    return T.StructType([T.StructField("id", T.IntegerType()),
                         T.StructField("chain", node_schema(depth, child_key))])


MOVES = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("pp", T.IntegerType()),
    T.StructField("power", NUM),
    T.StructField("accuracy", NUM),
    T.StructField("type", URL),
    T.StructField("effect_entries", _entries("effect")),
    T.StructField("flavor_text_entries", _entries("flavor_text")),
])

ABILITIES = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("effect_entries", _entries("effect")),
    T.StructField("flavor_text_entries", _entries("flavor_text")),
])
