"""Trees held as nested JSON: levels, flattening and family ids.

A tree node is ``{<name path>: ..., <child key>: [node, ...]}``. The child key
is a parameter (the source never names it and walks it with a wildcard).
Parsing uses a schema nested to a fixed maximum depth; level ``d`` is the
array of node names at depth ``d`` in document order, computed in-row with
``transform``/``flatten`` - no explode, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.functions.jsonpath import concat_arrays, field
from nestrel.operators.treeorder import numbered


def node_schema(depth: int, child_key: str = "evolves_to",
                name_path: Sequence[str] = ("species", "name")) -> T.StructType:
    """Schema of a node with ``depth`` levels (the root counts as one)."""
    name_t: T.DataType = T.StringType()
    for part in reversed(name_path[1:]):
        name_t = T.StructType([T.StructField(part, name_t)])
    fields = [T.StructField(name_path[0], name_t)]
    if depth > 1:
        fields.append(T.StructField(child_key, T.ArrayType(node_schema(depth - 1, child_key, name_path))))
    return T.StructType(fields)


def level(root: Column, d: int, child_key: str = "evolves_to",
          name_path: str = "species.name") -> Column:
    """Names at depth ``d`` (1 = root) as an array; empty when the tree is shallower."""
    if d == 1:
        return F.filter(F.array(field(root, name_path)), lambda x: x.isNotNull())
    nodes = F.coalesce(root.getField(child_key), F.array())
    for _ in range(d - 2):
        nodes = F.flatten(F.transform(nodes, lambda n: F.coalesce(n.getField(child_key), F.array())))
    return F.transform(nodes, lambda n: field(n, name_path))


def all_names(root: Column, depth: int, child_key: str = "evolves_to",
              name_path: str = "species.name") -> Column:
    """Names of every level concatenated (root first), as ``a || b || c``
    (a missing level counts as empty, never NULL-ing the result)."""
    return concat_arrays(*[level(root, d, child_key, name_path) for d in range(1, depth + 1)])


def family_by_name(trees: DataFrame, family_col: str, names: Column, name_col: str = "name") -> DataFrame:
    """``(name, family)`` with one row per name: the smallest family id whose
    tree contains the name.

    A name in several trees would multiply an entity row in the left join;
    the explicit dedup makes the lookup one-to-one. ``min`` aggregates
    partially, so a name shared by a third of the trees is cheap. ``names`` are those of
    the levels a schema declares; ``family_of_any_depth`` needs no schema.
    """
    return _smallest(trees.select(F.col(family_col).alias("__fam"), F.explode(names).alias(name_col)),
                     family_col, name_col)


def family_of_any_depth(docs: DataFrame, family_col: str, name_col: str = "name", **walk_options) -> DataFrame:
    """``family_by_name`` over ``(id, body)`` documents whose trees may be of any depth."""
    nodes = walk(docs, **walk_options)
    return _smallest(nodes.select(F.col(nodes.columns[0]).alias("__fam"), F.col("name").alias(name_col)),
                     family_col, name_col)


def _smallest(named: DataFrame, family_col: str, name_col: str) -> DataFrame:
    return (named.where(F.col(name_col).isNotNull())
                 .groupBy(name_col).agg(F.min("__fam").alias(family_col)))


def walk(docs: DataFrame, family_col: str = "id", body_col: str = "body", root_path: str = "$.chain",
         child_key: str = "evolves_to", name_path: str = "$.species.name") -> DataFrame:
    """Every node of every tree as ``(family, level, parent, name)``, any depth.

    Shape-agnostic: no maximum depth has to be declared, and the parent edge - lost by a
    flat family id - is kept. Nodes are numbered in one pass over each document
    (``treeorder``), so there is no limit of recursion. A body that is no JSON has no nodes.
    """
    nodes = numbered(docs, family_col, body_col, root_path.removeprefix("$."), child_key, name_path.removeprefix("$."))
    return nodes.select(family_col, "level", F.col("parent_name").alias("parent"), "name")
