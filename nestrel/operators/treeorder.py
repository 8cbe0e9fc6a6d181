"""Trees of any depth as numbered nodes.

A nested document becomes one row per node: ``pre`` (its place in document order, from 1),
``last`` (the place of its last descendant), ``post`` (its place when children come first),
``level`` (the root has 1), the parent's ``pre`` and name, and its own name. With these
numbers a question about a tree is a range condition inside a family:

* the descendants of a are the nodes with ``a.pre < pre <= a.last``,
* its ancestors are those with ``pre < a.pre <= last``,
* leaves have ``pre = last``, a level is an equality, document order is ``pre``.

Nodes are numbered in one pass over a document, held on an explicit stack: no limit of depth, no
subtree copied from level to level, no shuffle. What the JSON reader refuses, say because it
nests too deep for it, is scanned token by token.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"""[ \t\n\r]*(?:("(?:[^"\\\x00-\x1f]|\\.)*")|([{}\[\],:])|(-?[0-9][-+.eE0-9]*|true|false|null))""")
_END = {"{": "}", "[": "]"}


def _refused(constant: str):
    raise ValueError(constant)


# objects come as tuples of (key, value), repeated keys and all; numbers as they are written
_READ = json.JSONDecoder(object_pairs_hook=tuple, parse_float=str, parse_int=str, parse_constant=_refused).decode


def number_nodes(body: str | None, root: Sequence[str], child: str, name: Sequence[str]) -> list[list]:
    """[pre, last, level, parent, name] of every node of one document, in document order.

    The tree's root is the object at the keys ``root``; a node's children are the objects in its
    array ``child``; its name is the value at its keys ``name``. What is no JSON document
    has no nodes.
    """
    try:
        doc = _READ(body or "")
    except (ValueError, RecursionError):
        return scanned_nodes(body, root, child, name)

    def at(objects: list, keys: Sequence[str]) -> list:         # what lies there, in document order
        for key in keys:
            objects = [v for o in objects if type(o) is tuple for k, v in o if k == key]
        return objects

    found: list[list] = []
    todo = [(o, 1, None) for o in reversed(at([doc], root)) if type(o) is tuple] if root else []
    while todo:
        obj, level, up = todo.pop()
        names = [v for v in at([obj], name) if type(v) is not tuple and type(v) is not list]
        value = names[-1] if names else None
        pre = len(found) + 1
        found.append([pre, pre, level, up, str(value).lower() if type(value) is bool else value])
        kids = [(o, level + 1, pre) for k, v in obj if k == child and type(v) is list for o in v if type(o) is tuple]
        kids.reverse()
        todo += kids
    for _, last, _, up, _ in reversed(found):                   # a node ends where its last child does
        if up is not None and found[up - 1][1] < last:
            found[up - 1][1] = last
    return found


def scanned_nodes(body: str | None, root: Sequence[str], child: str, name: Sequence[str]) -> list[list]:
    """The same rows by a scan over the tokens, at any depth."""
    found: list[list] = []
    stack: list[tuple] = []             # open containers: (bracket, key in the one around it, node or None)
    key, want, at = None, "value", 0    # want: value, first (or the end), key, colon, next (or the end)
    text = body or ""

    def keys_from(n: int) -> list:      # keys that lead from the n-th last container to here, None inside an array
        return [c[1] for c in stack[len(stack) - n + 1:]] + [key if stack[-1][0] == "{" else None]

    while True:
        token = _TOKEN.match(text, at)
        if token is None:
            return found if want == "done" and not text[at:].strip(" \t\n\r") else []
        at = token.end()
        string, mark, scalar = token.groups()
        if mark == ":":
            if want != "colon":
                return []
            want = "value"
        elif mark == ",":
            if want != "next":
                return []
            want = "key" if stack[-1][0] == "{" else "value"
        elif mark in ("}", "]"):
            if want not in ("first", "next") or _END[stack[-1][0]] != mark:
                return []
            node = stack.pop()[2]
            if node is not None:
                node[1] = len(found)
            want = "next" if stack else "done"
        elif string and (want == "key" or want == "first" and stack[-1][0] == "{"):
            key, want = json.loads(string), "colon"
        elif want == "value" or want == "first" and stack[-1][0] == "[":
            if mark:
                node, outer = None, stack[-1][2] if stack else None
                if mark == "{" and stack:
                    if stack[-1][0] == "[":
                        up = stack[-2][2] if len(stack) > 1 and stack[-1][1] == child else None
                        if up is not None:
                            node = [len(found) + 1, 0, up[2] + 1, up[0], None]
                    elif len(stack) == len(root) and outer is None and keys_from(len(stack)) == list(root):
                        node = [len(found) + 1, 0, 1, None, None]
                    if node:
                        found.append(node)
                stack.append((mark, key if stack and stack[-1][0] == "{" else None, node))
                want = "first"
            else:
                n = len(name)
                if len(stack) >= n and stack[-n][2] is not None and keys_from(n) == list(name):
                    stack[-n][2][4] = json.loads(string) if string else None if scalar == "null" else scalar
                want = "next" if stack else "done"
        else:
            return []


def numbered(docs: DataFrame, family_col: str = "id", body_col: str = "body", root_path: str = "chain",
             child_key: str = "evolves_to", name_path: str = "species.name") -> DataFrame:
    """The nodes of the trees in ``(family, body)`` documents: family, pre, last, post, level, parent,
    parent_name, name. A NULL or malformed body, or one without a tree, has no nodes; a
    document that repeats has its nodes repeated. Keys that hold a dot cannot be named."""
    kind = docs.schema[family_col].dataType
    root, name = root_path.split("."), name_path.split(".")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            families, bodies = batch.columns
            start, size = 0, 0
            rows: list[list] = []
            of: list[int] = []

            def out():
                cols = list(zip(*rows)) or [()] * 6
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                return pa.RecordBatch.from_arrays(
                    [families.take(pa.array(of, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                    names=["family", "pre", "last", "level", "parent", "parent_name", "name"])

            for start, body in enumerate(bodies):
                nodes = number_nodes(body.as_py(), root, child_key, name)
                rows += [(pre, last, level, up, nodes[up - 1][4] if up else None, n) for pre, last, level, up, n in nodes]
                of += [start] * len(nodes)
                size += len(nodes)
                if size > 50_000:
                    yield out()
                    rows, of, size = [], [], 0
            yield out()

    got = docs.select(F.col(family_col).alias("family"), F.col(body_col).alias("body")).mapInArrow(
        task, f"family {kind.simpleString()}, pre long, last long, level long, parent long, parent_name string, name string")
    return got.select(F.col("family").alias(family_col), "pre", "last", (F.col("last") - F.col("level") + 1).alias("post"),
                      "level", "parent", "parent_name", "name")


def descendants(nodes: DataFrame, of: DataFrame, family_col: str = "id") -> DataFrame:
    """Each node below a node of ``of`` (rows of ``nodes``): family, ancestor_pre, ancestor, pre, name,
    steps (levels between them). Families are joined by their key, the range decides inside."""
    a = of.select(F.col(family_col).alias("of_family"), F.col("pre").alias("ancestor_pre"), F.col("last").alias("of_last"),
                  F.col("level").alias("of_level"), F.col("name").alias("ancestor"))
    met = nodes.join(a, (F.col(family_col) == F.col("of_family")) & (F.col("pre") > F.col("ancestor_pre"))
                     & (F.col("pre") <= F.col("of_last")))
    return met.select(family_col, "ancestor_pre", "ancestor", "pre", "name", (F.col("level") - F.col("of_level")).alias("steps"))


def ancestors(nodes: DataFrame, of: DataFrame, family_col: str = "id") -> DataFrame:
    """Each node above a node of ``of``: family, pre, name (of that node), ancestor_pre, ancestor, steps."""
    d = of.select(F.col(family_col).alias("of_family"), F.col("pre").alias("of_pre"), F.col("level").alias("of_level"),
                  F.col("name").alias("of_name"))
    met = nodes.join(d, (F.col(family_col) == F.col("of_family")) & (F.col("pre") < F.col("of_pre"))
                     & (F.col("last") >= F.col("of_pre")))
    return met.select(family_col, F.col("of_pre").alias("ancestor_of"), F.col("of_name").alias("name"),
                      F.col("pre").alias("ancestor_pre"), F.col("name").alias("ancestor"),
                      (F.col("of_level") - F.col("level")).alias("steps"))


def branches(nodes: DataFrame, family_col: str = "id") -> DataFrame:
    """family, pre, n_children of the nodes with more than one child."""
    return (nodes.where("parent IS NOT NULL").groupBy(family_col, F.col("parent").alias("pre"))
            .agg(F.count(F.lit(1)).alias("n_children")).where("n_children > 1"))


def shapes(nodes: DataFrame, family_col: str = "id") -> DataFrame:
    """One row per family: n_nodes, depth, n_leaves, n_branching (nodes with several children),
    most_children. Aggregated per parent first, then per family."""
    per = nodes.groupBy(family_col, "parent").agg(
        F.count(F.lit(1)).alias("n"), F.max("level").alias("level"), F.count_if(F.col("pre") == F.col("last")).alias("leaves"))
    inner = F.col("parent").isNotNull()
    return per.groupBy(family_col).agg(
        F.sum("n").alias("n_nodes"), F.max("level").alias("depth"), F.sum("leaves").alias("n_leaves"),
        F.count_if(inner & (F.col("n") > 1)).alias("n_branching"),
        F.coalesce(F.max(F.when(inner, F.col("n"))), F.lit(0)).alias("most_children"))
