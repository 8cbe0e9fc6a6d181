"""Numbered trees against a recursive plain version; trees deeper than any recursion limit."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestrel.operators import tree as TR
from nestrel.operators import treeorder as TO

ROOT, CHILD, NAME = ["chain"], "evolves_to", ["species", "name"]


def plain(body):
    """The same rows by recursion over the parsed document."""
    try:
        doc = json.loads(body)
    except (TypeError, ValueError):
        return []
    out = []

    def visit(node, level, parent):
        row = [len(out) + 1, 0, level, parent, None]
        out.append(row)
        species = node.get("species")
        if isinstance(species, dict):
            row[4] = species.get("name")
        for child in node.get("evolves_to") or []:
            if isinstance(child, dict):
                visit(child, level + 1, row[0])
        row[1] = len(out)

    if isinstance(doc, dict) and isinstance(doc.get("chain"), dict):
        visit(doc["chain"], 1, None)
    return out


def node(name, children=(), rng=None):
    fields = [("species", {"name": name, "url": "x{}[]\"\\"}), ("evolves_to", list(children)),
              ("evolution_details", [{"trigger": {"name": "level-up"}, "evolves_to": None, "item": [1, -2.5e3, True, []]}]), ("is_baby", False)]
    if rng:
        rng.shuffle(fields)
    return dict(fields)


def random_tree(rng, depth):
    return node(rng.choice(["a", "b\"c", "d\\", "{e}", "f\né\U0001F600", None, ""]),
                [random_tree(rng, depth - 1) for _ in range(rng.randrange(4))] if depth else [], rng)


def test_numbers_equal_the_recursive_version():
    rng = random.Random(1)
    for _ in range(200):
        doc = {"id": 1, "baby_trigger_item": None, "chain": random_tree(rng, 4), "more": {"chain": node("no")}}
        body = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        assert TO.number_nodes(body, ROOT, CHILD, NAME) == plain(body)


@pytest.mark.parametrize("body", [None, "", "{", "[]", "1", "null", '{"chain": null}', '{"chain": []}', '{"chain": {}} x', '{"chain": {},}',
                                  '{"chain": {"evolves_to": [,]}}', '{"chain" {}}', '{chain: {}}', '{"chain": {}]', "[{}", '{"a": {"chain": {}}}',
                                  '{"chain": {"evolves_to": [1, null, "x", [{}], {}]}}', '{"chain": {}}', ' {"chain" : {"species" : "x"} } '])
def test_odd_documents(body):
    assert TO.number_nodes(body, ROOT, CHILD, NAME) == plain(body)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from('{}[]",:\\ an1')))
def test_any_text_is_scanned(body):
    got = TO.number_nodes('{"chain":' + body + "}", ROOT, CHILD, NAME)
    assert got == plain('{"chain":' + body + "}") or got == []


def deep(n):
    body = "".join('{"species":{"name":"n%d"},"evolves_to":[' % i for i in range(n)) + "]}" * n
    return '{"id":1,"chain":' + body + "}"


def test_depth_of_thousands(spark):
    df = spark.createDataFrame([(1, deep(1000)), (2, deep(20_000)), (3, "{"), (4, None)], "id long, body string")
    nodes = TO.numbered(df)
    got = {r.id: r for r in TO.shapes(nodes).collect()}
    assert {i: (r.n_nodes, r.depth, r.n_leaves, r.n_branching, r.most_children) for i, r in got.items()} == {
        1: (1000, 1000, 1, 0, 1), 2: (20_000, 20_000, 1, 0, 1)}
    some = TO.descendants(nodes, nodes.where("id = 1 AND name = 'n990'")).collect()
    assert sorted((r.name, r.steps) for r in some) == [(f"n{990 + k}", k) for k in range(1, 10)]
    up = TO.ancestors(nodes, nodes.where("id = 2 AND name = 'n5'")).collect()
    assert sorted((r.ancestor, r.steps) for r in up) == [(f"n{k}", 5 - k) for k in range(5)]
    assert TR.walk(df).where("level = 1000 AND parent = 'n998'").count() == 2
    assert {r.name: r.id for r in TR.family_of_any_depth(df, "id").where("name IN ('n5', 'n15000')").collect()} == {"n5": 1, "n15000": 2}


def test_intervals_say_what_the_tree_says(spark):
    rng = random.Random(7)
    docs = [(i, json.dumps({"chain": random_tree(rng, 4)})) for i in range(40)]
    df = spark.createDataFrame(docs + [docs[0]], "id long, body string").dropDuplicates().repartition(3)
    nodes = TO.numbered(df)
    rows = {(r.id, r.pre): r for r in nodes.collect()}
    assert len(rows) == sum(len(plain(b)) for _, b in docs)
    up = {k: (k[0], r.parent) if r.parent else None for k, r in rows.items()}

    def above(k):
        while up[k]:
            k = up[k]
            yield k

    want = {(*a, k[1]) for k in rows for a in above(k)}
    assert {(r.id, r.ancestor_pre, r.pre) for r in TO.descendants(nodes, nodes).collect()} == want
    assert {(r.id, r.ancestor_pre, r.ancestor_of) for r in TO.ancestors(nodes, nodes).collect()} == want
    # post order: children first
    for i, _ in docs:
        mine = [r for k, r in rows.items() if k[0] == i]
        assert sorted(r.post for r in mine) == list(range(1, len(mine) + 1))
        assert all(rows[i, r.parent].post > r.post and rows[i, r.parent].level == r.level - 1 for r in mine if r.parent)
    kids = {}
    for k, p in up.items():
        if p:
            kids[p] = kids.get(p, 0) + 1
    assert {(r.id, r.pre): r.n_children for r in TO.branches(nodes).collect()} == {k: n for k, n in kids.items() if n > 1}
    assert nodes.where(F.col("parent_name").isNotNull()).count() > 0


def test_parsed_and_scanned_documents_have_the_same_nodes():
    """Odd keys, repeated keys, numbers as they are written, escapes the reader refuses."""
    odd = ['{"chain":{"species":{"name":1.50,"name":"b"},"species":{"name":-2e3}},"chain":{"species":{"name":true},"evolves_to":[{}],"evolves_to":[{"species":[]}]}}',
           '{"chain":{"species":{"name":"\\q"}}}', '{"chain":{"x":"\\q","evolves_to":[{"species":{"name":1-2}}]}}', '{"chain":{"x":NaN}}', '{"chain":{"species":{"name":01}}}',
           '{"chain":[{"species":{"name":"a"}}]}', '{"chain":{"evolves_to":{"evolves_to":[{}]}}}', '{"chain":{"evolves_to":[[{}],{"species":{"name":null}}]}}']

    def got(f, body):
        try:
            return f(body, ROOT, CHILD, NAME)
        except ValueError as e:
            return type(e)
    assert [got(TO.number_nodes, b) for b in odd] == [got(TO.scanned_nodes, b) for b in odd]
    assert TO.number_nodes(odd[0], ROOT, CHILD, NAME) == [[1, 1, 1, None, "-2e3"], [2, 4, 1, None, "true"], [3, 3, 2, 2, None], [4, 4, 2, 2, None]]
    assert TO.number_nodes(deep(20_000), ROOT, CHILD, NAME) == TO.scanned_nodes(deep(20_000), ROOT, CHILD, NAME)


def test_descendants_number_each_document_once(spark):
    from nestrel.plans import catalog as C
    from tests.conftest import SF_SMALL
    p = C.QUERIES["tree_descendants"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in p and "Join" in p            # before: the numbering ran on both sides of the join
