"""Nothing is lost without notice: deep trees, long walks, malformed documents, cascades, probes."""

import json

from pyspark.sql import functions as F

from nestrel.functions import arrays as A
from nestrel.operators import integrity as I
from nestrel.operators import tree as TR
from nestrel.plans import etl
from nestrel.plans import pipelines as P
from nestrel.plans import shapes as SH
from tests.test_reference_fixtures import EVO, LISTING, MOVES, POKEMON, SPECIES, docs


def chain(names):
    node = {"species": {"name": names[-1]}, "evolves_to": []}
    for n in reversed(names[:-1]):
        node = {"species": {"name": n}, "evolves_to": [node]}
    return node


SEVEN = [f"level{i}" for i in range(1, 8)]


def test_trees_of_any_depth_lose_no_name(spark):
    trees = docs(spark, [{"id": 77, "chain": chain(SEVEN)}], [(5, "no json"), (6, None)])
    fam = TR.family_of_any_depth(trees, "evo_set").collect()
    assert sorted((r.name, r.evo_set) for r in fam) == [(n, 1) for n in SEVEN]
    entities = docs(spark, [{"id": i, "species": {"name": n}} for i, n in enumerate(SEVEN)])
    out = P.entity_table(entities, SH.ENTITY, trees, None, None, None, None).collect()
    assert [r.evo_set for r in out] == [77] * 7


def test_walk_has_no_row_limit(spark):
    trees = docs(spark, [{"id": i, "chain": chain(SEVEN)} for i in range(30)])
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "20")
    try:
        assert TR.walk(trees).count() == 210
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)


def test_malformed_documents_are_kept_in_quarantine(spark, scratch):
    bad = [(90, '{"id": 9, "na'), (91, None)]
    staged = {"entity": docs(spark, POKEMON, bad), "texts": docs(spark, SPECIES, bad),
              "trees": docs(spark, EVO, bad), "listing": docs(spark, LISTING, bad)}
    store = {"move": docs(spark, MOVES, bad), "ability": docs(spark, [], bad)}
    report = etl.run(spark, staged, lambda kind, manifest: store[kind], f"{scratch}/db").collect()
    assert {r.rule: r.violations for r in report}["malformed documents"] == 12
    assert {r.rule for r in report} >= {f"unique:{n}.name" for n in ("pokedex", "types", "moves", "abilities")}
    held = spark.read.parquet(f"{scratch}/db/quarantine").collect()
    assert sorted((r.source, r.id) for r in held) == sorted(
        (s, i) for s in ("entity", "texts", "trees", "listing", "move", "ability") for i in ("90", "91"))
    assert spark.read.parquet(f"{scratch}/db/moves").where("id IS NULL").isEmpty()
    assert spark.read.parquet(f"{scratch}/db/abilities").isEmpty()
    assert spark.read.parquet(f"{scratch}/db/pokedex").count() == 3


def test_missing_paths_give_no_pair(spark):
    body = json.dumps({"id": 1, "moves": [{"x": 1}, {"move": {"url": "https://a/move/7/"}}, {"move": {}}]})
    ent = spark.createDataFrame([(1, body)], "id int, body string")
    assert [tuple(r) for r in P.bridge_table(ent, SH.ENTITY, "moves", "move.url", "move_id").collect()] == [(1, 7)]


def test_cascade_walks_the_key_graph(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    tables = {"kind": df([(1,), (2,)], "k int"), "item": df([(10, 1), (11, 2), (12, None)], "i int, k int"),
              "owner": df([(5, 1), (6, 2)], "o int, k int"),
              "owned": df([(5, 11), (6, 10), (6, 11), (None, 12), (6, 12)], "o int, i int"), "other": df([(1,)], "z int")}
    keys = [("item", "k", "kind", "k"), ("owner", "k", "kind", "k"), ("owned", "i", "item", "i"), ("owned", "o", "owner", "o")]
    kept = I.cascade_along(tables, keys, "kind", tables["kind"].where("k = 1"))
    assert set(kept) == {"item", "owner", "owned"}
    assert sorted(r.i for r in kept["item"].collect()) == [11, 12]
    assert sorted(((r.o, r.i) for r in kept["owned"].collect()), key=str) == [(6, 11), (6, 12), (None, 12)]


def test_literal_and_column_probes_agree(spark):
    arrays = [["a"], ["a", "b"], ["b", "a", "a"], ["a", None], [], None, [None]]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, a array<string>")
    for probe in (["a"], ["a", "b"], ["b", "a"], [], ["c"]):
        col = F.array(*map(F.lit, probe)) if probe else F.array().cast("array<string>")
        a = F.col("a")
        rows = df.select(A.contains_all(a, probe), A.contains_all(a, col), A.contained_by(a, probe),
                         A.contained_by(a, col), A.set_equal(a, probe), A.set_equal(a, col)).collect()
        for r in rows:
            assert r[0] is r[1] and r[2] is r[3] and r[4] is r[5], (probe, r)
    assert [r[0] for r in df.select(A.contains_all(F.col("a"), [None])).collect()] == [False] * 5 + [None, False]
