"""Checks of a batch against a keyed table equal the checks of everything."""

import random

import pytest
from pyspark.sql import functions as F

from nestrel.operators import integrity as I
from nestrel.operators import keystore as KS

SCHEMA = "a long, b string, v int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture()
def tables(spark):
    rng = random.Random(1)
    old = [(i, rng.choice("xy"), i) for i in rng.sample(range(100_000), 3000)]
    new = [(rng.randrange(100_000, 130_000), "x", 1) for _ in range(500)]
    new += [(a, b, 2) for a, b, _ in rng.sample(old, 40)]                       # planted: in the table already
    new += [(5 * 10**12, "x", 1), (5 * 10**12, "x", 2), (-7, "y", 1), (old[0][0], None, 1), (None, "x", 1)]
    return old, new


@pytest.mark.parametrize("keys", [["a", "b"], ["a"], ["b", "a"]])
def test_the_verdict_equals_the_full_check(spark, scratch, tables, keys):
    old, new = tables
    store = KS.open_store(spark, f"{scratch}/s", keys, SCHEMA, span_bits=12)
    assert store.table().count() == 0
    assert store.violations(frame(spark, old)).count() == 0
    assert store.add(frame(spark, old[:2000]), 0) and store.add(frame(spark, old[2000:]), 1) and not store.add(frame(spark, old), 1)
    assert store.table().count() == 3000
    every = frame(spark, old).unionByName(frame(spark, new))
    in_new = {tuple(r[c] for c in map("abv".index, keys)) for r in new}
    want = {tuple(r) for r in I.unique_violations(every, keys, primary=True).collect() if tuple(r)[:-1] in in_new}
    assert {tuple(r) for r in store.violations(frame(spark, new)).collect()} == want and len(want) > 40
    with pytest.raises(KS.DuplicateKeys):
        store.add(frame(spark, new), 2)
    assert store.table().count() == 3000
    good = [r for r in new if r[0] is not None and 100_000 <= r[0] < 130_000]
    good = list({r[0]: r for r in good}.values())
    assert store.add(frame(spark, good), 2) and store.table().count() == 3000 + len(good)


def test_missing_references_equal_the_anti_join(spark, scratch, tables):
    old, _ = tables
    store = KS.open_store(spark, f"{scratch}/s", ["a"], SCHEMA, span_bits=12)
    store.add(frame(spark, old), 0)
    rng = random.Random(2)
    child = spark.createDataFrame([(rng.choice([None, rng.randrange(120_000), old[rng.randrange(3000)][0]]),) for _ in range(900)], "fk int")
    held = {r[0] for r in old}
    want = {}
    for r in child.collect():
        if r.fk is not None and r.fk not in held:
            want[r.fk] = want.get(r.fk, 0) + 1
    assert {r.fk: r.n for r in store.missing(child, ["fk"]).collect()} == want


def test_a_check_reads_the_parts_it_touches_and_no_other(spark, scratch, monkeypatch):
    store = KS.open_store(spark, f"{scratch}/s", ["a"], "a long", span_bits=10)
    store.add(spark.range(100_000).select(F.col("id").alias("a")), 0)
    read = []
    rows = KS.KeyStore._rows
    monkeypatch.setattr(KS.KeyStore, "_rows", lambda self, parts=None: read.append(parts) or rows(self, parts))
    # keys beyond the table, and two that it holds
    batch = spark.range(200_000, 200_500).select(F.col("id").alias("a")).union(spark.createDataFrame([(5,), (70_000,)], "a long"))
    assert {r.a for r in store.violations(batch).collect()} == {5, 70_000}
    assert sorted(read[0]) == [0, 70_000 >> 10]
    plan = store._rows(read[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "key_part" in plan.split("PartitionFilters", 1)[1][:200]
    # the sketch clears most new keys of a part that is in use
    even = KS.open_store(spark, f"{scratch}/e", ["a"], "a long", span_bits=16)
    even.add(spark.range(0, 60_000, 2).select(F.col("id").alias("a")), 0)
    odd = spark.range(1, 60_000, 2).select(F.col("id").alias("a"))
    assert even._maybe(odd, ["a"]).count() < 0.03 * 30_000
    assert even.violations(odd).count() == 0


def test_a_batch_that_died_is_not_seen(spark, scratch, monkeypatch):
    store = KS.open_store(spark, f"{scratch}/s", ["a"], "a long", span_bits=10)
    monkeypatch.setattr(KS, "append_entry", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    some = spark.range(50).select(F.col("id").alias("a"))
    with pytest.raises(RuntimeError):
        store.add(some, 0)
    monkeypatch.undo()
    assert store.table().count() == 0 and store.violations(some).count() == 0
    assert store.add(some, 0) and store.table().count() == 50
