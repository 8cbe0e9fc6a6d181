"""Operator properties checked against brute force on small inputs."""

import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestrel.functions import arrays as A
from nestrel.operators import entries as E
from nestrel.operators import guard as G
from nestrel.operators import integrity as I
from nestrel.operators import relate as R

WORDS = ["water", "rock", "fire", None]


def _py_contains_all(a, b):
    if a is None or b is None:
        return None
    return all(x is not None and x in [y for y in a if y is not None] for x in b)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(WORDS), max_size=3)), min_size=1, max_size=25))
def test_array_predicates_match_relational_rules(spark, arrays):
    probe = ["water", "rock"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "id int, a array<string>")
    out = df.select("id", A.contains_all(F.col("a"), probe).alias("c"),
                    A.contained_by(F.col("a"), probe).alias("b"),
                    A.set_equal(F.col("a"), probe).alias("s")).orderBy("id").collect()
    for r, a in zip(out, arrays):
        c = _py_contains_all(a, probe)
        b = _py_contains_all(probe, a)
        assert r.c == c and r.b == b
        assert r.s == (None if c is None else (c and b))


def test_containment_equals_set_equality_when_size_at_most_two(spark):
    # the workload's observation: with arrays of size <= 2 and a 2-element
    # duplicate-free probe, one-way containment already means set equality
    rows = [(i, random.Random(i).sample(["a", "b", "c"], k=1 + i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a array<string>")
    n_c = df.where(A.contains_all(F.col("a"), ["a", "b"])).count()
    n_s = df.where(A.set_equal(F.col("a"), ["a", "b"])).count()
    n_ab = df.where(A.ordered_equal(F.col("a"), ["a", "b"])).count()
    n_ba = df.where(A.ordered_equal(F.col("a"), ["b", "a"])).count()
    assert n_c == n_s == n_ab + n_ba


def test_histogram_sum_equals_total_size(spark):
    rows = [(i, ["x"] * (i % 3) + ["y"]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, a array<string>")
    h = R.array_histogram(df, "a", "e", "ct").agg(F.sum("ct")).first()[0]
    assert h == df.agg(F.sum(F.size("a"))).first()[0]
    tot = R.canonical_set_histogram(df, "a").agg(F.sum("ct")).first()[0]
    assert tot == df.where(F.col("a").isNotNull()).count()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=6), min_size=1, max_size=60))
def test_rank_by_value_equals_rank(spark, values):
    pdf = pd.DataFrame({"id": range(len(values)), "v": values})
    df = spark.createDataFrame(pdf)
    got = {r.id: r.rk for r in R.rank_by_value(df, "v", "rk").collect()}
    want = pdf.set_index("id")["v"].rank(method="min").astype(int).to_dict()
    assert got == want
    k = 3
    kept = {r.id for r in R.rank_at_most(df, "v", k).collect()}
    assert kept == {i for i, r in want.items() if r <= k}


def test_left_join_count_rows_vs_matched(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,)], "fk int")
    rows = {r.id: r.ct for r in R.left_join_count(left, right, "id", "fk", ["id", "name"]).collect()}
    matched = {r.id: r.ct for r in R.left_join_count(left, right, "id", "fk", ["id", "name"],
                                                       count_rows=False).collect()}
    assert rows == {1: 2, 2: 1, 3: 1}          # count(*) counts the NULL-extended row
    assert matched == {1: 2, 2: 0, 3: 1}


def test_first_entry_forms_agree(spark):
    rng = random.Random(7)
    rows = [(k, p, rng.choice(["en", "fr", None]), f"t{k}-{p}") for k in range(30) for p in range(rng.randint(0, 5))]
    df = spark.createDataFrame(rows, "k int, pos int, lang string, text string")
    want = {}
    for k, p, lang, text in sorted(rows):
        if lang == "en" and k not in want:
            want[k] = text
    got = {r.k: r.value for r in E.first_entry(df, "k", "pos", "text", F.col("lang") == "en").collect()}
    assert got == want
    allk = {r.k: r.value for r in E.first_entry_or_null(df, "k", "pos", "text", F.col("lang") == "en").collect()}
    assert allk == {k: want.get(k) for k in {r[0] for r in rows}}
    # in-row form on arrays gives the same answers
    arr = df.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("pos", "lang", "text"))).alias("e"))
    inrow = {r.k: r.v for r in arr.select("k", E.first_in_array(
        F.col("e"), lambda e: e.lang == "en", lambda e: e.text).alias("v")).collect()}
    assert inrow == {k: want.get(k) for k in {r[0] for r in rows}}


def test_assign_ids_dense_and_ordered(spark):
    keys = random.Random(3).sample(range(10_000), 500)
    batch = spark.createDataFrame([(k,) for k in keys], "k long")
    existing = spark.createDataFrame([(5,), (41,)], "id long")
    out = I.assign_ids(batch, "k", existing, "id", buckets=8).collect()
    got = sorted((r.k, r.id) for r in out)
    assert [i for _, i in got] == list(range(42, 42 + 500))
    empty = spark.createDataFrame([], "id long")
    assert sorted(r.id for r in I.assign_ids(batch.limit(3), "k", empty, "id").collect()) == [1, 2, 3]


def test_integrity_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None), (13, 2)], "id int, fk int")
    assert [r.id for r in I.fk_orphans(child, "fk", parent, "pk").collect()] == [11]
    gone = spark.createDataFrame([(2,)], "pk int")
    assert sorted(r.id for r in I.cascade_delete(child, "fk", gone, "pk").collect()) == [10, 11, 12]
    dup = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    assert I.unique_violations(dup, ["a", "b"]).count() == 1
    assert I.unique_violations(dup, ["a", "b"], primary=True).count() == 2
    dom = spark.createDataFrame([(1, "abcdef"), (2, None), (3, "ab")], "id int, s string")
    v = {(r.id, r.rule) for r in I.domain_violations(dom, ["id"], {"s": {"not_null": True, "max_len": 5}}).collect()}
    assert v == {(1, "max_len_5"), (2, "not_null")}


def test_capacity_guards_boundaries(spark, scratch):
    existing = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "tid int, mid int")
    ok_batch = spark.createDataFrame([(1, 13), (2, 14)], "tid int, mid int")
    over = spark.createDataFrame([(1, 13), (1, 14)], "tid int, mid int")
    v = G.capacity_check(existing, ok_batch, "tid", 3).first()
    assert v.accepted and v.max_total == 3              # exactly the limit is accepted
    assert not G.capacity_check(existing, over, "tid", 3).first().accepted
    empty = spark.createDataFrame([], "tid int, mid int")
    e = G.capacity_check(empty, empty, "tid", 0).first()
    assert e.max_total == 0 and e.accepted              # empty table: max defaults to 0
    assert G.table_capacity(existing, ok_batch, 5).first().accepted
    assert not G.table_capacity(existing, over, 4).first().accepted
    assert [r.tid for r in G.capacity_violations(existing, "tid", 1).collect()] == [1]
    # all-or-nothing append, then truncate
    path = f"{scratch}/trainer_moves"
    existing.write.parquet(path)
    assert not G.guarded_append(over, G.capacity_check(existing, over, "tid", 3), path)
    assert spark.read.parquet(path).count() == 3
    assert G.guarded_append(ok_batch, G.capacity_check(existing, ok_batch, "tid", 3), path)
    assert spark.read.parquet(path).count() == 5
    G.truncate_cascade(spark, [(path, existing.schema)])
    assert spark.read.parquet(path).count() == 0


def test_per_key_numbering_splits_hot_keys_exactly(spark):
    rng = random.Random(11)
    # key 0 holds about a third of the rows; ties in the order column
    rows = [(0 if rng.random() < 0.34 else rng.randint(1, 40), rng.randint(0, 50), i) for i in range(900)]
    pdf = pd.DataFrame(rows, columns=["k", "pos", "uid"])
    df = spark.createDataFrame(pdf)
    rk = {r.uid: r.rk for r in E.rank_per_key(df, "k", ["pos"], buckets=8).collect()}
    want_rk = pdf.groupby("k")["pos"].rank(method="min").astype(int)
    assert rk == dict(zip(pdf.uid, want_rk))
    rn = E.row_number_per_key(df, "k", ["pos", "uid"], buckets=8).collect()
    want_rn = pdf.sort_values(["k", "pos", "uid"]).groupby("k").cumcount() + 1
    assert {r.uid: r.rn for r in rn} == dict(zip(pdf.sort_values(["k", "pos", "uid"]).uid, want_rn))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-50, max_value=50, allow_nan=False)), min_size=1, max_size=80),
       st.booleans())
def test_rank_by_ranges_equals_rank(spark, values, desc):
    pdf = pd.DataFrame({"id": range(len(values)), "v": values})
    df = spark.createDataFrame(pdf, "id long, v double")
    got = {r.id: r.rk for r in R.rank_by_value(df, "v", "rk", descending=desc, method="ranges", buckets=5).collect()}
    hist = {r.id: r.rk for r in R.rank_by_value(df, "v", "rk", descending=desc).collect()}
    want = pdf.set_index("id")["v"].rank(method="min", ascending=not desc, na_option="bottom" if not desc else "top")
    assert got == hist == want.astype(int).to_dict()


def test_rank_nulls_follow_relational_order(spark):
    rows = [(0, None), (1, 3.0), (2, 1.0), (3, None), (4, 3.0)]
    df = spark.createDataFrame(rows, "id long, v double")
    for method in ("histogram", "ranges"):
        asc = {r.id: r.rk for r in R.rank_by_value(df, "v", method=method, buckets=3).collect()}
        desc = {r.id: r.rk for r in R.rank_by_value(df, "v", descending=True, method=method, buckets=3).collect()}
        assert asc == {2: 1, 1: 2, 4: 2, 0: 4, 3: 4}, method      # NULLS LAST ascending
        assert desc == {0: 1, 3: 1, 1: 3, 4: 3, 2: 5}, method     # NULLS FIRST descending


def test_distinct_sorted(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (3,), (2,)], "k int")
    assert [r.k for r in R.distinct_sorted(df, "k").collect()] == [1, 2, 3]


def test_per_key_numbering_hot_key_with_one_order_value(spark):
    # key 0 holds half the rows and almost all of them share pos = 5
    rows = [(0, 5, i) for i in range(500)] + [(0, 7, 500), (0, 1, 501)] + \
           [(k, k % 9, 600 + k) for k in range(1, 300)]
    pdf = pd.DataFrame(rows, columns=["k", "pos", "uid"])
    df = spark.createDataFrame(pdf)
    rk = {r.uid: r.rk for r in E.rank_per_key(df, "k", ["pos"], buckets=8).collect()}
    assert rk == dict(zip(pdf.uid, pdf.groupby("k")["pos"].rank(method="min").astype(int)))
    rn = E.row_number_per_key(df, "k", ["pos"], buckets=8).toPandas().sort_values(["k", "rn"])
    for k, g in rn.groupby("k"):
        assert list(g.rn) == list(range(1, len(g) + 1))          # dense 1..n per key
        assert list(g.pos) == sorted(g.pos)                        # consistent with the order


def test_adhoc_sql_over_registered_views(spark):
    from nestrel.sources.tables import adhoc_sql, register_views
    from tests.conftest import SF_SMALL
    register_views(spark, SF_SMALL, ["part"])
    sql = """SELECT type, count(*) AS ct
             FROM (SELECT explode(split(p_name, ' ')) AS type FROM part) AS tb
             GROUP BY type ORDER BY ct DESC"""
    got = {r["type"]: r["count"] for r in adhoc_sql(spark, sql, ["type", "count"]).collect()}
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").select(F.split("p_name", " ").alias("t"))
    want = {r.e: r.ct for r in R.array_histogram(part, "t", "e", "ct").collect()}
    assert got == want


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=12), min_size=1, max_size=15, unique=True),
       st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=15)), max_size=60))
def test_left_join_count_matches_brute_force(spark, left_ids, right_keys):
    left = pd.DataFrame({"id": left_ids, "name": [f"n{i}" for i in left_ids]})
    right = pd.DataFrame({"fk": pd.array(right_keys, dtype="Int64")})
    ldf = spark.createDataFrame(left, "id long, name string")
    rdf = spark.createDataFrame([(k,) for k in right_keys], "fk long")
    merged = left.merge(right, left_on="id", right_on="fk", how="left")
    want_rows = merged.groupby("id").size().to_dict()                    # count(*)
    want_matched = merged.groupby("id")["fk"].count().to_dict()          # count(fk)
    got_rows = {r.id: r.ct for r in R.left_join_count(ldf, rdf, "id", "fk", ["id", "name"]).collect()}
    got_matched = {r.id: r.ct for r in R.left_join_count(ldf, rdf, "id", "fk", ["id", "name"],
                                                           count_rows=False).collect()}
    assert got_rows == want_rows and got_matched == want_matched


def test_numbering_equals_the_plain_window(spark):
    from pyspark.sql import Window

    rows = [(None if i % 7 == 0 else f"k{i % 3}", None if i % 11 == 0 else 1_700_000_000_000_000_000 + i % 97, i)
            for i in range(700)]
    df = spark.createDataFrame(rows, "k string, ns long, uid long")
    df = df.withColumn("ts", F.timestamp_micros(F.col("ns") % 1_000_000)).withColumn("s", F.col("ns").cast("string"))
    for col in ("ns", "ts", "s"):
        w = Window.partitionBy("k").orderBy(F.col(col).asc_nulls_last())
        want = {r.uid: r.x for r in df.select("uid", F.rank().over(w).alias("x")).collect()}
        for buckets in (8, 64):
            got = {r.uid: r.rk for r in E.rank_per_key(df, "k", [col], split_hot_keys=True, buckets=buckets).collect()}
            assert got == want
        w = w.orderBy(F.col(col).asc_nulls_last(), "uid")
        want = {r.uid: r.x for r in df.select("uid", F.row_number().over(w).alias("x")).collect()}
        got = {r.uid: r.rn for r in E.row_number_per_key(df, "k", [col, "uid"], split_hot_keys=True, buckets=16).collect()}
        assert got == want
