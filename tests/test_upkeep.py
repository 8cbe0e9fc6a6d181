"""Published versions, block postings, index segments, numbering by ranges, slices, foreign keys."""

import datetime as dt
import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from nestrel.operators import blocks as B
from nestrel.operators import entries as E
from nestrel.operators import integrity as I
from nestrel.operators import numbering as N
from nestrel.operators import relate as R
from nestrel.operators import search as FTS
from nestrel.operators import segments as SG
from nestrel.sources import publish as PB


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ publishing
def test_readers_move_when_a_version_is_published_and_only_then(spark, scratch):
    def build(rows, violations=0, rule="pk", dies=False):
        def run(path):
            spark.createDataFrame(rows, "id int").write.parquet(f"{path}/t")
            if dies:
                raise RuntimeError("lost")
            return spark.createDataFrame([(rule, violations), ("fk", 0)], "rule string, violations long")
        return run

    root = f"{scratch}/db"
    assert PB.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        PB.read(spark, root, "t")
    first = PB.publish(spark, root, build([(1,)]))
    assert [r.id for r in PB.read(spark, root, "t").collect()] == [1]
    reader = PB.read(spark, root, "t")
    with pytest.raises(PB.NotPublished, match="pk: 3") as e:
        PB.publish(spark, root, build([(2,)], 3))
    assert e.value.report == [("pk", 3)]
    with pytest.raises(RuntimeError):
        PB.publish(spark, root, build([(3,)], dies=True))
    assert PB.current(spark, root) == first and [r.id for r in PB.read(spark, root, "t").collect()] == [1]
    second = PB.publish(spark, root, build([(4,)], 3, "malformed documents"), tolerated=["malformed documents"])
    assert [r.id for r in PB.read(spark, root, "t").collect()] == [4] and [r.id for r in reader.collect()] == [1]
    assert PB.superseded(spark, root) == [first] and PB.current(spark, root) == second


# ------------------------------------------------------------------ block postings
def postings(spark, n=4000):
    rng = random.Random(1)
    rows = [("hot", i) for i in range(n)] + [("even", 2 * i) for i in range(n // 2)] + [("far", 10**12 + i) for i in range(5)]
    rows += [(f"t{rng.randrange(40)}", rng.randrange(-50, n)) for _ in range(3000)] + [("hot", 3), (None, 1), ("t1", None)]
    return rows, spark.createDataFrame(rows, "term string, id long").repartition(6)


def test_blocks_hold_every_posting_once(spark):
    rows, df = postings(spark)
    want = {r for r in rows if None not in r}
    blocks = B.build_blocks(df, "term", "id", span_bits=6)
    got = blocks.select("term", F.explode(B.ids_of(F.col("low"), F.col("steps"))).alias("id")).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    for r in blocks.collect():
        assert r.n_ids == len(r.steps) <= 64 and r.low + r.steps[-1] == r.high and r.block == r.low >> 6 == r.high >> 6
    assert B.build_blocks(df.limit(0), "term", "id").count() == 0
    with pytest.raises(ValueError):
        B.build_blocks(df, "term", "id", span_bits=16)


def test_no_task_holds_a_hot_term_alone_and_lookups_skip(spark, scratch):
    rows, df = postings(spark)
    held = B.build_blocks(df, "term", "id", span_bits=6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spread = held.where("term = 'hot'").select(F.spark_partition_id().alias("p"), "n_ids").groupBy("p").agg(F.sum("n_ids").alias("n")).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and max(r.n for r in spread) < 4000
    B.write_blocks(held, f"{scratch}/blocks", "term", partitions=6)
    FTS.write_index(df.dropna().distinct(), f"{scratch}/flat", partitions=6)
    flat, blocks = spark.read.parquet(f"{scratch}/flat"), spark.read.parquet(f"{scratch}/blocks")
    assert flat.where("term = 'hot'").select(F.input_file_name().alias("f")).distinct().count() > 1     # in many files
    assert blocks.where("term = 'hot'").count() * 20 < flat.where("term = 'hot'").count()


@pytest.mark.parametrize("probe", [["hot", "even"], ["hot", "t3", "t7"], ["even", "far"], ["t1"], ["none", "hot"], ["hot", "hot"]])
def test_containment_by_blocks_equals_sets(spark, probe):
    rows, df = postings(spark)
    of = defaultdict(set)
    for t, i in rows:
        if t and i is not None:
            of[t].add(i)
    blocks = B.build_blocks(df, "term", "id", span_bits=7)
    for fn, want in ((B.containing_all, set.intersection(*[of[t] for t in probe])), (B.containing_any, set.union(*[of[t] for t in probe]))):
        got = [r.id for r in fn(blocks, probe, "term").collect()]
        assert len(got) == len(want) and set(got) == want


# ------------------------------------------------------------------ segments
def changes(spark, rows):
    return spark.createDataFrame(rows, SG.CHANGES)


BATCHES = [[(1, "red fish", None, 1), (2, "blue fish", False, 1), (None, "red", False, 1), (3, None, False, 1)],
           [(4, "red bird", False, 1), (2, "green bird", False, 2), (5, "old", False, 1), (5, "red fox", False, 2)],
           [(1, None, True, 1), (6, "red", False, 1), (6, None, True, 2), (7, "fish fish", False, 1)],
           [(1, "blue again", False, 1), (4, None, True, 1), (99, None, True, 1)]]


def live(batches):
    texts = {}
    for batch in batches:
        for i in {r[0] for r in batch if r[0] is not None}:
            _, text, deleted, _ = max((r for r in batch if r[0] == i), key=lambda r: r[3])
            texts.pop(i, None)
            if not deleted:
                texts[i] = text
    return {(w, i) for i, t in texts.items() for w in (t or "").split() if w != "again"}


@pytest.mark.parametrize("merge_after", [(), (1,), (0, 1, 2, 3)])
def test_segments_equal_a_rebuild_after_every_batch(spark, scratch, merge_after):
    root = f"{scratch}/index"
    assert SG.postings(spark, root).count() == 0 and not SG.merge(spark, root)
    for n, batch in enumerate(BATCHES):
        assert SG.apply_changes(changes(spark, batch), root, n)
        want = live(BATCHES[:n + 1])
        got = [tuple(r) for r in SG.postings(spark, root).where("term <> 'again'").collect()]
        assert len(got) == len(want) and set(got) == want
        assert {r.id for r in SG.search(spark, root, "red | fish").collect()} == {i for w, i in want if w in ("red", "fish")}
        for replayed in range(n + 1):                                # a replay changes nothing
            assert not SG.apply_changes(changes(spark, BATCHES[replayed]), root, replayed)
        if n in merge_after:
            assert SG.merge(spark, root, partitions=2)
        assert {tuple(r) for r in SG.postings(spark, root).where("term <> 'again'").collect()} == want


def test_a_batch_that_died_half_way_is_not_seen_and_can_be_repeated(spark, scratch, monkeypatch):
    root = f"{scratch}/index"
    SG.apply_changes(changes(spark, BATCHES[0]), root, 0)
    monkeypatch.setattr(SG, "append_entry", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        SG.apply_changes(changes(spark, BATCHES[1]), root, 1)
    monkeypatch.undo()
    assert {tuple(r) for r in SG.postings(spark, root).collect()} == live(BATCHES[:1])
    assert SG.apply_changes(changes(spark, BATCHES[1]), root, 1)
    assert {tuple(r) for r in SG.postings(spark, root).collect()} == live(BATCHES[:2])


def test_a_stream_feeds_the_index(spark, scratch):
    root, source = f"{scratch}/index", f"{scratch}/in"
    for n, batch in enumerate(BATCHES):
        changes(spark, batch).coalesce(1).write.mode("append").parquet(source)
        SG.feed(spark, source, root, f"{scratch}/checkpoint", merge_every=2, max_files_per_trigger=1).awaitTermination()
        assert {tuple(r) for r in SG.postings(spark, root).where("term <> 'again'").collect()} == live(BATCHES[:n + 1])
    assert any("base" in e for e in PB.entries(spark, f"{root}/ledger"))


# ------------------------------------------------------------------ numbering
def test_ids_over_text_date_and_composite_keys(spark):
    rng = random.Random(2)
    rows = [(f"k{rng.randrange(3)}", dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randrange(400)), i) for i in range(500)] + \
        [(None, None, 500), ("k1", None, 501)]
    df = spark.createDataFrame(rows, "k string, d timestamp, u int").repartition(5)
    low = dt.datetime.min
    for by in (["k", "d", "u"], ["d", "u"], ["u"]):
        at = [("k", "d", "u").index(c) for c in by]
        want = sorted(rows, key=lambda r: [(r[j] is not None, r[j] if r[j] is not None else (low if j == 1 else "")) for j in at])
        got = {r.u: r.id for r in I.assign_ids(df, by, 10, "id", buckets=7).collect()}
        assert got == {r[2]: 11 + n for n, r in enumerate(want)}
    assert "quantile" not in plan_of(I.assign_ids(df, "u", 0)).lower()
    assert sorted(r.id for r in I.assign_ids(df.select(F.lit(1).alias("one")), "one", 0, buckets=4).collect()) == list(range(1, 503))
    assert I.assign_ids(df.limit(0), "k", 5).count() == 0


def test_a_hot_first_value_is_numbered_by_many_tasks(spark):
    rows = [("hot" if i % 3 else f"k{i % 50}", 7, i, (i * 7919) % 2000) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, first int, u int, second int")
    placed = N.ranged(df, [F.col("k").asc(), F.col("first").asc(), F.col("second").asc()], 8)
    assert placed.where("k = 'hot'").select(N.PART).distinct().count() >= 4
    pdf = pd.DataFrame(rows, columns=["k", "first", "u", "second"]).sort_values(["k", "first", "second"])
    want = dict(zip(pdf.u, pdf.groupby("k").cumcount() + 1))
    assert {r.u: r.rn for r in E.row_number_per_key(df, "k", ["first", "second"], buckets=8).collect()} == want
    assert {r.u: r.rk for r in E.rank_per_key(df, "k", ["first", "second"], buckets=8).collect()} == want
    # full ties: row numbers are dense per key, ranks are all one
    got = E.row_number_per_key(df, "k", ["first"], buckets=8).collect()
    for k, some in pd.DataFrame([(r.k, r.rn) for r in got]).groupby(0):
        assert sorted(some[1]) == list(range(1, len(some) + 1)), k
    assert {r.rk for r in E.rank_per_key(df, "k", ["first"], buckets=8).collect()} == {1}


# ------------------------------------------------------------------ slices
@pytest.mark.parametrize("start, stop", [(0, 5), (37, 61), (195, 300), (400, 500), (50, 50)])
def test_key_slice_is_the_slice(spark, start, stop):
    ids = random.Random(3).sample(range(10**6), 200)
    df = spark.createDataFrame([(i, i // 1000, f"x{i}") for i in ids], "id long, g long, t string").repartition(7)
    want = sorted(ids)[start:stop]
    assert sorted(r.id for r in R.key_slice(df, ["id"], start, stop, parts=6).collect()) == want
    assert sorted(r.id for r in R.key_slice(df, ["g", "id"], start, stop, parts=6).collect()) == want


def test_key_slice_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (3, 1), (1, None), (1, 5), (2, 0)], "a int, b int")
    assert {tuple(r) for r in R.key_slice(df, ["a", "b"], 0, 2, parts=3).collect()} == {(None, 1), (1, None)}
    assert {tuple(r) for r in R.key_slice(df, ["a", "b"], 2, 4, parts=3).collect()} == {(1, 5), (2, 0)}


def test_a_deep_slice_reads_its_range_only(spark, scratch):
    spark.range(5000).select("id", F.repeat(F.lit("x"), 50).alias("text")).write.parquet(f"{scratch}/t")
    got = R.key_slice(spark.read.parquet(f"{scratch}/t"), ["id"], 4000, 4010, parts=8)
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,4000), LessThanOrEqual(id,4009)]" in plan_of(got)
    assert "Sort" not in plan_of(got) and got.count() == 10


# ------------------------------------------------------------------ foreign keys
def test_foreign_keys_in_one_aggregation(spark):
    rng = random.Random(4)
    child = [(rng.choice([None, 1, 2, 3, 99, 99]), rng.choice([None, 10, 20, 30])) for _ in range(300)]
    tables = {"c": spark.createDataFrame(child, "a long, b int"), "p": spark.createDataFrame([(1, 10), (2, None), (2, 7)], "id int, up long"),
              "q": spark.createDataFrame([(10,), (None,)], "id long"), "e": spark.createDataFrame([], "x int")}
    keys = [("c", "a", "p", "id"), ("c", "b", "q", "id"), ("p", "up", "q", "id"), ("e", "x", "q", "id"), ("q", "id", "e", "x")]
    out = I.fk_orphan_counts(tables, keys)
    one_by_one = {(c, f): I.fk_orphan_count(tables[c], f, tables[p], k).first()[0] for c, f, p, k in keys}
    assert {(r.child, r.fk): r.orphans for r in out.collect()} == one_by_one
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == len(tables)     # each read once
    text = {"c": tables["c"], "p": tables["p"].select(F.col("id").cast("string").alias("id"))}
    assert I.fk_orphan_counts(text, [("c", "a", "p", "id")]).first().orphans == one_by_one["c", "a"]


# ------------------------------------------------------------------ pages
def test_pages_are_the_sorted_rows(spark):
    rows = sorted((i // 7, i * 31 % 101, f"x{i}") for i in range(101))
    df = spark.createDataFrame(rows, "a int, b int, t string").repartition(5)
    got, after = [], None
    while True:
        page, after = R.client_page(df, ["a", "b"], 20, after)
        assert page.num_rows <= 20
        got += [tuple(r.values()) for r in page.to_pylist()]
        if after is None:
            break
    assert got == rows
    directory = sorted(tuple(r) for r in R.page_directory(df, ["a", "b"], 20, parts=4).collect())
    assert [(p, n, tuple(x), tuple(y)) for p, n, x, y in directory] == [
        (i, len(some), some[0][:2], some[-1][:2]) for i, some in enumerate(rows[k:k + 20] for k in range(0, 101, 20))]
    assert R.client_page(df.limit(0), ["a"], 5)[1] is None and R.page_directory(df.limit(0), ["a"], 5).count() == 0
    plan = plan_of(df.where((F.col("a") >= 3)).orderBy("a", "b").limit(21))
    assert "TakeOrderedAndProject" in plan


def test_a_segment_is_made_from_terms_that_are_made_once(spark, scratch):
    """Ranges are found in one pass and filled in another; both read the terms that the batch wrote."""
    root = f"{scratch}/index"
    rows = [(1, "Red apples, red pears", False, 1), (2, "blue", True, 1), (3, None, False, 1), (4, "", None, 1), (5, "late", True, 1), (5, "pears", None, 2)]
    assert SG.apply_changes(spark.createDataFrame(rows, SG.CHANGES), root, 0)
    held = spark.read.parquet(f"{root}/changed/batch=0")
    assert {r.id: r.terms and sorted(r.terms) for r in held.select("id", "terms").collect()} == {
        1: ["apples", "pears", "red"], 2: None, 3: None, 4: [], 5: ["pears"]}
    assert sorted(SG.postings(spark, root).collect()) == [("apples", 1), ("pears", 1), ("pears", 5), ("red", 1)]
    assert SG.apply_changes(spark.createDataFrame([(1, "green", False, 1)], SG.CHANGES), root, 1)
    assert sorted(SG.postings(spark, root).collect()) == [("green", 1), ("pears", 5)]
    assert SG.merge(spark, root) and sorted(SG.postings(spark, root).collect()) == [("green", 1), ("pears", 5)]
