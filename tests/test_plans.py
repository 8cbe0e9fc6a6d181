"""Plan-shape checks: the properties the scale design relies on."""

from nestrel.plans import catalog as C
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_entry_has_no_window_and_no_single_partition(spark):
    for k in ("first_entry", "first_entry_enrich", "coalesce_enrich"):
        p = plan(C.QUERIES[k](spark, SF_SMALL))
        assert "Window" not in p and "SinglePartition" not in p, k


def test_in_row_first_entry_needs_no_shuffle(spark):
    from nestrel.plans import pipelines as P
    from nestrel.plans import shapes as SH
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, '{"id": 1, "name": "a", "effect_entries": [], "flavor_text_entries": []}')],
                                 "id int, body string")
    p = plan(P.described_table(docs, SH.ABILITIES, [F.col("id"), F.col("name")]))
    assert "Exchange" not in p


def test_rank_does_not_window_the_data(spark):
    # the only window is over the count histogram; the part rows never meet a
    # single-partition window
    df = C.QUERIES["bottom_k_ties"](spark, SF_SMALL)
    txt = df._jdf.queryExecution().optimizedPlan().toString()
    assert txt.count("Window ") <= 1
    # the counts are made once, and read up to the k-th smallest only
    assert "lineitem" not in txt and "l_partkey" not in txt
    assert "PushedFilters: [IsNotNull(ct), LessThanOrEqual(ct," in plan(df)


def test_lineitem_is_read_once_beside_its_counts(spark):
    txt = C.QUERIES["multi_join_detail"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert txt.count("l_extendedprice#") and txt.split("== Initial Plan ==")[-1].count("FileScan parquet [l_") == 1


def test_foreign_keys_are_counted_without_a_join_of_the_children(spark):
    p = plan(C.QUERIES["fk_orphans"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 9 and p.count("Join") == 1        # each table once; the join is of the eight rules


def test_numbering_needs_no_quantiles(spark):
    for k in ("row_number_per_key", "rank_per_key", "assign_ids"):
        p = plan(C.QUERIES[k](spark, SF_SMALL)).lower()
        assert "quantile" not in p and "percentile" not in p, k


def test_stems_and_blocks_stay_in_the_jvm(spark):
    for k in ("fts_lexemes", "fts_block_index", "array_contains_blocks", "typed_load"):
        p = plan(C.QUERIES[k](spark, SF_SMALL))
        assert "Python" not in p and "Arrow" not in p, k
    assert "Exchange hashpartitioning" not in plan(C.QUERIES["fts_lexemes"](spark, SF_SMALL))


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = C.QUERIES["left_join_count_rows"](spark, SF_SMALL)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(C.QUERIES["top_k"](spark, SF_SMALL))


def test_spread_only_for_few_small_files(spark, scratch):
    from nestrel.sources.tables import spread
    one = spark.range(1000).coalesce(1)
    one.write.parquet(f"{scratch}/one")
    df = spark.read.parquet(f"{scratch}/one")
    assert spread(df, "id") is df                      # under 1 MB: one task is enough
    assert "Exchange hashpartitioning(id" in plan(spread(df, "id", bytes_per_task=1024))
    many = spark.range(1000).repartition(spark.sparkContext.defaultParallelism + 2)
    many.write.parquet(f"{scratch}/many")
    df2 = spark.read.parquet(f"{scratch}/many")
    assert spread(df2, "id") is df2


def test_hot_key_operators_pre_aggregate_before_shuffling(spark):
    # every per-key state is reduced map-side (a partial aggregate below the
    # exchange), so a key holding a third of the rows costs one row per task
    for k in ("first_entry", "first_entry_enrich", "coalesce_enrich", "left_join_count_rows",
              "family_lookup", "capacity_check", "unique_violations", "array_histogram",
              "strict_set_hist", "count_distinct", "bridge_distinct"):
        p = plan(C.QUERIES[k](spark, SF_SMALL))
        below_exchange = p.split("Exchange hashpartitioning", 1)[-1]
        # a partial aggregate function, or a key-only (distinct) pre-aggregation
        assert "partial_" in p or "Aggregate(keys=" in below_exchange, k


def test_fixed_dimension_lookup_is_broadcast(spark):
    # nation (25 rows, fixed) is the only explicit broadcast hint in the catalogue
    p = plan(C.QUERIES["multi_join_detail"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "n_nationkey" in p.split("BroadcastHashJoin", 1)[1]


def test_spread_keeps_later_filters_above_its_exchange(spark, scratch):
    from pyspark.sql import functions as F

    from nestrel.sources.tables import spread
    spark.range(1000).selectExpr("id", "cast(id as string) AS t").coalesce(1).write.parquet(f"{scratch}/one")
    df = spread(spark.read.parquet(f"{scratch}/one"), "id", bytes_per_task=1024)
    q = df.where(F.length("t") > 2)
    p = plan(q)
    below = p.split("Exchange hashpartitioning", 1)[1]
    assert "length(t" not in below           # the predicate runs after the spread
    assert q.count() == 900
