"""Typed loads: every row is loaded as declared or rejected with its reasons."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from nestrel.sources import typed as TY

TARGET = [TY.Field("id", "int", required=True, low=1), TY.Field("name", "string", required=True, max_len=5),
          TY.Field("weight", "decimal(5,1)"), TY.Field("kinds", "array<string>", max_len=3),
          TY.Field("day", "date", low=datetime.date(2000, 1, 1)), TY.Field("codes", "array<int>"), TY.Field("ok", "boolean")]
RAW = "id string, name string, weight string, kinds array<string>, day string, codes array<string>, ok string, more int"
GOOD = [("1", "abc", "12.34", ["x", None], "2020-02-29", ["1", "2"], "true", 1),
        (" 7 ", "abcde  ", None, None, None, None, None, None), ("+3", "", "-0.05", [], "2000-01-01", [], "f", 0),
        ("2147483647", "éé東", "9999.94", ["abc"], None, [None], "no", 0)]
BAD = [((None, "a", None, None, None, None, None, 1), [("id", "null", None)]),
       (("x", None, None, None, None, None, None, 2), [("id", "type", "x"), ("name", "null", None)]),
       (("2147483648", "a", "9999.96", None, None, None, None, 3), [("id", "range", "2147483648"), ("weight", "range", "9999.96")]),
       (("0", "abcdef", "NaN", ["abcd", "e"], "1999-12-31", ["1", "z"], "maybe", 4),
        [("id", "range", "0"), ("name", "length", "abcdef"), ("weight", "type", "NaN"), ("kinds", "length", "[abcd, e]"),
         ("day", "range", "1999-12-31"), ("codes", "type", "[1, z]"), ("ok", "type", "maybe")]),
       (("1.0", "abcdeé ", "", None, "2001-02-30", ["99999999999"], None, 5),
        [("id", "type", "1.0"), ("name", "length", "abcdeé "), ("weight", "type", ""), ("day", "type", "2001-02-30"),
         ("codes", "range", "[99999999999]")])]


def rows(spark):
    return spark.createDataFrame(GOOD + [r for r, _ in BAD], RAW).repartition(3)


def test_rows_that_fit_have_the_declared_types(spark):
    got = TY.accepted(rows(spark), TARGET)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in TY.schema_of(TARGET)]
    want = [(1, "abc", Decimal("12.3"), ["x", None], datetime.date(2020, 2, 29), [1, 2], True),
            (7, "abcde", None, None, None, None, None), (3, "", Decimal("-0.1"), [], datetime.date(2000, 1, 1), [], False),
            (2147483647, "éé東", Decimal("9999.9"), ["abc"], None, [None], False)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_every_fault_is_reported(spark):
    got = TY.rejected(rows(spark), TARGET, ["more"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((r[-1], *fault)) for r, faults in BAD for fault in faults)


def test_load_writes_the_table_and_loses_nothing(spark, scratch):
    df = rows(spark)
    report = TY.load(df, TARGET, f"{scratch}/t", f"{scratch}/r")
    assert (report["rows"], report["loaded"], report["rejected"]) == (9, 4, 5)
    assert sum(report[r] for r in TY.REASONS) == sum(len(f) for _, f in BAD)
    back = spark.read.parquet(f"{scratch}/t")
    assert back.count() == 4 and [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in TY.schema_of(TARGET)]
    left = spark.read.parquet(f"{scratch}/r")
    assert left.count() == 5 and left.select(*df.columns).exceptAll(df).isEmpty()
    assert TY.read(spark, f"{scratch}/t", TARGET).columns == [f.name for f in TARGET]
    # a second batch is appended; one without faults adds no rejects
    report = TY.load(spark.createDataFrame(GOOD[:2], RAW), TARGET, f"{scratch}/t", f"{scratch}/r")
    assert report["rejected"] == 0 and spark.read.parquet(f"{scratch}/t").count() == 6 and left.count() == 5


def test_load_without_a_place_for_rejects_is_all_or_nothing(spark, scratch):
    with pytest.raises(TY.RejectedRows, match="5 of 9"):
        TY.load(rows(spark), TARGET, f"{scratch}/t")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{scratch}/t")
    assert TY.load(spark.createDataFrame(GOOD, RAW), TARGET, f"{scratch}/t")["loaded"] == 4


def test_numbers_are_rounded_and_bounded(spark):
    target = [TY.Field("a", "tinyint"), TY.Field("b", "decimal(4,1)"), TY.Field("c", "bigint"), TY.Field("missing", "int")]
    df = spark.createDataFrame([(2.5, 2.25, 1), (-2.5, -2.25, 2), (127.4, 999.94, 3), (127.5, 999.96, 4), (float("nan"), float("inf"), 5),
                                (1e300, 0.0, 6)], "a double, b double, c int")
    assert [tuple(r) for r in TY.accepted(df, target).orderBy("c").collect()] == [
        (3, Decimal("2.3"), 1, None), (-3, Decimal("-2.3"), 2, None), (127, Decimal("999.9"), 3, None)]
    got = TY.rejected(df, target, ["c"]).collect()
    assert sorted((r.c, r.column, r.reason) for r in got) == [
        (4, "a", "range"), (4, "b", "range"), (5, "a", "type"), (5, "b", "range"), (6, "a", "range")]


def test_a_required_column_that_the_source_lacks(spark):
    target = [TY.Field("a", "int"), TY.Field("b", "array<int>", required=True), TY.Field("c", "array<int>")]
    df = spark.createDataFrame([(1, "no array")], "a int, c string")
    assert TY.accepted(df, target).count() == 0
    assert sorted((r.column, r.reason) for r in TY.rejected(df, target, ["a"]).collect()) == [("b", "null"), ("c", "type")]
    assert TY.accepted(df.limit(0), target).count() == 0
    assert T.StructField("b", T.ArrayType(T.IntegerType()), False) in TY.schema_of(target).fields


def test_the_load_is_one_narrow_pass(spark):
    plan = TY.accepted(rows(spark), TARGET)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
