"""Numbers in order: dense ids over a table, row numbers and ranks per key.

Rows are range-partitioned by their whole sort key, sorted inside the partitions, and
written with their partition and their place in it. A row's number is its place plus
the rows of the partitions before, a sum over one row per partition. No window ever sees
a whole table or a whole hot key: its rows lie in as many partitions as they fill. The
sort key may have any number of columns of any orderable type.

The written table lies in the shared folder; it also fixes the partition of every row,
which a range partitioning computed twice would not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.sources.publish import written

PART, PLACE = "nestrel part", "nestrel place"
PLACE_BITS = 33                                   # of monotonically_increasing_id


def _part() -> Column:
    return F.col(f"`{PART}`")


def _place() -> Column:
    return F.col(f"`{PLACE}`")


def ranged(df: DataFrame, order: Sequence[Column], parts: int | None = None, tie_break: bool = False) -> DataFrame:
    """``df`` with PART (partitions ascend with ``order``) and PLACE (from 0, in order). With ``tie_break``
    rows that tie in the whole order may be parted, too, by a hash of the row."""
    n = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = list(order)
    if tie_break:
        whole = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        order.append(F.xxhash64(*[F.col(f"`{c}`") for c in whole]).asc())
    number = F.monotonically_increasing_id()
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(PLACE, number)
              .withColumn(PART, F.shiftright(_place(), PLACE_BITS).cast("int"))
              .withColumn(PLACE, _place().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))))
    return written(placed, "numbered")


def dense_numbers(df: DataFrame, order: Sequence[Column], alias: str, start_after: int = 0, parts: int | None = None) -> DataFrame:
    """``df`` with ``alias``: start_after + 1, start_after + 2, ... in ``order``. Full ties are numbered in any order."""
    placed = ranged(df, order, parts, tie_break=True)
    sizes = placed.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))                     # a row a partition
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("nestrel before"))
    number = F.lit(start_after) + F.col("`nestrel before`") + _place() + 1
    return placed.join(F.broadcast(offsets), PART).select(*[F.col(f"`{c}`") for c in df.columns], number.cast("bigint").alias(alias))


def numbers_per_key(df: DataFrame, key: str, order: Sequence[Column], alias: str, fn: str = "row_number",
                    parts: int | None = None) -> DataFrame:
    """``df`` with ``row_number`` or ``rank`` over (partition by key order by ``order``) as BIGINT.

    Rows are cut into ranges of (key, order), so a key that holds much of the table is
    numbered by many tasks. Keys that reach over a border of two partitions (at most
    one per border) take the count of their rows before it. Row numbers may part
    full ties; for ranks a tie stays in one partition. Rows of a NULL key are one key.
    """
    by_key = F.col(f"`{key}`")
    placed = ranged(df, [by_key.asc_nulls_first(), *order], parts, tie_break=fn == "row_number")
    if fn == "row_number":
        local = F.row_number().over(Window.partitionBy(PART, by_key).orderBy(_place()))
    else:
        local = F.rank().over(Window.partitionBy(PART, by_key).orderBy(*order))
    ends = placed.groupBy(PART).agg(F.min_by(F.struct(by_key.alias("k")), _place()).alias("first"),
                                    F.max_by(F.struct(by_key.alias("k")), _place()).alias("last"))
    across = (ends.select(PART, F.explode(F.array_distinct(F.array("first", "last"))).alias("end"))
              .groupBy("end").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("end.k").alias("nestrel key")))
    met = by_key.eqNullSafe(F.col("`nestrel key`"))
    pieces = placed.join(F.broadcast(across), met).groupBy("nestrel key", PART).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("nestrel key").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("nestrel key", F.col(f"`{PART}`").alias("nestrel piece"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("nestrel before"))
    numbered = placed.withColumn("nestrel number", local).join(
        F.broadcast(offsets), met & (_part() == F.col("`nestrel piece`")), "left")
    number = F.coalesce(F.col("`nestrel before`"), F.lit(0)) + F.col("`nestrel number`")
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], number.cast("bigint").alias(alias))
