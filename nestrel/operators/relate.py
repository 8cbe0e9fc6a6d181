"""Joins, aggregates, ranking and ordering operators.

Scale notes
-----------
* ``left_join_count`` aggregates the right side per join key *before* the join
  (partial aggregation map-side, then one shuffle of distinct keys), so a key
  holding a third of the right rows costs one row after the partial stage, and
  the join itself is 1:1 on the key - no skew, no row multiplication.
* ``rank_by_value`` computes a global ``rank()`` without a single-partition
  window: rank = 1 + number of rows with a smaller value, read off the
  histogram of distinct values. For counts the histogram is provably small:
  k distinct positive counts need at least k(k+1)/2 underlying rows, so
  N rows give at most sqrt(2N) distinct counts (1.4M for 10^12 rows), so its
  window and join stay small. For values without such a bound,
  ``method="ranges"`` ranks inside sorted ranges instead.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestrel.operators.numbering import PART, PLACE, dense_numbers, numbers_per_key, ranged
from nestrel.sources.publish import written

from nestrel.functions import arrays as A


def array_histogram(df: DataFrame, array_col: str, out_col: str = "element",
                    count_col: str = "ct") -> DataFrame:
    """Count of every element over all arrays (``unnest`` + ``group by``).

    ``explode`` drops NULL/empty arrays like ``unnest``; the count is partial
    aggregated before the shuffle.
    """
    return (df.select(F.explode(array_col).alias(out_col))
              .groupBy(out_col).agg(F.count(F.lit(1)).alias(count_col)))


def canonical_set_histogram(df: DataFrame, array_col: str, out_col: str = "type_set",
                            count_col: str = "ct") -> DataFrame:
    """Group rows by the order-insensitive form of an array and count them."""
    return (df.where(F.col(array_col).isNotNull())
              .groupBy(A.canonical(F.col(array_col)).alias(out_col))
              .agg(F.count(F.lit(1)).alias(count_col)))


def left_join_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                    keep: Sequence[str], count_col: str = "ct",
                    count_rows: bool = True) -> DataFrame:
    """``select keep, count(*) from left left join right on key group by keep``.

    ``count_rows=True`` keeps the relational ``count(*)`` reading: a left row
    without a partner still counts 1 (the NULL-extended row). ``False`` counts
    matches only (``count(right_key)``), i.e. 0 for unmatched rows.

    Assumes ``left_key`` is unique in ``left`` (it is the entity key); the
    right side is reduced to one row per key before the join.
    """
    per_key = (right.where(F.col(right_key).isNotNull())
                    .groupBy(F.col(right_key).alias("__k"))
                    .agg(F.count(F.lit(1)).alias("__n")))
    joined = left.select(*keep, F.col(left_key).alias("__lk")) if left_key not in keep \
        else left.select(*keep).withColumn("__lk", F.col(left_key))
    out = joined.join(per_key, joined["__lk"] == per_key["__k"], "left")
    n = F.coalesce(F.col("__n"), F.lit(0))
    if count_rows:
        n = F.greatest(n, F.lit(1))
    return out.select(*keep, n.cast("bigint").alias(count_col))


def rank_by_value(df: DataFrame, value_col: str, rank_col: str = "rk",
                  descending: bool = False, method: str = "histogram",
                  buckets: int | None = None) -> DataFrame:
    """Global ``rank() over (order by value)`` with no single-partition window
    over the data. Exact: ties share a rank and leave gaps; NULL values rank
    last ascending (first descending), as in the relational engine.

    ``method="histogram"`` (for counts and other low-cardinality values):
    rank = 1 + rows with a smaller value, read off the histogram of distinct
    values; the window runs over the histogram only, whose size is bounded by
    sqrt(2N) for counts (see module doc). Spark decides from the measured
    size whether the histogram is broadcast.

    ``method="ranges"`` (any orderable value): rows are ranked inside ``buckets`` sorted
    ranges and offset by the number of rows in earlier ranges (``numbering``).
    """
    if method == "ranges":
        v = F.col(value_col)
        return numbers_per_key(df.withColumn("nestrel all", F.lit(0)), "nestrel all",
                               [v.desc_nulls_first() if descending else v.asc_nulls_last()], rank_col, "rank",
                               buckets).drop("nestrel all")
    v = F.col(value_col)
    hist = df.groupBy(v.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    order = F.col("__v").desc_nulls_first() if descending else F.col("__v").asc_nulls_last()
    # window over the histogram only (one row per distinct value)
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.select("__v", (F.coalesce(F.sum("__c").over(w), F.lit(0)) + 1)
                        .cast("bigint").alias(rank_col))
    return df.join(ranks, v.eqNullSafe(F.col("__v")), "inner").drop("__v")


def rank_at_most(df: DataFrame, value_col: str, k: int, rank_col: str = "rk") -> DataFrame:
    """Rows whose global ascending rank is <= k, ties kept (``where rk <= k``).

    These are the rows up to the k-th smallest value, so that value (one scalar, from a top-k)
    is all that the ranking has to know of the others. ``df``, often a large aggregation, is
    evaluated once and written; its result is small where it is an aggregation.
    """
    held = written(df, "ranked")
    v = F.col(value_col)
    last = (held.select(v.alias("v")).orderBy(F.col("v").asc_nulls_last()).limit(k)
            .agg(F.max("v").alias("v"), F.count("v").alias("n")).first())
    some = held.where(v <= F.lit(last["v"])) if last["n"] == k else held     # fewer than k values: NULLs rank, too
    return rank_by_value(some, value_col, rank_col).where(F.col(rank_col) <= k)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """``order by ... limit k``; planned as TakeOrderedAndProject (per-partition
    top-k, then a k-row merge) - no full sort."""
    return df.orderBy(*order).limit(k)


def sorted_slice(df: DataFrame, order: Sequence[Column], start: int, stop: int) -> DataFrame:
    """Rows ``[start, stop)`` of the sorted result (pandas ``data[start:stop]``).

    The order must be total (end with a unique key) for the slice to be
    deterministic.
    """
    return df.orderBy(*order).offset(start).limit(stop - start)


def key_slice(df: DataFrame, keys: Sequence[str], start: int, stop: int, parts: int | None = None) -> DataFrame:
    """The rows ``[start, stop)`` of ``df`` ordered by its unique ``keys`` (NULLs first), in no order.

    Only key columns are sorted, inside ranges; the rows per range tell which ranges meet the
    slice, and their places which keys. The wide rows are then read by the first and the
    last of these keys: a filter that reaches the scan, so what lies outside is neither
    moved nor parsed.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    placed = ranged(df.select(*keys), order, parts)
    sizes = sorted((r[0], r[1]) for r in placed.groupBy(PART).count().collect())      # a row a range
    part, place = F.col(f"`{PART}`"), F.col(f"`{PLACE}`")
    before, meets = 0, F.lit(False)
    for number, n in sizes:
        if before < stop and before + n > start:
            meets = meets | ((part == number) & (place >= start - before) & (place < stop - before))
        before += n
    some = placed.where(meets).select(*keys)
    first = F.col(keys[0])
    ends = some.agg(F.min(first), F.max(first), F.count_if(first.isNull()), F.count(F.lit(1))).first()
    near = first.between(F.lit(ends[0]), F.lit(ends[1]))
    near = first.isNull() if ends[0] is None else near | first.isNull() if ends[2] else near
    if len(keys) == 1 or not ends[3]:
        return df.where(near if ends[3] else F.lit(False))
    wanted = some.toDF(*[f"nestrel {i}" for i in range(len(keys))])
    same = [F.col(k).eqNullSafe(F.col(f"`nestrel {i}`")) for i, k in enumerate(keys)]
    met = same[0]
    for x in same[1:]:
        met = met & x
    return df.where(near).join(wanted, met, "left_semi")


def page_directory(df: DataFrame, keys: Sequence[str], size: int, parts: int | None = None) -> DataFrame:
    """page, n_rows, first (a struct of the keys), last: the pages of ``size`` rows into which ``df`` falls in
    the order of its unique ``keys`` (NULLs first). Rows are numbered in ranges; a page is a group of ``size`` rows."""
    numbered = dense_numbers(df.select(*keys), [F.col(k).asc_nulls_first() for k in keys], "nestrel row", 0, parts)
    row, key = F.col("`nestrel row`"), F.struct(*keys)
    page = F.floor((row - 1) / size).cast("bigint").alias("page")
    return numbered.groupBy(page).agg(F.count(F.lit(1)).alias("n_rows"), F.min_by(key, row).alias("first"),
                                      F.max_by(key, row).alias("last"))


def client_page(df: DataFrame, keys: Sequence[str], size: int, after: Sequence | None = None) -> tuple[pa.Table, tuple | None]:
    """(the next ``size`` rows in the order of ``keys`` as an Arrow table, the key to go on ``after``).

    ``after`` is the key of the last row the client has; None begins. A page is a filter that reaches
    the scan and a top-k, so no page costs more than the first, and no more than ``size``
    rows come to the client. The keys must be unique and not NULL. The second value is
    None when the page is the last one.
    """
    some = df
    if after is not None:
        beyond, equal = F.lit(False), F.lit(True)
        for k, x in zip(keys, after):
            beyond = beyond | (equal & (F.col(k) > F.lit(x)))
            equal = equal & (F.col(k) == F.lit(x))
        some = df.where((F.col(keys[0]) >= F.lit(after[0])) & beyond)
    page = some.orderBy(*keys).limit(size + 1).toArrow()
    if page.num_rows <= size:
        return page, None
    page = page.slice(0, size)
    return page, tuple(page.column(k)[size - 1].as_py() for k in keys)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """``select distinct col ... order by col`` (range-partitioned sort)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(F.col(col).asc())


def count_distinct(df: DataFrame, col: str, alias: str) -> DataFrame:
    """Exact ``count(distinct col)`` (NULLs ignored)."""
    return df.agg(F.count_distinct(col).alias(alias))


def global_count(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def group_count_nonnull(df: DataFrame, key: str, col: str, alias: str = "n") -> DataFrame:
    """``select key, count(col) ... group by key``."""
    return df.groupBy(key).agg(F.count(col).alias(alias))
