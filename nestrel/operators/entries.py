"""First-matching-entry selection, positions and per-key numbering.

The workload picks "the first entry whose language is 'en'" with a chain of
three windows (a global row number to capture input order, a row number per
key, a rank after a filter) and a join back. Here that collapses to:

* in-row, when the entries are an array inside one document:
  ``get(filter(entries, e -> pred(e)), 0)`` - no shuffle at all;
* on rows (one row per entry, with a position column):
  ``groupBy(key).agg(min_by(value, CASE WHEN pred THEN pos END))`` - one
  partially-aggregated shuffle whose per-key state is a single (value, pos)
  pair, so a key holding a third of all rows is reduced map-side.

A fallback (first flavour text, else first effect text) is one aggregation
with two ``min_by`` and a ``coalesce``: no join, no second scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestrel.operators.numbering import numbers_per_key


def first_in_array(entries: Column, pred: Callable[[Column], Column],
                   value: Callable[[Column], Column]) -> Column:
    """Value of the first array entry satisfying ``pred``; NULL when none."""
    return value(F.get(F.filter(entries, pred), F.lit(0)))


def with_positions(df: DataFrame, keep: Sequence[str], entries: str,
                   pos_col: str = "pos", entry_col: str = "entry") -> DataFrame:
    """One row per array entry with its 0-based position (``posexplode``).

    Replaces ``row_number() over (order by (select NULL))``: the position is
    deterministic and needs no single-partition window.
    """
    return df.select(*keep, F.posexplode(entries).alias(pos_col, entry_col))


def first_entry(df: DataFrame, key: str, order: str, value: str,
                pred: Column | None = None, alias: str = "value") -> DataFrame:
    """Per key, ``value`` of the row with the smallest ``order`` among rows
    satisfying ``pred``. Keys with no such row are absent."""
    src = df if pred is None else df.where(pred)
    return src.groupBy(key).agg(F.min_by(value, order).alias(alias))


def first_entry_or_null(df: DataFrame, key: str, order: str, value: str,
                        pred: Column, alias: str = "value") -> DataFrame:
    """Every key, with the first matching value or NULL (the left-joined form)."""
    return df.groupBy(key).agg(F.min_by(value, F.when(pred, F.col(order))).alias(alias))


def first_with_fallback(df: DataFrame, key: str, order: str, value: str,
                        preds: Sequence[Column], alias: str = "value") -> DataFrame:
    """Every key with ``coalesce(first match of preds[0], first of preds[1], ...)``."""
    firsts = [F.min_by(value, F.when(p, F.col(order))) for p in preds]
    return df.groupBy(key).agg(F.coalesce(*firsts).alias(alias))


def row_number_per_key(df: DataFrame, key: str, order: Sequence[str], alias: str = "rn",
                       split_hot_keys: bool = True, buckets: int | None = None) -> DataFrame:
    """``row_number() over (partition by key order by ...)`` as BIGINT, NULLs last.

    Rows are numbered inside ranges of (key, order), ``buckets`` of them, so a key holding a
    large share of the rows is numbered by several tasks (``numbering``). Where no
    key can be hot, ``split_hot_keys=False`` is one plain window with one shuffle.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    if split_hot_keys:
        return numbers_per_key(df, key, by, alias, "row_number", buckets)
    return df.withColumn(alias, F.row_number().over(Window.partitionBy(key).orderBy(*by)).cast("bigint"))


def rank_per_key(df: DataFrame, key: str, order: Sequence[str], pred: Column | None = None,
                 alias: str = "rk", split_hot_keys: bool = True, buckets: int | None = None) -> DataFrame:
    """``rank() over (partition by key order by ...)`` after an optional filter; keys are split
    as in ``row_number_per_key``."""
    src = df if pred is None else df.where(pred)
    by = [F.col(c).asc_nulls_last() for c in order]
    if split_hot_keys:
        return numbers_per_key(src, key, by, alias, "rank", buckets)
    return src.withColumn(alias, F.rank().over(Window.partitionBy(key).orderBy(*by)).cast("bigint"))
