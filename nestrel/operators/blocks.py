"""Postings in blocks: one row per term and range of ids.

A block holds the ids of one term inside one range of ``span`` ids: the smallest, the
largest, and every id as its difference from the smallest (a small integer that Parquet
packs into a few bits). A term that stands in a third of all rows has many blocks, which
hash over all tasks by (term, block); no state is larger than a range. An intersection
compares the blocks of one range only, and expands none whose ranges of ids do not meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN_BITS = 13          # ids of a block lie in a range of 2^13; at most 15, as differences are SMALLINT


def build_blocks(postings: DataFrame, term: str, id_col: str, span_bits: int = SPAN_BITS) -> DataFrame:
    """(term, block, n_ids, low, high, steps) of distinct (term, id) rows with integer ids.
    Rows without a term or an id are in no block; repeated rows count once."""
    if not 0 < span_bits <= 15:
        raise ValueError("a block spans at most 2^15 ids")
    rows = postings.where(F.col(term).isNotNull() & F.col(id_col).isNotNull()) \
        .select(F.col(term), F.col(id_col).cast("bigint").alias("id"))
    held = rows.groupBy(term, F.shiftright("id", span_bits).alias("block")).agg(F.array_sort(F.collect_set("id")).alias("ids"))
    low = F.element_at("ids", 1)
    return held.select(term, "block", F.size("ids").cast("bigint").alias("n_ids"), low.alias("low"),
                       F.element_at("ids", -1).alias("high"),
                       F.transform("ids", lambda x: (x - low).cast("smallint")).alias("steps"))


def write_blocks(blocks: DataFrame, path: str, term: str, partitions: int | None = None) -> None:
    """Persist blocks in ranges of (term, block): a lookup skips other terms' files and row
    groups by their statistics, and a frequent term lies in many files."""
    n = partitions or int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks.repartitionByRange(n, term, "block").sortWithinPartitions(term, "block").write.mode("overwrite").parquet(path)


def ids_of(low: Column, steps: Column) -> Column:
    """The ids of a block, ascending."""
    return F.transform(steps, lambda s: low + s)


def containing_all(blocks: DataFrame, terms: Sequence, term: str, id_col: str = "id") -> DataFrame:
    """Ids that stand under every one of ``terms`` (at least one), once each.

    Blocks of one range meet in one group of at most ``len(terms)`` rows; ranges that lack
    a term, or in which the terms' ids do not overlap, are dropped before any id is
    expanded.
    """
    probe = sorted(set(terms))
    met = (blocks.where(F.col(term).isin(probe)).groupBy("block")
           .agg(F.count(F.lit(1)).alias("n"), F.max("low").alias("first"), F.min("high").alias("last"),
                F.collect_list(F.struct("low", "steps")).alias("lists"))
           .where((F.col("n") == len(probe)) & (F.col("first") <= F.col("last"))))
    lists = F.transform("lists", lambda b: ids_of(b["low"], b["steps"]))
    common = F.aggregate(lists, F.element_at(lists, 1), F.array_intersect) if len(probe) > 1 else F.element_at(lists, 1)
    return met.select(F.explode(common).alias(id_col))


def containing_any(blocks: DataFrame, terms: Sequence, term: str, id_col: str = "id") -> DataFrame:
    """Ids that stand under at least one of ``terms``, once each (de-duplicated per range)."""
    met = blocks.where(F.col(term).isin(sorted(set(terms)))).groupBy("block") \
        .agg(F.collect_list(F.struct("low", "steps")).alias("lists"))
    return met.select(F.explode(F.array_distinct(F.flatten(
        F.transform("lists", lambda b: ids_of(b["low"], b["steps"]))))).alias(id_col))
