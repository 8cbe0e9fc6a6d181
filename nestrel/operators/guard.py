"""Capacity-guarded appends, recomputed from the tables (no client-side cache).

``table_capacity``  whole-table limit: accept the batch iff
                    ``count(existing) + count(batch) <= limit``.
``capacity_check``  per-key limit: accept the batch iff no key's
                    ``count(existing) + count(batch) > limit``.
Both are all-or-nothing for the batch, and exactly the limit is accepted
(strict ``>`` rejects). Each verdict is a one-row DataFrame computed with
partial aggregation; ``guarded_append`` reads that one row and then writes
the batch or not.

Check-then-write is not atomic across concurrent writers on plain file
tables; with a transactional table format the same verdict can gate a
single commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_capacity(existing: DataFrame, batch: DataFrame, limit: int) -> DataFrame:
    """One row: existing, batch, limit, accepted."""
    # one aggregation over the tagged union: no join, one partial-agg shuffle
    tagged = (existing.select(F.lit(1).alias("__e"), F.lit(0).alias("__b"))
              .unionByName(batch.select(F.lit(0).alias("__e"), F.lit(1).alias("__b"))))
    counts = tagged.agg(F.coalesce(F.sum("__e"), F.lit(0)).cast("bigint").alias("existing"),
                        F.coalesce(F.sum("__b"), F.lit(0)).cast("bigint").alias("batch"))
    return counts.select("existing", "batch", F.lit(limit).cast("bigint").alias("max_rows"),
                         ((F.col("existing") + F.col("batch")) <= F.lit(limit)).alias("accepted"))


def per_key_totals(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Per key: rows already present plus rows the batch would add."""
    both = existing.select(key).unionByName(batch.select(key))
    return both.groupBy(key).agg(F.count(F.lit(1)).alias("total"))


def capacity_check(existing: DataFrame, batch: DataFrame, key: str, limit: int) -> DataFrame:
    """One row: largest per-key total (0 when empty), keys over, limit, accepted."""
    totals = per_key_totals(existing, batch, key)
    return totals.agg(
        F.coalesce(F.max("total"), F.lit(0)).cast("bigint").alias("max_total"),
        F.count(F.when(F.col("total") > limit, 1)).alias("keys_over"),
        F.lit(limit).cast("bigint").alias("max_per_key"),
        (F.coalesce(F.max("total"), F.lit(0)) <= F.lit(limit)).alias("accepted"))


def capacity_violations(existing: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys already over the limit (the warning issued on start-up)."""
    return (existing.groupBy(key).agg(F.count(F.lit(1)).alias("total"))
                    .where(F.col("total") > limit))


def guarded_append(batch: DataFrame, verdict: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Append ``batch`` to the table at ``path`` iff the one-row verdict accepts it."""
    accepted = bool(verdict.select("accepted").first()[0])
    if accepted:
        batch.write.mode("append").format(fmt).save(path)
    return accepted


def truncate(spark, path: str, schema, fmt: str = "parquet") -> None:
    """Replace a table's contents with no rows (schema kept)."""
    spark.createDataFrame([], schema).write.mode("overwrite").format(fmt).save(path)


def truncate_cascade(spark, tables: list[tuple[str, object]], fmt: str = "parquet") -> None:
    """Truncate a parent and its children, children first; ids restart because
    ``assign_ids`` numbers from the current maximum (0 for an empty table)."""
    for path, schema in tables:
        truncate(spark, path, schema, fmt)
