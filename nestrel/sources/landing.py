"""Document landing: manifests, response split, staging tables, rebuilds.

The workload fetched JSON documents over HTTP and bulk-inserted ``(id, body)``
rows into staging tables. Fetching itself is out of scope (a network client,
not data work); everything around it is DataFrame work here:

* ``request_manifest``   ids -> request URLs (``base + id``)
* ``pending_keys``       foreign ids found in wave 1 that still need landing
* ``split_responses``    keep status 200, quarantine the rest
* ``land``               append ``(id, body)`` to a staging table
* ``rebuild``            drop + recreate a table from a DataFrame
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def request_manifest(ids: DataFrame | int | None, base_url: str, id_col: str = "id",
                     spark: SparkSession | None = None) -> DataFrame:
    """``(id, url)`` for every id: an int n gives ids 1..n (``spark.range``);
    a DataFrame gives its ``id_col`` values; ``None`` asks for the base URL
    itself (a listing page) under id 1."""
    if ids is None:
        return spark.range(1, 2).select(F.col("id").alias(id_col), F.lit(base_url).alias("url"))
    if isinstance(ids, int):
        df = spark.range(1, ids + 1).select(F.col("id").alias(id_col))
    else:
        df = ids.select(id_col)
    return df.select(id_col, F.concat(F.lit(base_url), F.col(id_col).cast("string")).alias("url"))


def pending_keys(wave1: DataFrame, fk: str, landed: DataFrame | None = None,
                 landed_key: str | None = None, alias: str | None = None) -> DataFrame:
    """Distinct non-NULL foreign ids of wave 1, minus ids already landed."""
    alias = alias or fk
    keys = wave1.where(F.col(fk).isNotNull()).select(F.col(fk).alias(alias)).distinct()
    if landed is not None:
        keys = keys.join(landed.select(F.col(landed_key or alias).alias(alias)), alias, "left_anti")
    return keys


def split_responses(responses: DataFrame, status_col: str = "status",
                    ok: int = 200) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined). A NULL status is quarantined, never accepted."""
    good = F.col(status_col).eqNullSafe(F.lit(ok))
    return responses.where(good), responses.where(~good)


def land(docs: DataFrame, path: str, id_col: str = "id", body_col: str = "body",
         mode: str = "append", fmt: str = "parquet") -> None:
    """Append ``(id, body)`` documents to a staging table."""
    docs.select(F.col(id_col).alias("id"), F.col(body_col).alias("body")) \
        .write.mode(mode).format(fmt).save(path)


def rebuild(df: DataFrame, path: str, fmt: str = "parquet",
            sort_cols: list[str] | None = None, cluster: bool = False) -> None:
    """Full rebuild (drop + create + load) as an overwrite.

    ``sort_cols`` sorts within output files (the ``ORDER BY`` of the load): a
    layout choice for min/max data skipping, not a semantic. With ``cluster``
    the rows are first range-partitioned on the same columns, so files hold
    non-overlapping key ranges and a key lookup skips all but one.
    """
    out = df
    if sort_cols and cluster:
        out = out.repartitionByRange(*sort_cols)
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    out.write.mode("overwrite").format(fmt).save(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int,
                   fmt: str = "parquet") -> None:
    """Save a catalog table bucketed and sorted by ``keys``.

    Two tables bucketed on their join key with the same bucket count join
    without a shuffle (each bucket pair meets in one task), e.g. an entity
    table and its bridge table.
    """
    (df.write.mode("overwrite").format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
       .saveAsTable(table))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")

