"""Table scans over a directory of parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``<sf_dir>/<name>.parquet``. Projection and filters applied later
    reach the scan (``ReadSchema`` / ``PushedFilters``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES) -> None:
    """Expose the tables as temporary views for ad-hoc SQL."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def adhoc_sql(spark: SparkSession, sql: str, columns: Sequence[str] | None = None,
              **tables: DataFrame) -> DataFrame:
    """Run SQL text; the result stays distributed. ``columns`` renames the
    result positionally (``toDF``) like naming a client frame afterwards.

    DataFrames passed as keyword arguments are referenced as ``{name}`` in
    the text (bound under generated view names, so no session view is
    replaced); without them the text reads the session's tables and views.
    """
    df = spark.sql(sql, **tables) if tables else spark.sql(sql)
    return df.toDF(*columns) if columns else df


def spread(df: DataFrame, key: str | None = None, partitions: int | None = None,
           bytes_per_task: int = 1 << 20) -> DataFrame:
    """Spread rows over the cluster before CPU-heavy per-row work (JSON,
    regex, tokenising) when the input is laid out in too few files.

    A parquet row group is the unit of a scan split, so a table written as a
    handful of files / row groups is scanned by a handful of tasks however
    large each is (measured from the event log: one task of four did all the
    work on the documents table). With fewer input files than the session's
    parallelism, each no larger than one split (``maxPartitionBytes``), rows
    are hash-partitioned on ``key`` (deterministic on retry, no sort) into
    one part per ``bytes_per_task`` of input, at most one per core; without
    a key, round-robin. A table spread over many files - the normal
    layout at scale - is returned unchanged, so no shuffle is added there.
    """
    spark = df.sparkSession
    try:
        files = df.inputFiles()
    except Exception:  # noqa: BLE001 - not a file-based relation
        return df
    try:
        parallelism = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        return df
    if not 0 < len(files) < parallelism:
        return df
    # Few files. Spread only if they are small, i.e. about one split each;
    # big files are assumed to hold several row groups and scan in parallel.
    try:
        mean = _mean_file_bytes(spark, files)
    except Exception:  # noqa: BLE001 - no JVM access (e.g. Spark Connect)
        return df
    if mean > _max_split_bytes(spark):
        return df
    # one task per ~bytes_per_task of (compressed) input, at most one per core
    n = partitions or min(parallelism,
                          -(-int(mean * len(files)) // bytes_per_task))
    if n <= len(files):
        return df
    spread_df = df.repartition(n, key) if key else df.repartition(n)
    # Keep later predicates above the exchange: a deterministic filter would
    # otherwise be pushed through the repartition into the single scan task,
    # taking its (often heavy) per-row work with it. A filter that is always
    # true (partition ids are >= 0) but not deterministic is neither combined
    # with nor crossed by later filters; column pruning still reaches the
    # scan. Only inputs small enough to be spread lose scan-level pushdown.
    return spread_df.where(F.spark_partition_id() >= F.lit(0))


def _max_split_bytes(spark: SparkSession) -> int:
    v = spark.conf.get("spark.sql.files.maxPartitionBytes", "128MB")
    units = {"b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
    v = v.strip().lower().rstrip("b") or "0"
    return int(float(v[:-1]) * units[v[-1]]) if v[-1] in units else int(v)


def _mean_file_bytes(spark: SparkSession, files: list[str]) -> float:
    """Mean size of the input files, from the Hadoop FileSystem the session
    uses (works for any file system URI the scan itself reads)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(f)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total / len(files)


# The key each long-text table is spread on.
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``table`` followed by ``spread``: for tables whose rows carry long texts."""
    return spread(table(spark, sf_dir, name), TEXT_KEYS.get(name))
