"""Published versions of a set of tables.

A rebuild writes into a folder of its own and becomes visible by one small append to a
ledger, so readers see the old tables or the new ones and never a mixture. A rebuild
that fails its checks, or dies, leaves nothing in the ledger: readers stay where they
are. Everything goes through Spark's readers and writers, so the folders can be in any
store that Spark reaches.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Callable, Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def append_entry(spark: SparkSession, ledger: str, entry: dict) -> None:
    """Add one entry (a small JSON object). The commit of an append of one file is one rename."""
    spark.createDataFrame([(json.dumps(entry, sort_keys=True),)], "value string").coalesce(1).write.mode("append").text(ledger)


def entries(spark: SparkSession, ledger: str) -> list[dict]:
    """All entries of a ledger, in no order; none if it does not exist yet."""
    try:
        return [json.loads(r["value"]) for r in spark.read.text(ledger).collect()]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder of the session (``spark.checkpoint.dir``). Only a local
    master may do without that setting: a folder of this machine is no use to others."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="nestrel-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/nestrel-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder: evaluated once, whoever loses an executor."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class NotPublished(ValueError):
    """The checks of a version failed; ``report`` has the rules it broke."""

    def __init__(self, report: list):
        super().__init__("; ".join(f"{rule}: {n}" for rule, n in report))
        self.report = report


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the version that readers use; None before the first one."""
    known = entries(spark, f"{root}/ledger")
    return f"{root}/{max(known, key=lambda e: (e['number'], e['version']))['version']}" if known else None


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the version that is current when the call is made."""
    at = current(spark, root)
    if at is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.parquet(f"{at}/{table}")


def publish(spark: SparkSession, root: str, build: Callable[[str], DataFrame],
            tolerated: Collection[str] = ()) -> str:
    """Call ``build(folder)`` with a new folder; it writes its tables there and returns a
    report (rule, violations). Without violations, but for ``tolerated`` rules, the
    version becomes the current one and its folder is returned; else ``NotPublished``.
    Old versions stay as they are, for readers that have begun.
    """
    version = f"version-{uuid.uuid4().hex}"
    report = build(f"{root}/{version}").where("violations > 0").collect()
    broken = sorted((r["rule"], r["violations"]) for r in report if r["rule"] not in tolerated)
    if broken:
        raise NotPublished(broken)
    number = max((e["number"] for e in entries(spark, f"{root}/ledger")), default=0) + 1
    append_entry(spark, f"{root}/ledger", {"number": number, "version": version})
    return f"{root}/{version}"


def superseded(spark: SparkSession, root: str) -> list[str]:
    """Folders of versions that were current once and are no longer, oldest first."""
    known = sorted(entries(spark, f"{root}/ledger"), key=lambda e: (e["number"], e["version"]))
    return [f"{root}/{e['version']}" for e in known[:-1]]

