"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of every operator: maximal runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir of the
    session. Only where none is set (tests, one machine) a local one is made."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="nestrel-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{work_dir(spark)}/nestrel-{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage, and a lost executor never makes an earlier step run again."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without_and_with(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", bits: int = 1 << 23) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` whose id is surely not among ``ids``, the rows that may be). A bitmap over the ids'
    last bits tells them apart, at most ``bits`` / 64 rows that are broadcast; so only the second ones
    have to be shuffled with their texts in a join that decides. Null ids are in neither table of
    ids, and in the first result."""
    last = F.col(id_col).cast("long").bitwiseAND(F.lit(bits - 1))
    word, bit = F.shiftright(last, 6).cast("int"), last.bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bitmap = ids.where(F.col(id_col).isNotNull()).groupBy(word.alias("nestrel word")).agg(F.bit_or(one).alias("nestrel bits"))
    bitmap = materialize(bitmap, "bitmap")
    marked = docs.join(F.broadcast(bitmap), word == F.col("`nestrel word`"), "left")
    maybe = F.coalesce(F.col("`nestrel bits`").bitwiseAND(one) != 0, F.lit(False))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where(~maybe).select(*names), marked.where(maybe).select(*names)


def word_array(text: Column) -> Column:
    """Words of a text in order; no words for null or blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def id_crc32(col: str = "doc_id") -> Column:
    """crc32 of an id written as decimal text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def fold(col: str, mod: int, rest: int) -> Column:
    """True for rows of the held-out fold; rows without an id are in no fold."""
    return F.coalesce(id_crc32(col) % mod == rest, F.lit(False))


def slices(ids: list, texts: list, most_chars: int = 1_000_000) -> Iterator[tuple[list, list]]:
    """Cut one Arrow batch into runs of about ``most_chars`` characters, so that the
    arrays made per run stay small; a longer text makes a run of its own."""
    start = chars = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and chars + n > most_chars:
            yield ids[start:i], texts[start:i]
            start, chars = i, 0
        chars += n
    if start < len(texts):
        yield ids[start:], texts[start:]
