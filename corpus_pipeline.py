"""The corpus pipeline: language, repeated lines, near-duplicates, benchmark leaks, packing.

Every stage takes all documents that the one before it kept. The first four return the
columns of ``documents``. Rows without an id cannot be named by a decision on ids: near-
duplicates and leaks leave them in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestrel.llm import decontaminate, langid, linededup, minhash, packing
from nestrel.llm.common import materialize, read, without_and_with


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language with a probability of half, go; without
    a labelled row all stay."""
    return langid.keep_identified(docs, langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which no word is left by
    that; n_chars becomes the new length of the texts that changed."""
    lines, gone = "nestrel lines before", "nestrel lines deleted"
    out = linededup.delete_repeated_runs(docs, counts=(lines, gone))
    changed = F.col(f"`{gone}`") > 0
    out = out.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, that with the smallest id; of rows that
    repeat its id one, any of them. Null, empty and blank texts are in
    no component and stay; rows without an id stay. No rows give no rows."""
    found = materialize(minhash.near_duplicates(docs).select("doc_id", "kept"), "near")
    away = found.where("doc_id IS NOT NULL AND NOT kept").select("doc_id")
    often = materialize(found.where("doc_id IS NOT NULL AND kept").groupBy("doc_id")
                        .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "often")
    rest, some = without_and_with(docs, away.union(often))
    left = some.join(away, "doc_id", "left_anti")
    once = left.join(often, "doc_id", "left_anti").select(*docs.columns)
    again = left.join(often, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return rest.unionByName(once).unionByName(again)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go, all rows of such an id. Null and empty texts and
    rows without an id stay; so does everything if the benchmark is empty."""
    found = decontaminate.leaks(docs, read(spark, sf_dir, "benchmark"))
    away = materialize(found.select("doc_id").distinct(), "leaks")
    rest, some = without_and_with(docs, away)
    return rest.unionByName(some.join(away, "doc_id", "left_anti").select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, one row each. A null or empty text is its end token alone;
    repeated rows are packed as often as they come, a null id stays null."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language), ("line dedup", line_dedup), ("near duplicates", near_dedup),
    ("decontamination", decontamination), ("packing", pack)]

# Language ID and near-duplicates have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the table is written and read."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{i}-{name.replace(' ', '-')}")
    return docs
