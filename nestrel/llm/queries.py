"""The corpus operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nestrel.llm import (
    bestfit,
    bitsliced,
    decontaminate,
    fim,
    langid,
    licenses,
    linededup,
    minhash,
    packing,
    quality,
    sharding,
    toxicity,
    warc,
)
from nestrel.llm.common import new_path, read


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read(spark, sf_dir, "pages"), new_path(spark, "warc"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"))


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.delete_repeated_runs(
        read(spark, sf_dir, "documents").select("doc_id", "text"), counts=("n_lines", "n_deleted"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_bytes(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(read(spark, sf_dir, "documents")))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack_best_fit(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_warc, op3_licenses, op4_langid, op5_decontaminate, op6_quality, op7_linededup, op8_sharding,
    op9_toxicity, op10_packing, op11_search, op12_fim, op13_best_fit)}
ORACLE: dict[str, str] = {"op2_warc": warc.SQL, "op7_linededup": linededup.SQL,
                          "op11_search": bitsliced.SQL, "op12_fim": fim.SQL}
