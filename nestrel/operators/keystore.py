"""A table with a key, checked a batch at a time.

The table lies in parts (folders) by its key: an integer key in ranges of 2^``span_bits``, any
other in ``span_bits``-bit buckets of its hash. Beside each part lies a sketch of its keys: a
Bloom filter of 64-bit words, a row per word in use. A new key whose bits are not all set
stands nowhere in the table, which is most of them; the few others are looked up exactly,
in the parts they would lie in and in no other. So a check costs as much as the batch is
large, not as the table is.

Batches are folders named by a ledger entry, so a batch is there as a whole or not at
all, and one that is replayed changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.sources.publish import append_entry, entries, written

PART, WORD, MASK = "key_part", "nestrel word", "nestrel mask"
SHIFTS = (40, 46, 52, 58)                     # of the hash: where a key's bits in its word come from
MOST_LITERALS = 1000                          # parts named in a filter; beyond that the parts are joined


class DuplicateKeys(ValueError):
    """A batch would break the key; nothing of it was added."""


@dataclass(frozen=True)
class KeyStore:
    """The table under ``root`` with the columns ``schema`` (a DDL string or StructType)."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    schema: T.StructType
    span_bits: int = 16
    bits_per_key: int = 12

    # -------------------------------------------------------------- layout
    def _part(self, cols: Sequence[str]) -> Column:
        kind = self.schema[self.keys[0]].dataType
        first = F.col(f"`{cols[0]}`").cast(kind)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return F.shiftright(first.cast("bigint"), self.span_bits)
        return F.xxhash64(first).bitwiseAND(F.lit((1 << self.span_bits) - 1))

    def _marked(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """``df`` with the part, word and bits of each key; types as in the table, so hashes agree."""
        typed = [F.col(f"`{c}`").cast(self.schema[k].dataType) for c, k in zip(cols, self.keys)]
        h = F.xxhash64(*typed)
        mask = F.lit(0).cast("bigint")
        for s in SHIFTS:
            bit = F.shiftrightunsigned(h, s).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
        words = max(1, (self.bits_per_key << self.span_bits) // 64)
        return df.withColumn(PART, self._part(cols)).withColumn(
            WORD, F.pmod(h.bitwiseAND(F.lit((1 << 40) - 1)), F.lit(words)).cast("int")).withColumn(MASK, mask)

    def _segments(self) -> list[int]:
        return sorted({e["batch"] for e in entries(self.spark, f"{self.root}/ledger")})

    def _read(self, kind: str, schema: T.StructType | str, parts: list[int] | None) -> DataFrame:
        """All committed rows of ``kind``; only the named parts' folders, if they are named."""
        some = self._segments()
        if not some:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(
            *[f"{self.root}/{kind}/batch={b}" for b in some])
        return df if parts is None else df.where(F.col(PART).isin(parts))

    def _rows(self, parts: list[int] | None = None) -> DataFrame:
        return self._read("rows", T.StructType([*self.schema.fields, T.StructField(PART, T.LongType())]), parts)

    def _touched(self, df: DataFrame) -> list[int] | None:
        """Parts of the rows of ``df``, or None for more than can be named in a filter."""
        found = [r[0] for r in df.select(PART).distinct().limit(MOST_LITERALS + 1).collect()]
        return found if len(found) <= MOST_LITERALS else None

    def table(self) -> DataFrame:
        return self._rows().select(*self.schema.names)

    # -------------------------------------------------------------- checks
    def _maybe(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """The marked rows whose key may stand in the table, written; all others do not."""
        marked = self._marked(df, cols)
        kind = f"word int, bits long, {PART} long"
        sketch = self._read("sketch", kind, self._touched(marked)).withColumnRenamed(PART, "of_part")
        hit = ((F.col(PART) == F.col("of_part")) & (F.col(f"`{WORD}`") == F.col("word"))
               & (F.col("bits").bitwiseAND(F.col(f"`{MASK}`")) == F.col(f"`{MASK}`")))
        return written(marked.join(sketch, hit, "left_semi"), "maybe")

    def _found(self, maybe: DataFrame, cols: Sequence[str]) -> DataFrame:
        """Key values of the table (``nestrel 0`` ..) in the parts of ``maybe``, a row per row there."""
        there = self._rows(self._touched(maybe))
        return there.select(*[F.col(k).alias(f"nestrel {i}") for i, k in enumerate(self.keys)], F.col(PART).alias("of_part"))

    def _same(self, cols: Sequence[str]) -> Column:
        met = F.col(PART) == F.col("of_part")
        for i, c in enumerate(cols):
            met = met & (F.col(f"`{c}`") == F.col(f"`nestrel {i}`"))
        return met

    def violations(self, batch: DataFrame) -> DataFrame:
        """Key values that would stand more than once after adding ``batch``, with the number of their
        rows (old and new); key values with a NULL are violations, too."""
        keys = list(self.keys)
        new = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        empty = F.lit(False)
        for k in keys:
            empty = empty | F.col(k).isNull()
        full = written(new, "batch-keys")
        maybe = self._maybe(full.where(~empty), keys).select(*keys, PART)
        old = (self._found(maybe, keys).join(maybe, self._same(keys), "left_semi")
               .groupBy(*[F.col(f"`nestrel {i}`").alias(k) for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("old")))
        total = F.col("n") + F.coalesce("old", F.lit(0))
        return full.join(old, keys, "left").where(empty | (total > 1)).select(*keys, total.cast("bigint").alias("n"))

    def missing(self, child: DataFrame, columns: Sequence[str]) -> DataFrame:
        """(columns, n): references of ``child`` that no row of the table answers, and their number.
        References with a NULL are not checked. What the sketch does not know is missing; the
        rest is looked up in its parts."""
        cols = list(columns)
        full = child.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        full = written(full, "references")
        maybe = self._maybe(full, cols)
        known = maybe.join(self._found(maybe, cols), self._same(cols), "left_semi").select(*cols)
        return full.join(known, cols, "left_anti")

    # -------------------------------------------------------------- adding
    def add(self, batch: DataFrame, number: int, check: bool = True) -> bool:
        """Add a batch; False if it had been added before. With ``check`` a batch that breaks the key
        raises ``DuplicateKeys`` and leaves the table as it was."""
        if number in self._segments():
            return False
        if check:
            broken = self.violations(batch).limit(5).collect()
            if broken:
                raise DuplicateKeys(", ".join(str(tuple(r)) for r in broken))
        keys = list(self.keys)
        path = f"{self.root}/rows/batch={number}"
        (batch.select(*[F.col(c).cast(f.dataType).alias(c) for c, f in zip(self.schema.names, self.schema.fields)])
         .withColumn(PART, self._part(keys)).repartition(F.col(PART), F.pmod(F.xxhash64(*keys), F.lit(4)))     # a part goes to four files at most
         .write.mode("overwrite").partitionBy(PART).parquet(path))
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(PART, T.LongType())])).parquet(path)
        sketch = self._marked(rows.select(*keys), keys).groupBy(PART, F.col(f"`{WORD}`").alias("word")).agg(
            F.bit_or(F.col(f"`{MASK}`")).alias("bits"))
        (sketch.repartition(PART).sortWithinPartitions(PART, "word").write.mode("overwrite").partitionBy(PART)
         .parquet(f"{self.root}/sketch/batch={number}"))
        append_entry(self.spark, f"{self.root}/ledger", {"batch": number})
        return True


def open_store(spark: SparkSession, root: str, keys: Sequence[str], schema: T.StructType | str, **options) -> KeyStore:
    """The store under ``root``; the first batch creates it. Layout options must not change later."""
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return KeyStore(spark, root, tuple(keys), kind, **options)
