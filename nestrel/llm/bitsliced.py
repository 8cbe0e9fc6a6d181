"""Ranked lexical search over bit-sliced Bloom signatures.

Index (of the documents alone, queries play no part in it): every document is a row of
bits that holds its terms as a Bloom filter, once more for each occurrence count of
``LEVELS`` that a term reaches. Rows of like size stand together in blocks, and a block is
stored by slices: bit i of all its rows is one bitmap. Beside them are the documents'
lengths and, per term, the number of documents that hold it.

Search, per run of items:

1. The bitmaps of a term's bits, and-ed, tell which documents may hold it, and how often at
   most. The terms' weights, summed over those bitmaps, are an upper bound of every
   document's score: a Bloom filter errs to one side, and a score rises with the
   occurrences.
2. The documents with the highest bounds are scored exactly on their texts. The score of
   the ``top``-th of them is the bar of that item.
3. All documents that are not provably below the bar (a lower bound, or an equal one with
   a larger id than the ``top``-th's) are scored exactly, however many they are.

So the result is exact. Texts are read twice, and only candidates' texts are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestrel.llm.common import materialize, new_path
from nestrel.llm.shingles import mix

LEVELS = (1, 2, 4, 8, 16)                    # occurrences that have bits of their own
BITS_PER_ENTRY, HASHES = 12, 4
LEAST_BITS, MOST_BITS = 256, 1 << 21         # of a row; fuller rows only give weaker bounds
BLOCK_BITS = 1 << 21
ID_BITS = 1 << 23                            # of the bitmap that tells which texts are scored
GROUP = 16 << 20                             # bytes of a Parquet row group
SALTS = 16                                   # parts of an item's rows that are cut down on their own
INDEX = "bits int, doc_ids array<long>, lengths array<long>, slices binary, term string, df long"

# one byte to another: A-Z in lower case, all other ASCII but digits and letters to a space
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """Runs of digits, ASCII letters and all that is beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else []


def entry_hashes(term: np.ndarray, level: np.ndarray) -> np.ndarray:
    return mix(term + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def bit_places(entries: np.ndarray, bits: int) -> np.ndarray:
    """``HASHES`` bit numbers for each entry, one row per hash."""
    one, two = entries & np.uint64(0xFFFFFFFF), (entries >> np.uint64(32)) | np.uint64(1)
    return np.stack([(one + np.uint64(i) * two) & np.uint64(bits - 1) for i in range(HASHES)]).astype(np.int64)


class Hashes(dict):
    """64-bit hashes of terms, computed once while they are held."""

    def __missing__(self, term: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[term] = xxhash.xxh3_64_intdigest(term)
        return h


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks (bits a row, ids, lengths in terms, slices) and vocabulary rows (term, df: its
    documents in one part of a task's input; to be summed). Every row of ``docs`` has a row
    in a block, also those without a text."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        hashes = Hashes()
        reached = np.searchsorted(LEVELS, np.arange(LEVELS[-1] + 1), side="right")     # levels of a count
        df: Counter = Counter()

        def batch_of(bits, ids, lengths, slices, words, counts):
            return pa.RecordBatch.from_arrays(
                [pa.array(bits, pa.int32()), pa.array(ids, pa.list_(pa.int64())), pa.array(lengths, pa.list_(pa.int64())),
                 pa.array(slices, pa.binary()), pa.array(words, pa.string()), pa.array(counts, pa.int64())],
                names=["bits", "doc_ids", "lengths", "slices", "term", "df"])

        def block(bits):
            some = held.pop(bits)
            grid = np.zeros((bits, len(some)), dtype=np.bool_)
            row = np.repeat(np.arange(len(some)), [len(h) for _, _, h, _ in some])
            h, up = (np.concatenate([x[i] for x in some]) for i in (2, 3))
            for i in range(len(LEVELS)):
                at = up > i
                for places in bit_places(entry_hashes(h[at], np.full(1, i)), bits):
                    grid[places, row[at]] = True
            return batch_of([bits], [[x[0] for x in some]], [[x[1] for x in some]],
                            [np.packbits(grid, axis=1).tobytes()], [None], [None])

        def vocabulary():
            rows = list(df.items())
            df.clear()
            none = [None] * len(rows)
            return batch_of(none, none, none, none, [w.decode("utf-8", "replace") for w, _ in rows], [n for _, n in rows])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                words = terms(text.as_py())
                found = Counter(words)
                df.update(found.keys())
                h = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
                up = reached[np.minimum(np.fromiter(found.values(), dtype=np.int64, count=len(found)), LEVELS[-1])]
                bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_ENTRY * int(up.sum())).bit_length()))
                rows = held.setdefault(bits, [])
                rows.append((doc.as_py(), len(words), h, up))
                if len(rows) * bits >= BLOCK_BITS:
                    yield block(bits)
                if len(df) > 300_000:
                    yield vocabulary()
        for bits in list(held):
            yield block(bits)
        yield vocabulary()

    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(task, INDEX)
    path = new_path(docs.sparkSession, "signatures")
    made.write.option("parquet.block.size", GROUP).parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path)


class Items:
    """A run of items as arrays: their terms (hash, weight) and which item has which."""

    def __init__(self, found: list[list[bytes]], df: dict[bytes, int], n_docs: int, n_terms: int):
        words = sorted({w for some in found for w in some if df.get(w)})
        at = {w: i for i, w in enumerate(words)}
        self.words = words
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in words],
                                dtype=np.int64)
        self.of = [np.array([at[w] for w in some if w in at], dtype=np.int64) for some in found]
        self.n_docs, self.n_terms = n_docs, n_terms

    def norm(self, n):
        """m of documents with n terms (a number or an array)."""
        return 100 - 90 + (90 * n * self.n_docs) // self.n_terms

    def bounds(self, bits: int, lengths: np.ndarray, slices: bytes) -> np.ndarray:
        """An upper bound of the score of every item (row) for every document (column) of a block."""
        rows = np.frombuffer(slices, dtype=np.uint8).reshape(bits, -1)
        m = self.norm(lengths)
        part = np.zeros((len(self.words), len(lengths)))             # a bound of a term's share, without its weight
        may, below = None, np.zeros(len(lengths), dtype=np.int64)
        for i in range(len(LEVELS)):
            places = bit_places(entry_hashes(self.hashes, np.full(len(self.hashes), i)), bits)
            here = np.bitwise_and.reduce(rows[places], axis=0)
            may = here if may is None else may & here
            most = np.minimum(LEVELS[i + 1] - 1, lengths) if i + 1 < len(LEVELS) else lengths
            share = (1_000_000_000 * most) // (1000 * most + 8 * m)
            part += np.unpackbits(may, axis=1, count=len(lengths)) * np.maximum(share - below, 0)
            below = np.maximum(share, below)
        return np.stack([self.weights[t].astype(np.float64) @ part[t] for t in self.of])

    def scores(self, text: str, wanted: list[int]) -> list[int]:
        """Exact scores of one text for the items asked for."""
        words = terms(text)
        m, found = self.norm(len(words)), Counter(words)
        out = []
        for item in wanted:
            score = 0
            for t in self.of[item]:
                tf = found.get(self.words[t], 0)
                score += int(self.weights[t]) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            out.append(score)
        return out


def best(df: DataFrame, by: str, n: int) -> DataFrame:
    """The n rows of every item with the highest ``by``, of equal ones the smallest ids. An
    item that many tasks have rows of is cut down in ``SALTS`` parts first."""
    order = (F.col(by).desc(), F.col("doc_id").asc_nulls_last())
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    some = df.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    last = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return some.where(F.col("rank") <= n).drop("part").withColumn("rank", last).where(F.col("rank") <= n)


def highest_bounds(blocks: DataFrame, items: Items, n: int) -> DataFrame:
    """item, doc_id, bound: the n highest bounds of every item. A task keeps n of an item at a time."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.empty(0), np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)) for _ in items.of]
        for batch in batches:
            for bits, ids, lengths, slices in zip(*batch.columns):
                ids = ids.values
                null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                found = items.bounds(bits.as_py(), lengths.values.to_numpy(), slices.as_py())
                for item, row in enumerate(found):
                    old = kept[item]
                    some = np.flatnonzero(row > (old[0][-1] if len(old[0]) == n else 0))
                    if len(some):
                        new = [np.concatenate(x) for x in zip(old, (row[some], ids[some], null[some]))]
                        order = np.lexsort((new[1], new[2], -new[0]))[:n]
                        kept[item] = tuple(x[order] for x in new)
        for item, (bound, ids, null) in enumerate(kept):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), item), pa.int32()), pa.array(ids, mask=null), pa.array(bound.astype(np.int64))],
                names=["item", "doc_id", "bound"])

    return best(blocks.mapInArrow(task, "item int, doc_id long, bound long"), "bound", n).drop("rank")


def not_below(blocks: DataFrame, items: Items, bar: np.ndarray, last: np.ndarray) -> DataFrame:
    """item, doc_id: every document whose bound is above the item's ``bar``, or equal to
    it with an id not above ``last``."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bits, ids, lengths, slices in zip(*batch.columns):
                ids = ids.values
                low = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
                bound = items.bounds(bits.as_py(), lengths.values.to_numpy(), slices.as_py())
                item, row = np.nonzero((bound > bar[:, None]) | ((bound == bar[:, None]) & (low <= last[:, None])))
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids.take(pa.array(row))],
                                                 names=["item", "doc_id"])

    return blocks.mapInArrow(task, "item int, doc_id long").distinct()


def exact(source: DataFrame, pairs: DataFrame, items: Items) -> DataFrame:
    """item, doc_id, score (above 0) of the pairs (item, doc_id), on whole texts. ``source``:
    key (the id, 0 for none), doc_id, text. A bitmap of fixed size over the keys' last
    bits keeps most other texts out of the shuffle; the join decides."""
    wanted = materialize(pairs.groupBy(F.coalesce("doc_id", F.lit(0)).alias("key"))
                         .agg(F.collect_set("item").alias("items")), "wanted")     # at most all items of this run
    last = F.col("key").bitwiseAND(F.lit(ID_BITS - 1))
    bitmap = np.zeros(ID_BITS // 64, dtype=np.int64)
    for r in (wanted.groupBy(F.shiftright(last, 6).cast("int").alias("word"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits")).collect()):
        bitmap[r["word"]] = r["bits"]
    shared = source.sparkSession.sparkContext.broadcast(bitmap)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy() & (ID_BITS - 1)
            yield batch.filter(pa.array((shared.value[at >> 6] >> (at & 63)) & 1 > 0))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, asked in zip(*batch.columns):
                doc, asked = doc.as_py(), asked.as_py()
                rows += [(i, doc, s) for i, s in zip(asked, items.scores(text.as_py(), asked)) if s > 0]
            kinds = (pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 3, kinds)],
                                             names=["item", "doc_id", "score"])

    return (source.mapInArrow(some, "key long, doc_id long, text string").join(wanted, "key")
            .select("doc_id", "text", "items").mapInArrow(task, "item int, doc_id long, score long"))


def search(docs: DataFrame, queries: DataFrame, top: int = 10, probe: int = 40, terms_at_once: int = 4000,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item with a score above 0.

    ``queries`` are taken in runs of about ``terms_at_once`` distinct terms, so that the arrays of a
    task stay small; ``probe`` documents an item set its bar and change nothing in the
    result. Equal scores go by ascending id, null ids last. Null and empty texts, and
    texts without a term, are no documents; items without a term that some document
    holds have no rows. Rows that repeat are documents (items) of their own and are ranked one
    by one. Other columns are not looked at. No documents or no items give no rows.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col)
    blocks = index.where("bits IS NOT NULL").select("bits", "doc_ids", "lengths", "slices")
    held = blocks.select(F.explode("lengths").alias("n")).where("n > 0").agg(F.count("n"), F.sum("n")).first()
    n_docs, n_terms = held[0], held[1] or 0
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("key"),
                         F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .where(F.col("text").isNotNull())
    kind = queries.schema[item_col].dataType
    schema = f"item_id {kind.simpleString()}, rank int, doc_id long, score long"

    def one(run: list) -> DataFrame:
        found = [sorted(set(terms(r["text"]))) for r in run]
        words = spark.createDataFrame([(w.decode("utf-8", "replace"),) for w in sorted(set().union(*found))], "term string")
        df = {r["term"].encode("utf-8"): r["df"] for r in
              index.where("term IS NOT NULL").select("term", "df").join(F.broadcast(words), "term")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()}
        items = Items(found, df, n_docs, n_terms)
        first = materialize(highest_bounds(blocks, items, probe), "probe")
        bar, last = np.zeros(len(run), dtype=np.int64), np.full(len(run), np.iinfo(np.int64).min)
        for r in best(exact(source, first, items), "score", top).where(F.col("rank") == top).collect():   # a row an item
            bar[r["item"]] = r["score"]
            last[r["item"]] = np.iinfo(np.int64).max if r["doc_id"] is None else r["doc_id"]
        scored = exact(source, not_below(blocks, items, bar, last), items)
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(run)], f"item int, item_id {kind.simpleString()}")
        return (best(scored, "score", top).join(F.broadcast(names), "item")
                .select("item_id", "rank", "doc_id", "score"))

    out, run, seen = [], [], set()
    if n_docs:
        for r in queries.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).toLocalIterator():
            new = set(terms(r["text"]))
            if not new:
                continue
            if run and len(seen | new) > terms_at_once:
                out.append(materialize(one(run), "ranked"))
                run, seen = [], set()
            run.append(r)
            seen |= new
        if run:
            out.append(one(run))
    if not out:
        return spark.createDataFrame([], schema)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = f"""
WITH doc_terms AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM documents)
  GROUP BY doc_id, term),
doc_sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM doc_terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM doc_sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM doc_terms, corpus GROUP BY term),
item_terms AS (
  SELECT DISTINCT item_id, term
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM benchmark)),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (term) JOIN doc_terms USING (term) JOIN doc_sizes USING (doc_id), corpus
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
