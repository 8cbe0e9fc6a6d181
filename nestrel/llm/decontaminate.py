"""Benchmark decontamination by templates.

Texts are read as tokens (runs of anything but white space, without ASCII punctuation,
A-Z in lower case). A token with a digit, a unit and a name become typed placeholders;
their values are the *slots*. Windows of ``window`` tokens are hash-joined with those of
the benchmark items, once with the tokens as they are (EXACT) and twice as templates (TYPED:
names are capitalised words that do not begin a sentence or line; CAPITAL: all capitalised
words, wherever they stand); so a question is also found with other numbers, names or units
in it, and in other lines or letter case. A template needs ``literals`` words that are no
placeholders; items that are numbers, names and units almost throughout, and have no such window,
are looked up by their windows with one word or more.

Windows with the item's own values count. Of the others on one alignment those count whose
slots are consistent: a value of the item stands for one value in the document, that which
it stands for most often. A document leaks an item if the matches cover at least ``percent``
of the item's windows, or if ``run`` consecutive tokens of the item stand in it as they are.

A task keeps only windows that pass a bitmap of the benchmark's window hashes. The
bitmap has a fixed largest size; beyond what it can tell apart it lets more windows
pass to the join, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestrel.llm.common import materialize
from nestrel.llm.langid import parts
from nestrel.llm.shingles import mix, powers

# Units of measure, as tokens.
UNITS = ("mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs "
         "pound pounds oz ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds minute "
         "minutes hour hours day days week weeks month months year years percent dollar dollars cent cents euro euros "
         "degree degrees watt watts kw kwh mph kmh hz mhz ghz kb mb gb tb meter meters metre metres kilometer "
         "kilometers kilometre kilometres").split()
NUM, UNIT, NAME = 1, 2, 3                         # placeholder types; 0: a word as it is
EXACT, TYPED, CAPITAL = 0, 1, 2                   # lookups
MAX_BITS = 1 << 27

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_kind = np.zeros(256, dtype=np.uint8)             # 1: white space, 2: punctuation, 4: digit, 8: A-Z, 16: ends a sentence
_kind[[9, 10, 11, 12, 13, 32]] = 1
_kind[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
_kind[48:58] = 4
_kind[65:91] = 8
for _c in b".!?:":
    _kind[_c] |= 16


def _hash_runs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    p, inverse = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[:len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _unit_hashes() -> np.ndarray:
    raw = np.frombuffer("".join(UNITS).encode(), dtype=np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return np.sort(_hash_runs(raw, np.concatenate(([0], ends[:-1])), ends))


def templates(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all tokens of the texts in order: value hash, placeholder type, the type if every
    capitalised word is a name, text number."""
    raw = np.frombuffer(b"\n".join((t or "").encode("utf-8", "replace") for t in texts) + b"\n", dtype=np.uint8)
    lengths = np.array([len((t or "").encode("utf-8", "replace")) + 1 for t in texts])
    kind = _kind[raw]
    keep = (kind & 2) == 0                          # punctuation goes; what it says of sentences stays
    space = (kind & 1) == 1
    # words by white space, then without punctuation; a word of punctuation only is none
    word = np.cumsum(space | np.concatenate(([False], space[:-1])))
    kept = np.flatnonzero(keep & ~space)
    if not len(kept):
        return np.empty(0, np.uint64), np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, np.int64)
    w = word[kept]
    first = np.concatenate(([0], np.flatnonzero(np.diff(w)) + 1))
    last = np.concatenate((first[1:], [len(w)]))
    body = _lower[raw[kept]]
    value = _hash_runs(body, first, last)
    digit = np.logical_or.reduceat((kind[kept] & 4) > 0, first)
    owner = np.searchsorted(np.cumsum(lengths), kept[first], side="right")
    upper = (kind[kept[first]] & 8) > 0
    # a token begins a sentence if, since the token before, a sentence or line ended
    stop = np.concatenate(([0], np.cumsum(((kind & 16) > 0) | (raw == 10))))
    here, before = kept[first], np.concatenate(([0], kept[last[:-1] - 1]))
    begins = stop[here] > stop[before]
    begins[0] = True
    types = np.zeros(len(first), dtype=np.uint8)
    types[upper & ~begins] = NAME
    units = _unit_hashes()
    at = np.minimum(np.searchsorted(units, value), len(units) - 1)
    types[units[at] == value] = UNIT
    types[digit] = NUM
    return value, types, np.where(upper & (types == 0), np.uint8(NAME), types), owner


def windows(value: np.ndarray, types: np.ndarray, owner: np.ndarray, n: int, literals: int):
    """Starts and hashes of windows of n template tokens in one text, with at least
    ``literals`` words that are no placeholders."""
    if len(value) < n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    token = np.where(types > 0, mix(types.astype(np.uint64)), value)
    m = len(token) - n + 1
    h = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + token[i:i + m]
    words = np.cumsum(np.concatenate(([0], types == 0)))
    ok = (owner[:m] == owner[n - 1:]) & (words[n:] - words[:-n] >= literals)
    return np.flatnonzero(ok), mix(h[ok] + np.uint64(n))


def _window_rows(df: DataFrame, n_of, literals: int, bitmap, names: tuple[str, str]) -> DataFrame:
    """(id, position, n, look, hash, slots) of all windows of each lookup, or those whose hash
    is in the bitmap. EXACT ones have no slots and need no words."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value if bitmap is not None else None
        for batch in batches:
            for ids, texts in parts(batch.column(0), batch.column(1)):
                value, types, capital, owner = templates(texts)
                offset = np.searchsorted(owner, np.arange(len(texts)))
                looks = ((EXACT, np.zeros_like(types), 0), (TYPED, types, literals), (CAPITAL, capital, literals))
                for n, (look, kinds, least) in product(n_of(owner, len(texts)), looks):
                    length, only = n if isinstance(n, tuple) else (n, None)
                    at, h = windows(value, kinds, owner, length, min(least, length))
                    h = mix(h + np.uint64(look))
                    if only is not None and len(at):
                        some = only[owner[at]]
                        at, h = at[some], h[some]
                    if bits is not None and len(at):
                        spot = h & np.uint64(len(bits) * 64 - 1)
                        hit = (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) > 0
                        at, h = at[hit], h[hit]
                    if not len(at):
                        continue
                    slots = [[int(v) for v in value[a:a + length][kinds[a:a + length] > 0].view(np.int64)] for a in at]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(owner[at])), pa.array(at - offset[owner[at]]),
                         pa.array(np.full(len(at), length)), pa.array(np.full(len(at), look)),
                         pa.array(h.view(np.int64)), pa.array(slots, pa.list_(pa.int64()))],
                        names=[*names, "n", "look", "hash", "slots"])

    return df.mapInArrow(task, f"{names[0]} long, {names[1]} long, n long, look long, hash long, slots array<long>")


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, literals: int = 4, percent: int = 50, run: int = 13,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, matched, n_windows, same_values, by_template): the items that documents leak;
    ``by_template`` is how many of the item's windows the templates find, without the EXACT lookup.

    An item shorter than ``window`` tokens is one window of all its tokens. Windows with
    fewer than ``literals`` words (or all words of a shorter window) are found with their own
    values only, unless the item has no others: then one word will do; ``n_windows`` are all of the item's windows or those with enough words,
    whichever ``matched`` covers more of. Null or empty texts leak nothing. Rows of one id are one
    document (or item). Rows with null ids are left out here. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))

    def of_items(owner, count):
        size = np.bincount(owner, minlength=count)
        yield window, None
        for n in range(1, window):
            if (size == n).any():
                yield n, size == n

    every = _window_rows(items, of_items, 1, None, ("item_id", "item_pos"))
    by_item = Window.partitionBy("item_id")
    wordy = F.col("words") >= F.least(F.lit(literals), F.col("n"))
    fit = (F.col("look") == EXACT) | wordy | ~F.max(wordy & (F.col("look") != EXACT)).over(by_item)
    item = materialize(
        every.withColumn("words", F.col("n") - F.size("slots")).withColumn("fit", fit).where("fit").drop("fit", "words")
        .withColumn("typed", F.max(F.col("look") == TYPED).over(Window.partitionBy("item_id", "item_pos"))), "items")
    total = item.groupBy("item_id").agg(
        F.countDistinct("item_pos").alias("n_windows"),
        F.countDistinct(F.expr("CASE WHEN typed THEN item_pos END")).alias("typed_windows"))
    lengths = sorted(r[0] for r in item.select("n").distinct().collect())        # at most ``window``
    count = item.count()
    bits = min(MAX_BITS, max(1 << 16, 1 << (1024 * count).bit_length()))
    spot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    words = (item.select(F.shiftright(spot, 6).alias("word"),
                         F.expr(f"shiftleft(1L, cast((hash & {bits - 1}L) & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bit")).collect())       # bits / 64 rows at most
    bitmap = np.zeros(bits // 64, dtype=np.uint64)
    for r in words:
        bitmap[r["word"]] = np.uint64(r["bit"] & ((1 << 64) - 1))
    shared = spark.sparkContext.broadcast(bitmap)

    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"),
                                                          F.col(text_col).alias("text"))
    found = _window_rows(source, lambda *_: lengths, 1, shared, ("doc_id", "doc_pos"))
    match = materialize(
        found.join(item.withColumnRenamed("slots", "item_slots"), ["hash", "n", "look"])
        .where(F.size("slots") == F.size("item_slots"))
        .select("doc_id", "item_id", "item_pos", "n", "look", "typed", (F.col("doc_pos") - F.col("item_pos")).alias("shift"),
                F.arrays_zip("item_slots", "slots").alias("pairs")), "matches")
    key = ["doc_id", "item_id", "shift", "look"]
    pair = match.select(*key, "item_pos", F.explode("pairs").alias("p")).select(*key, "item_pos", "p.item_slots", "p.slots")
    votes = pair.groupBy(*key, "item_slots", "slots").agg(F.count(F.lit(1)).alias("n"))
    # what a torn value stands for: most often, then for itself
    stands = (votes.groupBy(*key, "item_slots")
              .agg(F.count(F.lit(1)).alias("values"),
                   F.max(F.struct("n", F.expr("item_slots = slots").alias("own"), "slots"))["slots"].alias("stands_for"))
              .where("values > 1").drop("values"))
    torn = pair.join(stands, [*key, "item_slots"]).where("slots != stands_for").select(*key, "item_pos").distinct()
    same = F.forall("pairs", lambda p: p["item_slots"] == p["slots"])
    match = match.withColumn("same", same)
    good = match.where("same").unionByName(match.where("NOT same").join(torn, [*key, "item_pos"], "left_anti"))
    good = good.groupBy("doc_id", "item_id").agg(
        F.countDistinct("item_pos").alias("matched"), F.countDistinct(F.expr("CASE WHEN typed THEN item_pos END"))
        .alias("typed_matched"), F.min("same").alias("same_values"),
        F.countDistinct(F.expr(f"CASE WHEN look <> {EXACT} THEN item_pos END")).alias("by_template"))
    # windows at consecutive positions of one alignment are one run of tokens
    line = Window.partitionBy("doc_id", "item_id", "shift").orderBy("item_pos")
    longest = (match.where(F.col("look") == EXACT).select("doc_id", "item_id", "shift", "item_pos", "n").distinct()
               .withColumn("at", F.col("item_pos") - F.row_number().over(line))
               .groupBy("doc_id", "item_id", "shift", "at").agg((F.count(F.lit(1)) + F.max("n") - 1).alias("tokens"))
               .groupBy("doc_id", "item_id").agg(F.max("tokens").alias("longest")))
    # of all windows and of those that can be found as templates, whichever share is greater
    by_typed = F.expr("typed_windows > 0 AND typed_matched * n_windows >= matched * typed_windows")
    return (good.join(total, "item_id").join(longest, ["doc_id", "item_id"], "left")
            .select("doc_id", "item_id", F.when(by_typed, F.col("typed_matched")).otherwise(F.col("matched")).alias("matched"),
                    F.when(by_typed, F.col("typed_windows")).otherwise(F.col("n_windows")).alias("n_windows"), "same_values", "by_template", "longest")
            .where((F.col("matched") * 100 >= F.col("n_windows") * percent) | (F.col("longest") >= run)).drop("longest"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, n_items, item_id (of those with
    the greatest share of windows the smallest), coverage, match (``exact`` where all slot
    values are the item's, ``reparameterised`` else), by_template (windows of that item that its
    templates find). Null ids are never contaminated."""
    share = F.col("matched") / F.col("n_windows")
    best = F.struct((-share).alias("s"), "item_id", share.alias("coverage"), "same_values", "by_template")
    by_doc = (leaks(docs, benchmark, id_col=id_col, **options).groupBy("doc_id")
              .agg(F.count(F.lit(1)).alias("n_items"), F.min(best).alias("best")))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id")).join(by_doc, "doc_id", "left")
            .select("doc_id", F.col("n_items").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"), "best.item_id", "best.coverage",
                    F.when(F.col("best.same_values"), "exact").when(~F.col("best.same_values"), "reparameterised")
                    .alias("match"), "best.by_template"))
