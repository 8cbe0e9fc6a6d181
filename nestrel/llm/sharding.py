"""Minimax contiguous partition: ordered atomic groups are cut into k runs so that
the largest run is as small as possible.

The smallest feasible capacity is found by binary search; a capacity is feasible if
greedy cutting (each shard takes as many whole groups as fit) needs at most k shards.
The running totals at which a cut may lie stay in Spark. The driver holds only a
bounded sample of them: one total for each block of the running-total axis. A greedy
run over known totals gives an upper bound of the capacity; one that may also cut
anywhere inside a block whose totals are not known gives a lower bound. As long as
the bounds differ, or the final cuts touch such a block, the blocks in question are
cut finer and asked for again. This ends with the exact optimum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestrel.llm.common import materialize

SALTS = 16               # places at which the rows of a repeated text meet


class Ends:
    """Known running totals (sorted, with 0 and the grand total); ``hidden[i]``: more
    totals lie strictly between known[i] and known[i + 1]."""

    def __init__(self, known: np.ndarray, hidden: np.ndarray):
        self.known, self.hidden = known, hidden

    def cut(self, reach: int, anywhere: bool) -> int:
        """The last place to cut at or before ``reach``."""
        i = int(np.searchsorted(self.known, reach, side="right")) - 1
        if anywhere and i < len(self.hidden) and self.hidden[i]:
            return reach
        return int(self.known[i])

    def cuts(self, capacity: int, k: int, anywhere: bool) -> list[int] | None:
        """Greedy shard ends, the last being the grand total; None if k don't do."""
        at, out, total = 0, [], int(self.known[-1])
        while at < total:
            to = self.cut(at + capacity, anywhere)
            if to == at or len(out) == k:
                return None
            out.append(at := to)
        return out

    def capacity(self, k: int, anywhere: bool) -> int:
        lo, hi = -(-int(self.known[-1]) // k), int(self.known[-1])
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.cuts(mid, k, anywhere) else (mid + 1, hi)
        return lo


def minimax_cuts(ends: DataFrame, total: int, k: int, blocks: int = 1 << 15) -> list[int]:
    """Greedy shard ends under the smallest feasible capacity. ``ends``: one column
    ``total_end`` (long), the distinct running totals after each group. ``blocks``:
    how many totals a round may bring to the driver."""
    blocks = max(blocks, 4 * k * k)                 # so that every round asks finer than the last
    state = Ends(np.array([0, total]), np.array([True]))
    while True:
        lo, hi = state.capacity(k, True), state.capacity(k, False)
        if lo == hi:                               # canonical cuts: greedy at the optimum
            exact, at, doubt = state.cuts(hi, k, False), 0, None
            for to in exact:
                if state.cut(at + hi, True) != to:
                    doubt = at + hi
                    break
                at = to
            if doubt is None:
                return exact
            spans = [(doubt, doubt)]
        else:                                      # where a cut can lie for any capacity in between
            slow = fast = 0
            spans = []
            for _ in range(k):
                slow, fast = state.cut(slow + lo, False), min(total, state.cut(fast + hi, True))
                spans.append((slow, fast))
        state = refine(state, ends, spans, blocks)


def refine(state: Ends, ends: DataFrame, spans: list[tuple[int, int]], blocks: int) -> Ends:
    """Cut the spans, widened to known totals, into about ``blocks`` equal parts and
    fetch, for each part that holds totals, its first and last one and whether it
    holds more. There are at most as many spans as shards."""
    runs: list[list[int]] = []
    last = len(state.known) - 1
    for a, b in sorted(spans):
        i = max(0, int(np.searchsorted(state.known, a, side="right")) - 1)
        j = min(last, max(i + 1, int(np.searchsorted(state.known, b, side="left"))))
        a, b = int(state.known[i]), int(state.known[j])
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(b, runs[-1][1])
        elif a < b:
            runs.append([a, b])
    width = max(1, sum(b - a for a, b in runs) // blocks)
    end = F.col("total_end")
    inside = F.lit(False)
    for a, b in runs:
        inside = inside | ((end > a) & (end < b))
    got = (ends.where(inside).groupBy(F.floor(end / width).alias("part"))
           .agg(F.max(end).alias("last"), F.min(end).alias("first"), F.count(F.lit(1)).alias("n"))
           .collect())
    fresh = sorted((r["first"], r["last"], r["n"] > 2) for r in got)
    known = np.array(sorted({*map(int, state.known), *(x for f in fresh for x in f[:2])}))
    # a gap may hide totals if it did so before and, where asked, lies inside a part with more
    hidden = state.hidden[np.searchsorted(state.known, known[1:]) - 1].copy()
    asked = np.zeros(len(hidden), dtype=bool)
    more = np.zeros(len(hidden), dtype=bool)
    for where, spans_ in ((asked, runs), (more, [f[:2] for f in fresh if f[2]])):
        for a, b in spans_:
            where[np.searchsorted(known, a):np.searchsorted(known, b)] = True
    hidden &= (~asked | more) & (np.diff(known) > 1)
    return Ends(known, hidden)


def running(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` in the order of ``keys`` with ``row_at`` (rows before) and ``total_at``
    (running ``size`` before), without bringing rows to one place: range partitions
    number their own rows, and the partitions' totals, one row for each, are added."""
    names = df.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = total = 0
        part = TaskContext.get().partitionId()
        for b in batches:
            size = b.column(names.index("size")).to_numpy()
            n, ends = len(size), np.cumsum(size, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(rows + np.arange(n)), pa.array(total + ends - size), pa.array(np.full(n, part))],
                names=[*names, "row_at", "total_at", "part"])
            rows, total = rows + n, total + int(ends[-1] if n else 0)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    numbered = materialize(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .mapInArrow(number, f"{fields}, row_at long, total_at long, part long"), "running")
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
             .select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n0"),
                     F.coalesce(F.sum("s").over(w), F.lit(0)).alias("s0")))
    # one row per range partition, so its size is that of the shuffle's partition count
    return (numbered.join(F.broadcast(parts), "part")
            .withColumn("row_at", F.col("row_at") + F.col("n0"))
            .withColumn("total_at", F.col("total_at") + F.col("s0"))
            .drop("part", "n0", "s0"))


def shard_bytes(docs: DataFrame, k: int = 40, id_col: str = "doc_id", text_col: str = "text",
                overhead: int = 16) -> DataFrame:
    """Deal ``docs`` to shards 0 .. k - 1 of nearly equal bytes (law ``bytes``).

    Groups are rows of equal texts and stay together; null texts are one group, apart
    from the empty ones, and have no bytes. Groups are ordered by their smallest id
    (null ids first), then by a digest of the text; rows in a group by id. Repeated rows are rows of
    their own. Slots number a shard's rows in that order. With fewer groups than
    shards the last shards stay empty; no rows give no rows. Other columns are ignored.
    """
    body = F.col(text_col).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + overhead).cast("long").alias("size"),
        F.coalesce(F.crc32(body), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(body, 256)), F.lit(b"")).alias("text_key"))
    low = F.lit(-(1 << 63)).cast("long")
    rows = materialize(rows.withColumn("id_key", F.coalesce("doc_id", low)), "sizes")
    # only texts that stand more than once have to learn their group; their rows, however many,
    # meet it in ``SALTS`` places
    first = (rows.groupBy("text_key").agg(F.min("id_key").alias("group_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id_key"), F.lit(SALTS)).cast("int"))
    grouped = salted.join(first, ["text_key", "salt"], "left").withColumn("group_id", F.coalesce("group_id", "id_key")).drop("salt")
    ordered = running(grouped, ["group_id", "text_key", "id_key"])

    # a group's rows are neighbours, so their running totals meet without a gap
    ends = materialize(ordered.groupBy("group_id", "text_key").agg(
        F.max(F.col("total_at") + F.col("size")).alias("total_end")).select("total_end"), "ends")
    total = ends.agg(F.max("total_end")).first()[0]
    cuts = minimax_cuts(ends, total, k) if total else []
    starts = sorted((r["total_at"], r["row_at"]) for r in           # at most k rows
                    ordered.where(F.col("total_at").isin([0, *cuts[:-1]])).select("total_at", "row_at").collect())
    shard, base = F.lit(0), F.lit(0).cast("long")
    for j, (at, row) in enumerate(starts):
        here = F.col("total_at") >= at
        shard, base = F.when(here, F.lit(j)).otherwise(shard), F.when(here, F.lit(row).cast("long")).otherwise(base)
    return ordered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), shard.cast("int").alias("shard"),
        (F.col("row_at") - base).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
