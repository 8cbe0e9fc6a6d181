"""Best-fit-decreasing packing of tokenised documents into windows.

Only documents longer than a window are cut: their first piece takes the odd tokens,
the others are whole windows. Best fit decreasing over all pieces of the corpus:

1. Every task tokenises its documents and numbers its pieces per length.
2. Counts per task and length become offsets, so that the pieces of one length are
   numbered 0, 1, ... over all tasks. No task sees all pieces of a length.
3. Best fit treats pieces of one length alike, so the number of pieces per length (at
   most ``window`` numbers) is all that placing needs. Lengths are taken from the longest
   down; a segment tree over remaining capacities finds the tightest open window in
   logarithmic time. Windows of equal capacity are filled as a run, piece by piece the
   same as one at a time: a window that has just taken a piece is the tightest one as
   long as it has room for another.
4. The runs (a length's pieces from .. to go into windows from .., at ..) are a table
   whose size depends on the window alone; every piece looks its place up there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestrel.llm.common import materialize
from nestrel.llm.packing import byte_bpe

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Capacities:
    """A segment tree over remaining capacities 0 .. ``most``: how many open windows have
    each, and the smallest capacity in use that is at least a given one."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.leaves
        while at:
            self.tree[at] += n
            at >>= 1

    def tightest(self, least: int) -> int | None:
        at = least + self.leaves
        while not self.tree[at]:
            while at & 1:                     # up until there is a right neighbour
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:               # down to its leftmost capacity in use
            at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing of ``counts[length]`` pieces. Runs (length, first piece, pieces
    a window, first window, offset): from that piece on, pieces of that length go one
    after the other into windows counted from that one, at that offset and after it."""
    tree, spans, runs, fresh = Capacities(window), {}, [], 0

    def put(capacity, first, n):
        if capacity and n:
            spans.setdefault(capacity, []).append((first, n))
            tree.add(capacity, n)

    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first = window, fresh
                n = -(-(total - done) // (window // length))
                fresh += n
            else:
                first, n = spans[capacity].pop()
                tree.add(capacity, -n)
            each = capacity // length
            full = min(n, (total - done) // each)
            if full:
                runs.append((length, done, each, first, window - capacity))
                put(capacity - each * length, first, full)
                done += full * each
            if full < n:                      # the last pieces of this length
                rest = total - done
                if rest:
                    runs.append((length, done, rest, first + full, window - capacity))
                    put(capacity - rest * length, first + full, 1)
                    done = total
                put(capacity, first + full + (rest > 0), n - full - (rest > 0))
    return runs


def pieces_of(docs: DataFrame, tokenizer_path: str, pattern: str, window: int, end_id: int, id_col: str,
              text_col: str) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = byte_bpe(tokenizer_path, pattern), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4").tobytes()
        rows: list[tuple] = []

        def out():
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids, doc = memoryview(encode(text.as_py()) + end), doc.as_py()
                start, total = 0, len(ids) // 4
                for piece in range(-(-total // window)):
                    length = (total - 1) % window + 1 if piece == 0 else window
                    rows.append((doc, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]),
                                 number, int(seen[length])))
                    seen[length] += 1
                    start += length
                if len(rows) >= 10_000:
                    yield out()
                    rows = []
        yield out()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(task, PIECES))


def pack_best_fit(docs: DataFrame, tokenizer_path: str | None = None, pattern: str | None = None, window: int = 2048,
                  end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack ``docs`` into sequences of at most ``window`` tokens; one row per piece: doc_id,
    piece, start, length, ids_crc32 (of the ids as little-endian 32-bit numbers),
    sequence_id, offset.

    A document is its token ids and then ``end_id``; a null or empty text is that id
    alone. Repeated rows are packed as often as they come; a null id stays null. Pieces
    of equal length are interchangeable, so which of them goes where follows the layout
    of the input. Other columns are not looked at. No rows give no rows.
    """
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
        pattern = public_tokenizers.PATTERN
    pieces = materialize(pieces_of(docs, tokenizer_path, pattern, window, end_id, id_col, text_col), "pieces")
    counts = materialize(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()           # at most ``window`` rows
    runs = np.array(sorted(best_fit({r["length"]: r["n"] for r in totals}, window)) or np.empty((0, 5)), dtype=np.int64)
    shift = 62 - window.bit_length()
    keys = (runs[:, 0] << shift) + runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            run = runs[np.searchsorted(keys, (length << shift) + number, side="right") - 1]
            window_no, inside = np.divmod(number - run[:, 1], np.maximum(run[:, 2], 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(run[:, 3] + window_no), pa.array(run[:, 4] + inside * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (pieces.join(base.hint("merge"), ["task", "length"])       # a row per task and length: never a broadcast
            .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("number"))
            .mapInArrow(place, PLACED))
