"""Sum-of-squares packing of tokenised documents into fixed windows.

Every task tokenises its documents and packs them at once, in the order in which
they come; nothing is shuffled. A document's whole windows are sequences of their
own. What is left (shorter than a window) is placed online: of all fill levels that
have an open window and still have room, and of a new window, the one is taken that
leaves the smallest sum of squared counts of open windows per level. The counts are
held in an array indexed by level.

When a task's input ends, its open windows are closed by cutting, which is free:
their pieces are laid end to end into full windows, and what remains becomes windows
whose lengths are powers of two. So a task leaves no padding behind, however small
its share of the documents is.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def byte_bpe(tokenizer_path: str, pattern: str):
    """Encoder (text -> little-endian uint32 ids) for a byte-level BPE file of the
    tokenizers library. The ids of such a file are its merge ranks, so the same ids
    come from tiktoken, in a quarter of the time; ``pattern`` cuts the text into the
    pieces that merges never cross. Texts that hold an added token of the file, and those
    that tiktoken cannot cut (very long runs of white space), are encoded by the tokenizers
    library itself. Tests hold the two libraries against each other."""
    import tiktoken
    from tokenizers import Tokenizer

    spec = json.loads(open(tokenizer_path, encoding="utf-8").read())
    special = {t["content"] for t in spec.get("added_tokens", ())}
    # byte-level files write printable bytes as themselves, the others from U+0100 on
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    enc = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    whole = None

    def by_file(text: str) -> bytes:
        nonlocal whole
        whole = whole or Tokenizer.from_file(tokenizer_path)
        return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(text: str) -> bytes:
        if any(t in text for t in special):
            return by_file(text)
        try:
            return enc.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        except ValueError:                       # the backtracking stack of its pattern is full
            return by_file(text)

    return encode


class Packer:
    """The windows of one task. ``place`` takes a piece (doc_id, start, ids as
    bytes, doc_tokens); rows of windows that are done collect in ``rows``."""

    def __init__(self, window: int, first_id: int):
        self.window, self.next_id, self.rows = window, first_id, []
        self.counts = np.zeros(window + 1, dtype=np.int64)   # open windows by fill level
        self.open: dict[int, list[list]] = {}                # level -> windows (lists of pieces)

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def level_for(self, size: int) -> int:
        """The fill level, 0 for a new window, that leaves the least sum of squares;
        of equal ones the fullest. Moving a window from level h to h + size changes
        the sum by 1 - 2 c[h] at h and by 2 c[h + size] + 1 there; level 0 and a full
        window count nothing."""
        c, most = self.counts, self.window - size
        change = 2 * c[size:] + 1                  # at h + size, for h = 0 .. most
        change[most] = 0                           # a full window is no longer open
        change[1:] += 1 - 2 * c[1:most + 1]
        change[1:][c[1:most + 1] == 0] = np.iinfo(np.int64).max
        return most - int(np.argmin(change[::-1]))

    def place(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        h = self.level_for(size)
        if h:
            pieces = self.open[h].pop()
            self.counts[h] -= 1
            pieces.append(piece)
        else:
            pieces = [piece]
        if h + size == self.window:
            self.close(pieces)
        else:
            self.counts[h + size] += 1
            self.open.setdefault(h + size, []).append(pieces)

    def add(self, doc, ids: bytes) -> None:
        total, w = len(ids) // 4, self.window
        whole = total // w * w
        for start in range(0, whole, w):
            self.close([(doc, start, ids[4 * start:4 * (start + w)], total)])
        if whole < total:
            self.place((doc, whole, ids[4 * whole:], total))

    def finish(self) -> None:
        left = deque(p for level in sorted(self.open) for pieces in self.open[level] for p in pieces)
        rest = sum(len(p[2]) // 4 for p in left)
        room = [self.window] * (rest // self.window)
        rest %= self.window
        room += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        self.open.clear()
        for size in room:
            pieces, need = [], size
            while need:
                doc, start, ids, total = left.popleft()
                n = min(need, len(ids) // 4)
                pieces.append((doc, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    left.appendleft((doc, start + n, ids[4 * n:], total))
                need -= n
            self.close(pieces)


def pack(docs: DataFrame, tokenizer_path: str | None = None, pattern: str | None = None,
         window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack ``docs`` into sequences of at most ``window`` tokens; one row per piece.

    A document is its token ids and then ``end_id``; a null or empty text is that id
    alone. Repeated rows are packed as often as they come; a null id stays null.
    Columns other than the two named are not looked at. No rows give no rows.
    """
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
        pattern = public_tokenizers.PATTERN

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer_path, pattern)
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        end = np.array([end_id], dtype="<u4").tobytes()

        def out():
            cols = list(zip(*packer.rows)) or [()] * 7
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                packer.add(doc.as_py(), encode(text.as_py()) + end)
                if len(packer.rows) >= 10_000:
                    yield out()
        packer.finish()
        yield out()

    some = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return some.mapInArrow(task, SCHEMA)
