"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams (1 to 3 characters of lower-cased letters and single spaces)
of labelled texts per language and bucket. The matrix of log-probabilities, buckets by
languages, has a fixed number of rows and is broadcast; tasks add up a text's rows of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestrel.llm.common import fold

BUCKETS = 1 << 16
_SPACE = 32
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point whether it is a letter; made once per Python worker."""
    if not _letters:
        _letters.append(np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), dtype=bool))
    return _letters[0]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all n-grams of the texts, and the text that each belongs to."""
    code = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
            if t else np.array([_SPACE, _SPACE], dtype=np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(c) for c in code])
    s = np.concatenate(code)
    s = np.where(letters()[s], s, np.uint32(_SPACE))
    new = np.ones(len(s), dtype=bool)                       # one space between words
    new[1:] = (s[1:] != _SPACE) | (s[:-1] != _SPACE) | (owner[1:] != owner[:-1])
    s, owner = s[new], owner[new]
    a = s * np.uint32(0x9E3779B1)
    letter, same = s != _SPACE, owner[1:] == owner[:-1]
    two = (a[:-1] ^ (s[1:] * np.uint32(0x85EBCA77))) + np.uint32(2)
    three = (two[:-1] * np.uint32(0xC2B2AE3D) ^ (s[2:] * np.uint32(0x27D4EB2F))) + np.uint32(3)
    ok3 = same[1:] & same[:-1]
    grams = np.concatenate((a[letter], two[same], three[ok3]))
    grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((grams >> np.uint32(16)).astype(np.int64) % BUCKETS,
            np.concatenate((owner[letter], owner[:-1][same], owner[:-2][ok3])))


def parts(ids, texts, most_chars: int = 500_000) -> Iterator[tuple[pa.Array, list]]:
    """An Arrow batch in runs of about that many characters."""
    start = chars = 0
    some: list = []
    for i, t in enumerate(texts):
        t = t.as_py()
        some.append(t)
        chars += len(t or "")
        if chars >= most_chars or i + 1 == len(ids):
            yield ids[start:i + 1], some
            start, chars, some = i + 1, 0, []


def sample(docs: DataFrame, rows: int, label_col: str, id_col: str) -> DataFrame:
    """About ``rows`` rows of each label, or all of a rarer one: those whose hashed id is
    smallest. The same rows whatever the partitions are."""
    share = {r[0]: min(1.0, rows / r[1]) for r in docs.groupBy(label_col).count().collect()}
    keep = F.lit(False)
    spot = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1_000_003)) / 1_000_003.0
    for label, s in share.items():
        keep = keep | ((F.col(label_col) == label) & (spot < s))
    return docs.where(keep)


def train(docs: DataFrame, rows: int = 5000, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and the matrix of log-probabilities, from about ``rows`` labelled rows
    of each language (all of a rarer one) outside the held-out fold."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~fold(id_col, 3, 1))
    some = sample(known.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                               F.col(text_col).alias("text")), rows, "lang", "id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            at = 0
            for ids, texts in parts(batch.column(0), batch.column(1)):
                grams, owner = ngrams(texts)
                mine = langs[at:at + len(ids)]
                at += len(ids)
                for lang in set(mine):
                    c = np.bincount(grams[(mine == lang)[owner]], minlength=BUCKETS)
                    total[lang] = total.get(lang, 0) + c
        for lang, c in total.items():
            hit = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit)), pa.array(hit), pa.array(c[hit])],
                                             names=["lang", "bucket", "n"])

    counts = (some.select("lang", "text").mapInArrow(task, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())   # languages x BUCKETS at most
    langs = sorted(counts["lang"].unique())
    matrix = np.ones((BUCKETS, max(1, len(langs))))
    for j, lang in enumerate(langs):
        c = counts[counts["lang"] == lang]
        matrix[c["bucket"], j] += c["n"]
    return langs, np.log(matrix / matrix.sum(axis=0)).astype(np.float32)


def _scored(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of its language (len(langs): und) and the posterior."""
    grams, owner = ngrams(texts)
    sums = np.stack([np.bincount(owner, matrix[grams, j], minlength=len(texts))
                     for j in range(matrix.shape[1])], axis=1)
    sums -= sums.max(axis=1, keepdims=True)
    best, score = sums.argmax(axis=1), 1 / np.exp(sums).sum(axis=1)
    none = np.array([not t or not any(map(str.isalpha, t)) for t in texts]) | (not langs)
    best[none], score[none] = len(langs), 0.0
    return best, score


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs``, from the whole text alone. The
    score is the posterior probability under equal priors. Null texts, texts without a
    letter, and all texts where no language was learned are ``und`` with score 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value[0], "und"], dtype=object)
        for batch in batches:
            for ids, texts in parts(batch.column(0), batch.column(1)):
                best, score = _scored(texts, *shared.value)
                yield pa.RecordBatch.from_arrays([ids, pa.array(names[best], pa.string()), pa.array(score)],
                                                 names=["doc_id", "lang_pred", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(task, "doc_id long, lang_pred string, score double"))


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray], least: float = 0.5,
                    text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a learned language with
    a score of at least ``least``; all rows where no language was learned."""
    if not model[0]:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for _, texts in parts(batch.column(at), batch.column(at)):
                best, score = _scored(texts, *shared.value)
                yield batch.slice(start, len(texts)).filter(pa.array((best < len(shared.value[0])) & (score >= least)))
                start += len(texts)

    return docs.mapInArrow(task, docs.schema)


def identify(docs: DataFrame, rows: int = 5000, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Train on the labelled rows and predict every row: doc_id, held_out, lang_pred, score.

    Rows without an id are neither held out nor trained on. Repeated rows are predicted
    alike. Columns other than the three named are not looked at; no rows give no rows.
    """
    out = predict(docs, train(docs, rows, id_col, text_col, lang_col), id_col, text_col)
    return out.select("doc_id", fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
