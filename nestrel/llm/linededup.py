"""Repeated line runs, deleted but for their first copy; DataFrame functions only.

A document is a sequence of its lines that hold a word. A *repeated run* is a run of
neighbouring lines with ``min_words`` words or more which also stands earlier, in the
order of (doc_id, line). Every line of a repeated run is deleted; so each maximal
repeated run goes as a whole, and its first copy stays.

Suffixes of the line sequences are ranked by distributed prefix doubling: ranks by one
line are the order of the distinct repeated lines; ranks by 2h lines are the order of
the distinct pairs (rank by h lines here, rank by h lines h lines on). Distinct pairs are
counted before they are sorted, so a pair that stands everywhere is one row. A line that
stands once ends a repeated run and takes no part.

Suffixes that share their first l lines are an interval of the suffix array with a
longest common prefix of l or more: the pair of ranks of the prefix' first and last
2^k <= l lines names it, and its smallest position is the first copy. A line lies in a
repeated run if and only if the shortest run with ``min_words`` words that starts there,
or the shortest one that ends there, or one from a line near it does so; hence those
runs, of at most ``min_words`` lines, decide, and doubling ends there: deeper ranks
would not change what is deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestrel.llm.common import SPACE, materialize

_LOW = -(1 << 63)


def _numbered(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Ranks > 0 in the order of ``keys`` (not dense; range partitions count their own). The keys
    are distinct, so a range that is made again has the same ranks."""
    return distinct.orderBy(*keys).select(*keys, (F.monotonically_increasing_id() + 1).alias("new"))


def _document(id_col: str, text_col: str) -> list[Column]:
    """What tells documents apart: the id (null first) and, for rows of one id, the text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(_LOW)).alias("__d"),
            F.xxhash64(F.col(text_col)).alias("__t")]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_lines(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(__d, __t, __gone): sorted line numbers that are deleted, for documents that lose any."""
    words = F.size(F.filter(F.split(F.col("line"), SPACE), lambda w: w != ""))
    lines = (docs.where(F.col(text_col).isNotNull())
             .select(*_document(id_col, text_col), F.posexplode(_lines(F.col(text_col))).alias("ln", "line"))
             .select("__d", "__t", "ln", words.alias("w"), F.unhex(F.md5(F.col("line").cast("binary"))).alias("h"))
             .where("w > 0"))
    # rows that repeat a document are that document
    lines = materialize(lines.dropDuplicates(["__d", "__t", "ln"]), "lines")
    often = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    ids = _numbered(often, ["h"])

    by_doc = Window.partitionBy("__d", "__t").orderBy("pos")
    pos = F.row_number().over(Window.partitionBy("__d", "__t").orderBy("ln"))
    # what is read once, ranks and the lines that carry them, is not written: every file costs
    # its task a process or two for the permissions, beside the time
    state = (lines.select("__d", "__t", "ln", "w", "h", pos.alias("pos")).join(ids, "h")
             .select("__d", "__t", "pos", "ln", "w", F.array("new").alias("r")))
    h = 1
    while 2 * h <= min_words:
        here = F.element_at("r", -1)
        pairs = state.select(
            "*", here.alias("a"),
            F.when(F.lead("pos", h).over(by_doc) == F.col("pos") + h, F.lead(here, h).over(by_doc))
            .otherwise(F.lit(0)).alias("b"))
        pairs = materialize(pairs, "pairs")
        new = _numbered(pairs.groupBy("a", "b").agg(F.lit(1)).select("a", "b"), ["a", "b"])
        state = pairs.join(new, ["a", "b"]).select(
            "__d", "__t", "pos", "ln", "w", F.concat("r", F.array("new")).alias("r"))
        h *= 2

    cell = F.struct("pos", "ln", "w", "r")
    after = F.collect_list(cell).over(by_doc.rowsBetween(0, min_words - 1))
    before = F.reverse(F.collect_list(cell).over(by_doc.rowsBetween(1 - min_words, 0)))
    near = state.select("__d", "__t", "pos", after.alias("after"), before.alias("before"))
    near = near.select("__d", "__t", "pos", F.explode(F.array(
        F.struct(F.lit(1).alias("step"), F.col("after").alias("cells")),
        F.struct(F.lit(-1).alias("step"), F.col("before").alias("cells")))).alias("x"))
    near = near.select("__d", "__t", "pos", "x.step", "x.cells")
    reach = F.aggregate(
        "cells", F.struct(F.lit(0).alias("words"), F.lit(0).alias("n")),
        lambda acc, c: F.when(acc["words"] >= min_words, acc)
        .otherwise(F.struct((acc["words"] + c["w"]).alias("words"), (acc["n"] + 1).alias("n"))))
    near = near.withColumn("reach", reach).where(F.col("reach.words") >= min_words)
    near = near.withColumn("n", F.col("reach.n"))
    far = F.expr("cells[n - 1]")
    near = near.where(far["pos"] == F.col("pos") + F.col("step") * (F.col("n") - 1))
    near = near.withColumn("k", F.floor(F.log2("n")).cast("int"))
    head = F.expr("CASE WHEN step = 1 THEN cells[0] ELSE cells[n - 1] END")
    tail = F.expr("CASE WHEN step = 1 THEN cells[n - shiftleft(1, k)] ELSE cells[shiftleft(1, k) - 1] END")
    runs = materialize(near.select(
        "__d", "__t", head["pos"].alias("pos"), "step", "n",
        F.expr("transform(slice(cells, 1, n), c -> c.ln)").alias("covers"),
        head["r"][F.col("k")].alias("first_rank"), tail["r"][F.col("k")].alias("last_rank")), "runs")
    name = ["step", "n", "first_rank", "last_rank"]
    where = F.struct("__d", "__t", "pos")
    first = runs.groupBy(*name).agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    return (runs.join(first, name).where(where != F.col("first"))
            .select("__d", "__t", F.explode("covers").alias("ln")).distinct()
            .groupBy("__d", "__t").agg(F.sort_array(F.collect_list("ln")).alias("__gone")))


def delete_repeated_runs(docs: DataFrame, min_words: int = 10, id_col: str = "doc_id",
                         text_col: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from the text; all its
    columns as they are otherwise. ``counts`` names two more columns to add: lines with
    a word before, and lines deleted.

    Lines are split at \\n and compared byte by byte. Lines without a word are in no run
    and stay. Null, empty and blank texts come back as they are; a text whose lines all
    go becomes empty. Null ids come first in the order. Rows that repeat an id and its
    text are one document and lose the same lines; rows of one id with different texts are
    documents of their own, ordered by a hash of the text. Other columns may have any name.
    No rows give no rows.
    """
    names = docs.columns
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])      # so that none is one of the names used here
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    gone = materialize(repeated_lines(docs, min_words, id_col, text_col), "gone")
    d, t = _document(id_col, text_col)
    rows = docs.select("*", d, t, _lines(F.col(text_col)).alias("__lines"))
    rows = rows.drop(text_col).join(gone, ["__d", "__t"], "left")
    # the stretches between two deleted lines, in order
    kept = F.expr("""flatten(transform(sequence(0, size(__gone)), i ->
        slice(__lines,
              CASE WHEN i = 0 THEN 1 ELSE __gone[i - 1] + 2 END,
              CASE WHEN i = size(__gone) THEN size(__lines) ELSE __gone[i] END
              - CASE WHEN i = 0 THEN 0 ELSE __gone[i - 1] + 1 END)))""")
    lines = F.when(F.col("__gone").isNull(), F.col("__lines")).otherwise(kept)
    out = [(F.array_join(lines, "\n") if c == text_col else F.col(c)).alias(name) for c, name in zip(docs.columns, names)]
    if counts:
        wordy = F.size(F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        out += [F.when(F.col("__lines").isNull(), 0).otherwise(wordy).cast("long").alias(counts[0]),
                F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias(counts[1])]
    return rows.select(*out)


SQL = r"""
WITH v AS (
  SELECT doc_id, list(line ORDER BY ln) AS ls, list(w ORDER BY ln) AS ws, list(ln ORDER BY ln) AS ns
  FROM (SELECT doc_id, ln, ls[ln] AS line, len(regexp_extract_all(ls[ln], '[^\x20\x09-\x0D]+')) AS w
        FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS ln
              FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))
  WHERE w > 0 GROUP BY doc_id),
blocks AS (
  SELECT doc_id, s, e, ns, ls[s:e] AS block, list_sum(ws[s:e]) AS words
  FROM (SELECT *, unnest(range(s, least(s + 10, len(ls) + 1))) AS e
        FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS s FROM v))),
later AS (
  SELECT * FROM (SELECT doc_id, s, e, ns, row_number() OVER (PARTITION BY block ORDER BY doc_id, s) AS copy
                 FROM blocks WHERE words >= 10) WHERE copy > 1),
gone AS (SELECT DISTINCT doc_id, unnest(ns[s:e]) AS ln FROM later),
lines AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS ln, ls
          FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
kept AS (
  SELECT l.doc_id, string_agg(CASE WHEN g.ln IS NULL THEN l.ls[l.ln] END, chr(10) ORDER BY l.ln) AS text,
         count(CASE WHEN regexp_matches(l.ls[l.ln], '[^\x20\x09-\x0D]') THEN 1 END) AS n_lines,
         count(g.ln) AS n_deleted
  FROM lines l LEFT JOIN gone g USING (doc_id, ln) GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_deleted, 0) AS n_deleted
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
