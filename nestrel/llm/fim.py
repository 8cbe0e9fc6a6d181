"""Fill-in-the-middle: a text is cut into prefix, middle and suffix and written in another order.

The cut points are unit borders. One ``fullmatch`` of ``(unit)*`` by the regex library
retains every repetition of its group: the ends of group 1 are all borders, so they
give the number of units and, by index, both cut offsets. No text is shuffled; a task
holds one text and its borders at a time (about 60 bytes a unit).

``restored`` rebuilds a text from its written form with column functions alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestrel.llm.common import slices

MARKERS = ("<P>", "<S>", "<M>")        # prefix, suffix, middle
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, unit: str = r"(?s:.)", seed: str = "1", moved: int = 90, suffix_first: int = 20,
                   markers: tuple[str, str, str] = MARKERS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points), output (the text as written).

    The first four 8-digit groups of the sha256 of ``<seed>:<id>`` decide about a row: two
    give the cuts, one leaves 100 - ``moved`` in 100 texts plain, one writes
    ``suffix_first`` in 100 of the others as suffix, prefix, middle (spm) in place of
    prefix, suffix, middle (psm). ``unit`` is a pattern without groups; code points by
    default. Plain are also null and empty texts (n = 0), texts that hold a marker, and
    texts that are no whole number of units (n is null). Cut lengths of plain rows are null. A null id
    counts as an empty one; rows that repeat are each transformed, alike. Other columns
    are not looked at; no rows give no rows.
    """
    p, s, m = markers

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*")
        for batch in batches:
            for ids, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for doc, text in zip(ids, texts):
                    digest = sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
                    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
                    match = units.fullmatch(text)
                    ends = match.ends(1) if match else []
                    n = len(ends)
                    if not match or not text or h3 % 100 >= moved or any(x in text for x in markers):
                        rows.append((doc, n if match else None, "plain", None, None, text))
                        continue
                    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, b = (ends[k - 1] if k else 0 for k in (first, last))
                    spm = h4 % 100 < suffix_first
                    out = (f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}" if spm else
                           f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}")
                    rows.append((doc, n, "spm" if spm else "psm", a, b - a, out))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(task, SCHEMA))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that was written as ``output``. A psm or spm output holds each marker
    once: its text holds none, and no marker's end is another's beginning."""
    parts = F.split(output, "|".join(map(re.escape, markers)), -1)      # an empty one comes first
    prefix = F.when(form == "spm", parts[2]).otherwise(parts[1])
    suffix = F.when(form == "spm", parts[1]).otherwise(parts[2])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


def digests(written: DataFrame) -> DataFrame:
    """``fill_in_middle`` with digests in place of the texts; the second one is of the
    text rebuilt from the written form."""
    return written.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                          F.sha2("output", 256).alias("output_sha256"),
                          F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
numbers AS (
  SELECT doc_id, t, length(t) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM hashed),
cuts AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
