"""Full-text search and inverted indexes held as tables.

An inverted index is a ``(term, id)`` table: one row per distinct lexeme per
document. Lexemes are de-duplicated inside each row (``array_distinct``), so
building it needs no shuffle; writing it partitioned or bucketed by ``term``
turns a lookup into a pruned scan.

Two ways to answer a query:
* ``search`` - scan with the ``matches`` predicate (one narrow pass, filter
  evaluated in the scan stage; best for one-off queries);
* ``search_index`` - look terms up in a persisted index, then semi-join the
  ids back (best when the index is reused across queries).
Both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestrel.functions.search import lexemes, matches, query_lexeme_list


def build_index(df: DataFrame, id_col: str, text_col: str, kind: str = "exact",
                term_col: str = "term") -> DataFrame:
    """``(term, id)`` rows: the relational form of an inverted text index.

    Lexeme sets are computed in-row by built-in expressions, so the index needs
    no shuffle.
    """
    return df.select(F.explode(lexemes(F.col(text_col), kind)).alias(term_col), id_col)


def build_array_index(df: DataFrame, id_col: str, array_col: str,
                      elem_col: str = "element") -> DataFrame:
    """``(element, id)`` rows for an array column, one per distinct element."""
    return df.select(F.explode(F.array_distinct(array_col)).alias(elem_col), id_col)


def search(df: DataFrame, text_col: str, query: str, kind: str = "exact",
           id_col: str | None = None) -> DataFrame:
    """Rows whose text matches an OR / single-term query.

    With an ``id_col`` and ``kind="porter2"``, matching goes through the index rows
    instead of the per-document lexeme arrays.
    """
    if kind == "porter2" and id_col is not None:
        idx = build_index(df.select(id_col, text_col), id_col, text_col, kind)
        return search_index(idx, df, id_col, query, kind)
    return df.where(matches(F.col(text_col), query, kind))


def search_index(index: DataFrame, docs: DataFrame, id_col: str, query: str,
                 kind: str = "exact", term_col: str = "term") -> DataFrame:
    """Rows of ``docs`` found through the index (semi join on the ids)."""
    # literal terms: a pushed-down IN filter (partition pruning on an index
    # written partitioned by term)
    terms = query_lexeme_list(query, kind)
    ids = index.where(F.col(term_col).isin(terms)).select(id_col).distinct()
    return docs.join(ids, id_col, "left_semi")


def contains_all_via_index(index: DataFrame, docs: DataFrame, id_col: str, probe: list,
                           elem_col: str = "element") -> DataFrame:
    """Rows whose array holds every probe element, answered from an array index:
    ids with as many distinct probe hits as probe elements."""
    probe = sorted(set(probe))
    hits = (index.where(F.col(elem_col).isin(probe))
                 .groupBy(id_col).agg(F.count_distinct(elem_col).alias("__h"))
                 .where(F.col("__h") == len(probe)).select(id_col))
    return docs.join(hits, id_col, "left_semi")


def search_count(matched: DataFrame, related: DataFrame, key: str, related_key: str,
                 keep: list[str], count_col: str = "ct") -> DataFrame:
    """Search hits left-joined to a related table, ``count(*)`` per hit. The related rows are
    reduced to those of the hits before they are counted."""
    from nestrel.operators.relate import left_join_count
    hits = matched.select(F.col(key).alias(related_key))
    return left_join_count(matched, related.join(hits, related_key, "left_semi"), key, related_key, keep, count_col, count_rows=True)


def write_index(index: DataFrame, path: str, term_col: str = "term",
                partitions: int | None = None, id_col: str | None = None) -> None:
    """Persist an index clustered by term and id: range-partitioned and sorted, so
    each file and row group covers a narrow range of terms and a lookup
    ``term IN (...)`` skips the rest through parquet min/max statistics, while the rows
    of a frequent term are cut into ranges of ids, in as many files.
    (Partitioning directories by term would create one folder per term.)
    ``id_col`` is the index's other column unless named."""
    n = partitions or int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [term_col, id_col or next(c for c in index.columns if c != term_col)]
    index.repartitionByRange(n, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
