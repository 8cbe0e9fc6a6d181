"""Integrity rules as DataFrame checks (file tables enforce none of them).

Every check returns the violating rows (or a per-rule report), so "the load
is valid" is "every check is empty" and the checks run after the write and
before publishing, as constraints added after a bulk load would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.operators.numbering import dense_numbers


def unique_violations(df: DataFrame, keys: Sequence[str], primary: bool = False,
                      count_col: str = "n") -> DataFrame:
    """Key values held by more than one row (``PRIMARY KEY`` / ``UNIQUE``).

    With ``primary`` a NULL in any key column is a violation too (reported
    with the count of such rows). A UNIQUE constraint ignores NULL keys.
    """
    keys = list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    # one partially aggregated pass: NULL keys group together like values do
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    if not primary:
        return counted.where(~any_null & (F.col(count_col) > 1))
    return counted.where(any_null | (F.col(count_col) > 1))


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (``REFERENCES``)."""
    keys = parent.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull())
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def fk_orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """One-row count of orphans for one foreign key."""
    return fk_orphans(child, fk, parent, pk).agg(F.count(F.lit(1)).alias("orphans"))


def fk_orphan_counts(tables: dict[str, DataFrame], foreign_keys: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """(child, fk, orphans) for every ``(child, column, parent, key)``, in one aggregation and without a join.

    Every table is read once and gives one row per rule it takes part in, as child or as
    parent. Grouped by rule and value, first inside each task, a value is an orphan's if no
    parent row has it; a value held by a third of the children is one row after the
    partial step. NULL references are no orphans.
    """
    roles: dict[str, list] = {}
    for i, (child, fk, parent, key) in enumerate(foreign_keys):
        roles.setdefault(child, []).append((i, fk, 1))
        roles.setdefault(parent, []).append((i, key, 0))
    kinds = [tables[t].schema[c].dataType for t, some in roles.items() for _, c, _ in some]
    as_type = "bigint" if all(isinstance(k, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for k in kinds) else "string"
    parts = [tables[t].select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("rule"), F.col(c).cast(as_type).alias("value"), F.lit(n).alias("child")) for i, c, n in some])))
        for t, some in roles.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    held = every.where("value IS NOT NULL").groupBy("rule", "value").agg(
        F.sum("child").alias("children"), F.min("child").alias("lone"))          # lone: no parent row among them
    lost = held.groupBy("rule").agg(F.sum(F.when(F.col("lone") == 1, F.col("children")).otherwise(0)).alias("orphans"))
    spark = next(iter(tables.values())).sparkSession
    rules = spark.range(len(foreign_keys)).select(
        F.col("id").cast("int").alias("rule"),
        F.element_at(F.array(*[F.lit(c) for c, _, _, _ in foreign_keys]), (F.col("id") + 1).cast("int")).alias("child"),
        F.element_at(F.array(*[F.lit(f) for _, f, _, _ in foreign_keys]), (F.col("id") + 1).cast("int")).alias("fk"))
    return rules.join(lost, "rule", "left").select("child", "fk", F.coalesce("orphans", F.lit(0)).cast("bigint").alias("orphans"))


def cascade_delete(child: DataFrame, fk: str, deleted_parent_keys: DataFrame, pk: str) -> DataFrame:
    """Child rows that survive deleting the given parents (``ON DELETE CASCADE``).

    Apply along the foreign-key graph child-first; each step is an anti join.
    """
    gone = deleted_parent_keys.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull())
    return child.join(gone, fk, "left_anti")


def cascade_along(tables: dict[str, DataFrame], foreign_keys: Sequence[tuple[str, str, str, str]], root: str,
                  deleted: DataFrame) -> dict[str, DataFrame]:
    """Tables that lose rows when the rows ``deleted`` of ``root`` go, as they are after it.

    ``foreign_keys`` are ``(child, column, parent, key)`` without cycles. A child row goes
    with any of its parents, and its own children with it; NULL references stay.
    """
    order, lost, kept = [root], {root: deleted}, {}
    reached = {root}
    while True:
        more = {c for c, _, p, _ in foreign_keys if p in reached} - reached
        if not more:
            break
        reached |= more
    while len(order) < len(reached):            # parents first
        free = [t for t in sorted(reached - set(order))
                if all(p in order or p not in reached for c, _, p, _ in foreign_keys if c == t)]
        if not free:
            raise ValueError("the foreign keys form a cycle")
        order += free
    for t in order[1:]:
        refs = [(fk, p, pk) for c, fk, p, pk in foreign_keys if c == t and p in lost]
        gone, left = None, tables[t]
        for fk, p, pk in refs:
            keys = lost[p].select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull()).distinct()
            some = left.join(keys, fk, "left_semi")     # of the rows that are still there
            gone = some if gone is None else gone.unionByName(some)
            left = left.join(keys, fk, "left_anti")
        lost[t], kept[t] = gone, left
    return kept


def domain_violations(df: DataFrame, keys: Sequence[str], rules: dict[str, dict]) -> DataFrame:
    """Rows breaking ``NOT NULL`` / ``VARCHAR(n)`` rules.

    ``rules = {"col": {"not_null": True, "max_len": 20}}``; the output has the
    key columns, the column name and the rule broken (one row per breach).
    """
    parts = []
    for col, r in rules.items():
        if r.get("not_null"):
            parts.append(df.where(F.col(col).isNull())
                         .select(*keys, F.lit(col).alias("col"), F.lit("not_null").alias("rule")))
        if r.get("max_len") is not None:
            parts.append(df.where(F.length(col) > r["max_len"])
                         .select(*keys, F.lit(col).alias("col"),
                                 F.lit(f"max_len_{r['max_len']}").alias("rule")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assign_ids(batch: DataFrame, order_col: str | Sequence[str], start_after: DataFrame | int,
               id_col: str = "id", buckets: int | None = None) -> DataFrame:
    """Dense surrogate ids ``max(existing)+1 ..`` numbered in the order of ``order_col``, one column
    or several of any orderable type (NULLs first; full ties in any order).

    Rows are numbered inside ``buckets`` sorted ranges and offset by the rows of the ranges
    before (``numbering``): no global window, no cut points on the driver.
    """
    if isinstance(start_after, int):
        base = start_after
    else:
        # one scalar through the driver (the current maximum id)
        base = start_after.agg(F.max(F.col(start_after.columns[0]))).first()[0] or 0
    by = [order_col] if isinstance(order_col, str) else list(order_col)
    return dense_numbers(batch, [F.col(c).asc_nulls_first() for c in by], id_col, base, buckets)
