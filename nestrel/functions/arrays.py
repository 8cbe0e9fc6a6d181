"""Array predicates and canonical forms with relational (PostgreSQL-like) NULL rules.

``contains_all(a, b)``  - every element of b occurs in a (``a @> b``)
``contained_by(a, b)``  - every element of a occurs in b (``a <@ b``)
``set_equal(a, b)``     - both of the above
``ordered_equal(a, b)`` - same elements in the same order (``a = b``)

A NULL element never matches anything, so an array holding NULL is not
contained by any probe. A NULL array gives NULL (a WHERE clause drops it).
Probes given as Python lists become one ``array_contains`` per element (or one
``array_except``), which are compiled with the rest of the stage; a probe that is itself a
column needs a lambda, which Spark interprets.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(values: Iterable) -> Column:
    """Array literal from a Python list (the ``'{a, b}'`` of the SQL text)."""
    return F.array(*[F.lit(v) for v in values])


def _as_array(v) -> Column:
    return v if isinstance(v, Column) else literal(v)


def _member(arr: Column, x: Column) -> Column:
    # array_contains is NULL when arr holds a NULL and x is absent; treat that
    # as "not found", and a NULL x as never found.
    return F.when(x.isNull(), F.lit(False)).otherwise(F.coalesce(F.array_contains(arr, x), F.lit(False)))


def contains_all(a: Column, b) -> Column:
    if not isinstance(b, Column):
        found = F.lit(True)
        for v in b:
            found = found & (F.coalesce(F.array_contains(a, F.lit(v)), F.lit(False)) if v is not None else F.lit(False))
        return F.when(a.isNotNull(), found)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.forall(b, lambda x: _member(a, x)))


def contained_by(a: Column, b) -> Column:
    if not isinstance(b, Column):
        known = [v for v in b if v is not None]     # a NULL element is contained by no probe
        rest = F.array_except(a, literal(known)) if known else a
        return F.when(a.isNotNull(), F.size(rest) == 0)
    return contains_all(b, a)


def set_equal(a: Column, b) -> Column:
    return contains_all(a, b) & contained_by(a, b)


def ordered_equal(a: Column, b) -> Column:
    return a == _as_array(b)


def canonical(a: Column) -> Column:
    """Order-insensitive canonical form: the sorted array (NULLs last)."""
    return F.array_sort(a)


def cardinality(a: Column) -> Column:
    """Number of elements as BIGINT; NULL for a NULL array (also when a
    session runs with ANSI mode off, where ``size(NULL)`` is -1)."""
    return F.when(a.isNotNull(), F.size(a)).cast("bigint")

