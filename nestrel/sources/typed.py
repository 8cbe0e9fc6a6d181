"""Loading rows into a table of declared types, with the rows that do not fit set aside.

A target is a list of ``Field``: name, type, and what its values must satisfy (NOT NULL, a
length, a range). It is compiled to one projection of built-in expressions, so a load is
one narrow pass over its source; nothing is shuffled, and no row ends it with an error.
Every row is either loaded or rejected, and a rejected row names each column that does
not fit, with the reason and the value as it came:

``null``    no value in a required column
``type``    the value cannot be read as the type at all (``12.html`` as an integer)
``range``   a number beyond the type's or the field's limits
``length``  a text longer than declared (only blanks too many are cut, as SQL's VARCHAR does)

Numbers going into integer columns are rounded half away from zero and into decimals
to their scale; texts must be whole integers for integer columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
WHOLE = r"^\s*[+-]?[0-9]+\s*$"
REASONS = ("null", "type", "range", "length")


@dataclass(frozen=True)
class Field:
    """One column of the target. ``type`` is DDL (``int``, ``decimal(10,2)``, ``array<string>``);
    ``max_len`` belongs to texts, ``low`` and ``high`` (both included) to numbers, dates and times."""

    name: str
    type: str
    required: bool = False
    max_len: int | None = None
    low: Any = None
    high: Any = None

    @property
    def data_type(self) -> T.DataType:
        return T.DataType.fromDDL(self.type)


def schema_of(target: Sequence[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.data_type, not f.required) for f in target])


def _cast(value: Column, source: T.DataType, kind: T.DataType) -> tuple[Column, Column]:
    """(value in the declared type or NULL, whether a NULL there is one of range)."""
    if isinstance(kind, INTEGERS):
        if isinstance(source, T.StringType):
            return value.try_cast(kind), value.rlike(WHOLE)
        if isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)):
            exact = value if isinstance(source, T.DecimalType) else value.try_cast("decimal(38,15)")
            return F.round(exact, 0).try_cast(kind), ~F.isnan(value.cast("double"))
        return value.try_cast(kind), F.lit(isinstance(source, T.NumericType))
    if isinstance(kind, T.DecimalType):
        number = value.try_cast("double")
        return value.try_cast(kind), number.isNotNull() & ~F.isnan(number)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return value.try_cast(kind), F.lit(False)
    if isinstance(kind, T.StringType):
        return value.cast("string"), F.lit(False)
    return value.try_cast(kind), F.lit(False)


def _fitted(field: Field, value: Column, source: T.DataType, kind: T.DataType) -> tuple[Column, Column]:
    """(value as loaded, reason or NULL) of one value."""
    out, too_large = _cast(value, source, kind)
    bad = F.when(value.isNotNull() & out.isNull(), F.when(too_large, F.lit("range")).otherwise(F.lit("type")))
    if field.max_len is not None and isinstance(kind, T.StringType):
        longer = F.length(out) > field.max_len
        blank = F.trim(F.substring(out, field.max_len + 1, 2147483647)) == ""
        bad = F.coalesce(bad, F.when(longer & ~blank, F.lit("length")))
        out = F.when(longer, F.substring(out, 1, field.max_len)).otherwise(out)
    for limit, beyond in ((field.low, lambda x, y: x < y), (field.high, lambda x, y: x > y)):
        if limit is not None:
            bad = F.coalesce(bad, F.when(beyond(out, F.lit(limit).cast(kind)), F.lit("range")))
    return out, bad


def _column(field: Field, df: DataFrame) -> tuple[Column, Column]:
    """(typed column, reason or NULL) of one field over the columns of ``df``."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.data_type), F.when(F.lit(field.required), F.lit("null"))
    value, source, kind = F.col(f"`{field.name}`"), df.schema[field.name].dataType, field.data_type
    if isinstance(kind, T.ArrayType):
        if not isinstance(source, T.ArrayType):
            out, bad = F.lit(None).cast(kind), F.when(value.isNotNull(), F.lit("type"))
        else:               # an array is as bad as its first bad element
            out = F.transform(value, lambda x: _fitted(field, x, source.elementType, kind.elementType)[0])
            bad = F.get(F.filter(F.transform(value, lambda x: _fitted(field, x, source.elementType, kind.elementType)[1]),
                                 lambda r: r.isNotNull()), F.lit(0))
    else:
        out, bad = _fitted(field, value, source, kind)
    if field.required:
        bad = F.when(value.isNull(), F.lit("null")).otherwise(bad)
    return out, bad


def checked(df: DataFrame, target: Sequence[Field], typed: str = "typed", rejects: str = "rejects") -> DataFrame:
    """``df`` with two more columns: the row as declared (a struct), and its faults (an array of
    column, reason, value; empty for a row that fits). Columns of the target that ``df``
    lacks are NULL; columns of ``df`` that the target does not name are not loaded."""
    parts = [(f, *_column(f, df)) for f in target]
    faults = F.array(*[F.struct(F.lit(f.name).alias("column"), bad.alias("reason"),
                                (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast("string").alias("value"))
                       for f, _, bad in parts])
    return df.select("*", F.struct(*[out.alias(f.name) for f, out, _ in parts]).alias(typed),
                     F.filter(faults, lambda x: x["reason"].isNotNull()).alias(rejects))


def accepted(df: DataFrame, target: Sequence[Field]) -> DataFrame:
    """The rows that fit, in the declared types."""
    ok = checked(df, target).where(F.size("rejects") == 0)
    return ok.select(*[F.col("typed").getField(f.name).alias(f.name) for f in target])


def rejected(df: DataFrame, target: Sequence[Field], keys: Sequence[str]) -> DataFrame:
    """``keys`` (as they came), column, reason, value: one row per fault."""
    return checked(df, target).select(*keys, F.explode("rejects").alias("fault")) \
        .select(*keys, "fault.column", "fault.reason", "fault.value")


class RejectedRows(ValueError):
    """A load that accepts no faulty row met one; nothing was published."""


def load(df: DataFrame, target: Sequence[Field], path: str, rejects_path: str | None = None,
         mode: str = "append") -> dict[str, int]:
    """Write the rows that fit to ``path``; read it back with ``read``.

    The counts come from the very pass that writes: ``rows``, ``loaded``, ``rejected`` and faults
    by reason. Rejected rows go to ``rejects_path`` as they came, with their faults, in a
    second pass that runs only if there are any. Without a ``rejects_path`` the load is
    all or nothing, like an INSERT: rows are counted first, and one that does not fit
    raises ``RejectedRows`` before anything is written.
    """
    seen = Observation()
    whole = checked(df, target)
    faults = {r: F.size(F.filter(F.transform("rejects", lambda x: x["reason"]), F.lit(r).eqNullSafe)) for r in REASONS}
    count = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size("rejects") == 0).alias("loaded"),
             *[F.sum(n).alias(r) for r, n in faults.items()]]
    if rejects_path is None:
        report = whole.agg(*count).first().asDict()
        if report["loaded"] < report["rows"]:
            raise RejectedRows(f"{report['rows'] - report['loaded']} of {report['rows']} rows do not fit: {report}")
        fit = whole
    else:
        fit = whole.observe(seen, *count).where(F.size("rejects") == 0)
    fit.select(*[F.col("typed").getField(f.name).alias(f.name) for f in target]).write.mode(mode).parquet(path)
    if rejects_path is not None:
        report = dict(seen.get)
        if report["loaded"] < report["rows"]:
            whole.where(F.size("rejects") > 0).drop("typed").write.mode(mode).parquet(rejects_path)
    report = {k: v or 0 for k, v in report.items()}
    return {"rejected": report["rows"] - report["loaded"], **report}


def read(spark: SparkSession, path: str, target: Sequence[Field]) -> DataFrame:
    """A loaded table, with the declared schema."""
    return spark.read.schema(schema_of(target)).parquet(path)
