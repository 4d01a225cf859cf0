"""Lenient / strict scalar coercions (J5-J8, J19, J20) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_bool(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """bool -> itself; int-like -> value != 0 (floats truncate first); else NULL."""
    col = _c(c)
    if isinstance(dtype, T.BooleanType):
        return col
    if isinstance(dtype, T.NumericType):
        return col.cast("bigint") != F.lit(0)
    return F.trim(col.cast("string")).try_cast("bigint") != F.lit(0)


def float_or_null(c: Column | str) -> Column:
    """Lenient: anything that does not parse as a number becomes NULL."""
    return _c(c).try_cast("double")


def strict_float(c: Column | str, dtype: T.DataType | None = None, zero_is_null: bool = False) -> Column:
    """Strict float: NULL/'' -> NULL, numbers and numeric text -> double.

    ``zero_is_null=True`` reproduces the falsy test of the original loader where
    a reading of 0 (0 degrees, 0 % rain) was dropped."""
    col = _c(c)
    if isinstance(dtype, T.StringType) or dtype is None:
        v = F.trim(col).try_cast("double")
        v = F.when(F.trim(col) == F.lit(""), F.lit(None).cast("double")).otherwise(v)
    elif isinstance(dtype, T.BooleanType):
        v = F.lit(None).cast("double")
    else:
        v = col.cast("double")
    if zero_is_null:
        v = F.when(v == F.lit(0.0), F.lit(None).cast("double")).otherwise(v)
    return v


def strict_float_error(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """True when the strict conversion must fail (non-numeric text, boolean true)."""
    col = _c(c)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(col, F.lit(False))
    if isinstance(dtype, T.StringType) or dtype is None:
        t = F.trim(col)
        return col.isNotNull() & (col != F.lit("")) & t.try_cast("double").isNull()
    return F.lit(False)


def falsy_default(a: Column | str, b: Column | str | None, falsy=("",)) -> Column:
    """``a or b``: falsy values of ``a`` (NULL, '' or listed values) fall back to ``b``."""
    col = _c(a)
    cond = col.isNull()
    for v in falsy:
        cond = cond | (col == F.lit(v))
    other = _c(b) if b is not None else F.lit(None)
    return F.when(cond, other).otherwise(col)


def safe_get(arr: Column | str, idx: Column | int) -> Column:
    """0-based array element, NULL past the end (never raises under ANSI)."""
    i = F.lit(idx) if isinstance(idx, int) else idx
    return F.get(_c(arr), i)


def try_int(c: Column | str) -> tuple[Column, Column]:
    """(int value, error flag) for ids that must be integers."""
    col = _c(c)
    v = F.trim(col.cast("string")).try_cast("bigint")
    return v, col.isNotNull() & v.isNull()
