"""Column helpers that item builders are made of.

Everything here is a plain ``Column`` expression, so item building stays inside generated code and
never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = "decimal(18,2)"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key(prefix: str, *parts: Column | str) -> Column:
    """``PREFIX#a#b``; NULL if any part is NULL, which leaves the item out of a sparse index."""
    pieces: list[Column] = [F.lit(prefix)]
    for part in parts:
        pieces += [F.lit("#"), as_column(part).cast("string")]
    return F.concat(*pieces)


def text(c: Column | str) -> Column:
    """Absent (NULL) when empty."""
    c = as_column(c)
    return F.when(c != "", c)


def number(c: Column | str, keep_zero: bool = False) -> Column:
    """Absent (NULL) when zero, unless ``keep_zero``."""
    c = as_column(c)
    return c if keep_zero else F.when(c != 0, c)


def sparse(df: DataFrame, name: str, keep_zero: bool = False) -> Column:
    """Optional attribute of ``df``: the text or the number rule, chosen by the column's type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return text(name).alias(name)
    if isinstance(dtype, T.NumericType):
        return number(name, keep_zero).alias(name)
    return F.col(name)


def present(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """True when an optional attribute would be kept; never NULL."""
    c = as_column(c)
    kept = c != 0 if isinstance(dtype, T.NumericType) else c != ""
    return F.coalesce(kept, F.lit(False))


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last`` only when both parts are non-empty (``concat_ws`` alone would keep half)."""
    return F.concat(text(first), F.lit(" "), text(last))


def money(c: Column | str) -> Column:
    """Exact two-digit amount; cast before summing so totals carry no binary noise."""
    return as_column(c).cast(MONEY)


def iso_text(df: DataFrame, name: str) -> Column:
    """A date attribute as text: timestamps are formatted, text is passed through."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name)
    return F.date_format(name, ISO_FORMAT)


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, 0 for an empty whole (division by zero raises in ANSI mode)."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))
