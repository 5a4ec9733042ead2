"""Configured column transformations and masking.

A rule is ``(column, kind)``; kinds live in plain dicts of ``Column -> Column`` functions, so a user
adds one with ``TRANSFORMS["my_kind"] = lambda c: ...``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

ColumnFunction = Callable[[Column], Column]


def phone_digits(c: Column) -> Column:
    """Keep digits and a leading plus; empty becomes NULL."""
    return F.nullif(F.regexp_replace(c, r"(?!^\+)[^0-9]", ""), F.lit(""))


def latin1_text(c: Column) -> Column:
    """Binary latin1 content as proper text."""
    return F.decode(c, "ISO-8859-1")


# Text that can be such a number at all. Only a filter in front of ``try_cast``, which raises and
# catches an error per bad value and so is slow on a column that is often bad.
_PAD = r"[\x00-\x20]*"
_FRACTION = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
NUMBER_SHAPES = {
    "tinyint": rf"^{_PAD}[+-]?[0-9]+{_PAD}$",
    "smallint": rf"^{_PAD}[+-]?[0-9]+{_PAD}$",
    "int": rf"^{_PAD}[+-]?[0-9]+{_PAD}$",
    "bigint": rf"^{_PAD}[+-]?[0-9]+{_PAD}$",
    "decimal": rf"^{_PAD}{_FRACTION}{_PAD}$".replace("[0-9]", r"\p{Nd}"),
    "float": rf"^{_PAD}({_FRACTION}[dDfF]?|(?i:[+-]?inf(inity)?|nan)){_PAD}$",
    "double": rf"^{_PAD}({_FRACTION}[dDfF]?|(?i:[+-]?inf(inity)?|nan)){_PAD}$",
}


def safe_cast(c: Column, dtype: str) -> Column:
    """Text as ``dtype``, NULL where it is not one."""
    shape = NUMBER_SHAPES.get(dtype.split("(")[0].strip().lower())
    return c.try_cast(dtype) if shape is None else F.when(c.rlike(shape), c.try_cast(dtype))


TRANSFORMS: dict[str, ColumnFunction] = {
    "lowercase": F.lower,
    "uppercase": F.upper,
    "trim": F.trim,
    "format_phone": phone_digits,
    "latin1": latin1_text,
    "to_long": lambda c: safe_cast(c, "bigint"),
    "to_double": lambda c: safe_cast(c, "double"),
    "to_money": lambda c: safe_cast(c, "decimal(18,2)"),
    "to_timestamp": lambda c: c.try_cast("timestamp"),
}

MASKS: dict[str, ColumnFunction] = {
    "characters": lambda c: F.mask(c),
    "sha256": lambda c: F.sha2(c.cast("string"), 256),
    "md5": lambda c: F.md5(c.cast("string")),
    "digits": lambda c: F.regexp_replace(c, "[0-9]", "n"),
    "remove": lambda c: F.when(F.lit(False), c),  # NULL of the column's own type
}


def _apply(df: DataFrame, rules: Iterable[tuple[str, str]], known: dict[str, ColumnFunction]) -> DataFrame:
    changed: dict[str, Column] = {}
    for column, kind in rules:
        if kind not in known:
            raise ValueError(f"unknown rule {kind!r} for column {column!r}; known: {sorted(known)}")
        changed[column] = known[kind](changed.get(column, F.col(column)))
    return df.withColumns(changed) if changed else df


def transform_columns(df: DataFrame, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Apply ``(column, kind)`` rules in order; several rules on one column chain."""
    return _apply(df, rules, TRANSFORMS)


def mask_columns(df: DataFrame, rules: Iterable[tuple[str, str]], salt: str = "") -> DataFrame:
    """Mask the listed columns of a copy meant for non-production use.

    Digests take ``salt`` in front of the value: without a secret one, values of a column that has few are found by
    trying them all. Equal values stay equal under one salt, so masked keys still join.
    """
    salted = {n: lambda c, hashed=MASKS[n]: hashed(F.concat(F.lit(salt), c.cast("string"))) for n in ("sha256", "md5")}
    return _apply(df, rules, MASKS | salted)
