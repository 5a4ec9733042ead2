"""Finding, classifying and applying changes."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from nestloom.operators.nest import first_n


def row_digest(columns: Sequence[str]) -> Column:
    """Digest of a row's values; JSON keeps NULL, empty text and field borders apart."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], keep_same: bool = True) -> DataFrame:
    """Classify rows of two snapshots by key: ``insert``, ``update``, ``delete`` or ``same``.

    Gives ``op``, the keys and the new values (NULL for a delete). The old side travels as key and
    digest only. ``keys`` must identify a row in each snapshot.
    """
    keys = list(keys)
    values = [c for c in new.columns if c not in keys]
    before = old.select(*keys, row_digest(values).alias("_before"), F.lit(True).alias("_old"))
    after = new.select(*keys, *values, row_digest(values).alias("_after"), F.lit(True).alias("_new"))
    op = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_before") == F.col("_after"), "same")
        .otherwise("update")
    )
    joined = before.join(after, keys, "full_outer").select(op.alias("op"), *keys, *values)
    return joined if keep_same else joined.where(F.col("op") != "same")


def extract_since(df: DataFrame, column: str, mark: Any | None) -> DataFrame:
    """Rows above the high-water mark; no mark means from the start, and 0 is a mark like any other."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark))


def high_water(df: DataFrame, column: str, mark: Any | None = None) -> Any | None:
    """The mark after ``df`` was taken over; unchanged if ``df`` is empty."""
    top = df.agg(F.max(column)).first()[0]
    return mark if top is None else top


def latest_per_key(changes: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """One row per key, greatest version first; ties are settled by the other columns.

    One row per key and task is left before the shuffle, however often a key occurs.
    """
    others = [c for c in changes.columns if c not in keys and c != version]
    order = ([F.desc(version)] if version else []) + [F.desc_nulls_last(c) for c in others]
    return first_n(changes, list(keys), order or [F.lit(0)], 1)


def drop_stale(last: DataFrame, target: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Changes that are not older than the stored row of their key; an equal version stays, for replay."""
    keys = list(keys)
    newest = last.select(*keys, F.col(version).alias("_change"))
    stale = target.select(*keys, version).join(newest, keys).where(F.col(version) > F.col("_change")).select(*keys)
    return last.join(stale, keys, "left_anti")


def replace_rows(target: DataFrame, last: DataFrame, keys: Sequence[str], op: str | None = None) -> DataFrame:
    """``target`` with the rows of ``last`` (one per key) put in whole, or taken out where ``op`` is ``delete``."""
    keys = list(keys)
    kept = target.join(last.select(*keys), keys, "left_anti").select(*target.columns)
    added = last if op is None else last.where(F.coalesce(F.col(op) != "delete", F.lit(True)))
    added = added.select(*[c for c in target.columns if c in last.columns])
    return kept.unionByName(added, allowMissingColumns=True)


def upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], version: str | None = None, op: str | None = None
) -> DataFrame:
    """``target`` after ``changes``: whole rows replaced by key, latest version wins.

    Attributes a change lacks become NULL. Where the target stores ``version``, a change older than
    the stored row is dropped. With ``op``, changes marked ``delete`` remove their key; a removed key
    leaves no version behind. Applying the same changes again gives the same table.
    """
    last = latest_per_key(changes, keys, version)
    if version and version in target.columns:
        last = drop_stale(last, target, keys, version)
    return replace_rows(target, last, keys, op)
