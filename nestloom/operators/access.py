"""Key, prefix, index and latest-n lookups over a target keyed by ``PK`` and ``SK``.

A stored target is laid out in folders by a hash of its key (see ``sources.keyed``); when that column
is present, a lookup names it too, so only its folder is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nestloom.operators.nest import first_n

PART = "_part"


def part_of(column: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def _in_part(target: DataFrame, pk: str, parts: int | None) -> DataFrame:
    if parts and PART in target.columns:
        return target.where(F.col(PART) == part_of(F.lit(pk), parts))
    return target


def query(
    target: DataFrame,
    pk: str,
    sk: str | None = None,
    sk_prefix: str | None = None,
    descending: bool = False,
    limit: int | None = None,
    parts: int | None = None,
    pk_column: str = "PK",
    sk_column: str | None = "SK",
) -> DataFrame:
    """Items of one collection in sort-key order; both key conditions reach the Parquet scan."""
    found = _in_part(target, pk, parts).where(F.col(pk_column) == pk)
    if sk is not None:
        found = found.where(F.col(sk_column) == sk)
    if sk_prefix is not None:
        found = found.where(F.col(sk_column).startswith(sk_prefix))
    if sk_column:
        found = found.orderBy(F.desc(sk_column) if descending else F.asc(sk_column))
    return found if limit is None else found.limit(limit)


def get_item(target: DataFrame, pk: str, sk: str, parts: int | None = None) -> DataFrame:
    """The one item with this key, or no row."""
    return _in_part(target, pk, parts).where((F.col("PK") == pk) & (F.col("SK") == sk)).limit(1)


def by_entity(target: DataFrame, entity: str) -> DataFrame:
    return target.where(F.col("EntityType") == entity)


def build_index(target: DataFrame, pk_column: str, sk_column: str | None = None) -> DataFrame:
    """Sparse re-keyed copy: items without the index key are left out.

    Sorted by index key in range partitions, so files hold narrow key ranges and a lookup skips the
    others by their statistics.
    """
    keys = [pk_column] if sk_column is None else [pk_column, sk_column]
    rows = target.where(F.col(pk_column).isNotNull())
    tie = [c for c in ("PK", "SK") if c in target.columns]
    return rows.repartitionByRange(*keys, *tie).sortWithinPartitions(*keys)


def lookup(target: DataFrame, keys: DataFrame, on: str | list[str] = "PK") -> DataFrame:
    """All items for a table of requested keys in one join; Spark broadcasts the keys only below its own
    size threshold. ``sources.keyed`` has a lookup that never shuffles stored items."""
    columns = [on] if isinstance(on, str) else list(on)
    return target.join(keys.select(*columns).distinct(), columns, "left_semi")


def latest(target: DataFrame, n: int, sk_prefix: str | None = None) -> DataFrame:
    """The newest ``n`` items of every collection (greatest sort keys)."""
    rows = target if sk_prefix is None else target.where(F.col("SK").startswith(sk_prefix))
    return first_n(rows, "PK", [F.desc("SK")], n)


def pattern_counts(target: DataFrame, patterns: DataFrame) -> DataFrame:
    """Items that each access pattern returns, for a table ``patterns(pattern, pk, prefix)`` of any length.

    Patterns meet items by partition key and then by the prefix of the sort key (NULL: the whole collection). Items are
    counted per key and wanted prefix before patterns see them, so patterns that ask for the same share the
    work, and a pattern that finds nothing counts 0.
    """
    asked = patterns.select("pk", F.coalesce("prefix", F.lit("")).alias("prefix")).where("pk IS NOT NULL").distinct()
    lengths = asked.groupBy("pk").agg(F.collect_set(F.length("prefix")).alias("_lengths"))
    items = target.select(F.col("PK").alias("pk"), F.coalesce("SK", F.lit("")).alias("_sk"))
    # each item gives one row per length of prefix that is asked for under its key
    cut = items.join(lengths, "pk").select("pk", "_sk", F.explode("_lengths").alias("_n")).where("length(_sk) >= _n")
    found = cut.groupBy("pk", F.expr("left(_sk, _n)").alias("prefix")).agg(F.count(F.lit(1)).alias("items"))
    counted = asked.join(found, ["pk", "prefix"])
    out = patterns.withColumn("prefix", F.coalesce("prefix", F.lit(""))).join(counted, ["pk", "prefix"], "left")
    return out.select("pattern", F.coalesce("items", F.lit(0).cast("bigint")).alias("items"))
