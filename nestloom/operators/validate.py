"""Reconciling targets with their sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from nestloom.operators.changes import row_digest
from nestloom.sources.tables import union_all


def row_count(df: DataFrame, name: str, column: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(column)).select(F.lit(name).alias("name"), column)


def reconcile(pairs: Mapping[str, tuple[Sequence[DataFrame], DataFrame]]) -> DataFrame:
    """Source and target counts per name; a target may consolidate several source tables."""
    none = F.lit(0).cast("bigint")
    counts = []
    for name, (sources, target) in pairs.items():
        counts += [row_count(s, name, "source_count").withColumn("target_count", none) for s in sources]
        counts.append(row_count(target, name, "target_count").withColumn("source_count", none))
    summed = union_all(counts).groupBy("name").agg(
        F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count")
    )
    return summed.withColumn("count_match", F.col("source_count") == F.col("target_count"))


def reconcile_entities(target: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Source rows against items per entity type; one scan of the target."""
    expected = union_all([row_count(df, entity, "source_count") for entity, df in sources.items()])
    found = target.groupBy(F.col("EntityType").alias("name")).agg(F.count(F.lit(1)).alias("target_count"))
    both = expected.join(found, "name", "full_outer").na.fill(0, ["source_count", "target_count"])
    return both.withColumn("count_match", F.col("source_count") == F.col("target_count"))


def checksum(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order-free checksum of a table: row count and an exact sum of row hashes.

    The sum is decimal because a ``bigint`` sum of hashes overflows.
    """
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("checksum"),
    )


def compare_checksums(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = checksum(source, columns).select(F.lit("source").alias("side"), "*")
    two = checksum(target, columns).select(F.lit("target").alias("side"), "*")
    return one.unionByName(two)


def digest_buckets(df: DataFrame, columns: Sequence[str], buckets: int = 16) -> DataFrame:
    """Portable checksum per bucket: each row's whole MD5, in four parts of eight hex digits, summed.

    Any engine with MD5 can reproduce it, and a difference is narrowed down to its bucket.
    """
    rows = df.select(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])).alias("d"))
    return rows.groupBy(F.substring("d", 1, 1).alias("bucket")).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(F.conv(F.substring("d", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")).alias(f"digest_{i + 1}") for i in range(4)],
    )


def compare_rows(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ, with ``missing``, ``unexpected`` or ``altered``. Keys must be unique."""
    keys = list(keys)
    values = [c for c in expected.columns if c not in keys]
    want = expected.select(*keys, row_digest(values).alias("_want"))
    have = actual.select(*keys, row_digest(values).alias("_have"))
    issue = (
        F.when(F.col("_have").isNull(), "missing")
        .when(F.col("_want").isNull(), "unexpected")
        .when(F.col("_have") != F.col("_want"), "altered")
    )
    return (
        want.join(have, keys, "full_outer").select(*keys, issue.alias("issue")).where(F.col("issue").isNotNull())
    )


def sample_check(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0
) -> DataFrame:
    """``compare_rows`` on a sample of keys, the same keys on both sides.

    The sample is chosen by 60 bits of the MD5 of seed and keys, so it costs no shuffle, repeats exactly in
    any engine, and may be as small a fraction as wanted; 0 is refused.
    """
    ceiling = int(fraction * (16**15 - 1))
    if ceiling <= 0:
        raise ValueError("an empty sample compares nothing")
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    taken = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") <= ceiling
    return compare_rows(expected.where(taken), actual.where(taken), keys)


def completeness(source: DataFrame, target: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Non-null values per attribute, source column against target attribute; one scan each."""

    def counted(df: DataFrame, columns: Mapping[str, str], name: str) -> DataFrame:
        return df.agg(*[F.count(c).alias(a) for a, c in columns.items()]).unpivot([], list(columns), "attribute", name)

    want = counted(source, {t: s for s, t in mapping.items()}, "source_values")
    have = counted(target, {t: t for t in mapping.values()}, "target_values")
    return want.join(have, "attribute").withColumn("preserved", F.col("source_values") == F.col("target_values"))


def orphans(child: DataFrame, parent: DataFrame, child_column: str, parent_column: str) -> DataFrame:
    """Child rows whose reference is set but has no parent."""
    known = parent.select(F.col(parent_column).alias(child_column))
    return child.where(F.col(child_column).isNotNull()).join(known, child_column, "left_anti").select(*child.columns)


def recheck(
    target: DataFrame, keys: Sequence[str], recomputed: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Stored against recomputed values of derived attributes; one row per key that differs."""
    keys = list(keys)
    stored = target.select(*keys, *[F.col(c).alias(f"stored_{c}") for c in columns])
    again = recomputed.select(*keys, *[F.col(c).alias(f"expected_{c}") for c in columns])
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(f"stored_{c}").eqNullSafe(F.col(f"expected_{c}"))
    return stored.join(again, keys, "full_outer").where(differs)


def observe_extraction(df: DataFrame, name: str, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` that also counts its rows and broken rules while it is being written."""
    seen = Observation(name)
    broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(rule_name) for rule_name, rule in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *broken), seen


