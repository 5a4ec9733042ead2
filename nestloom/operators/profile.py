"""Table and database profiles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from nestloom.functions.items import percentage
from nestloom.sources.tables import union_all

def _comparable(c: Column, dtype: T.DataType) -> Column:
    """What tells two values apart: the value itself, or a digest of bounded size for texts and nested values."""
    if isinstance(dtype, T.StringType):
        return F.unhex(F.sha2(c, 256))
    if isinstance(dtype, T.AtomicType):
        return c
    return F.when(c.isNotNull(), F.sha2(F.to_json(F.struct(c.alias("v"))), 256))


def _column_profile(df: DataFrame, f: T.StructField) -> DataFrame:
    """Statistics of one column, folded from how often each value occurs."""
    is_number, is_text = isinstance(f.dataType, T.NumericType), isinstance(f.dataType, T.StringType)
    c = F.col(f"`{f.name}`")
    size = F.length(c) if is_text else F.lit(None).cast("int")
    values = (
        df.select(_comparable(c, f.dataType).alias("v"), size.alias("size"))
        .groupBy("v", "size")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.col("v").isNotNull()
    total = F.sum(F.when(known, F.col("n")))

    def bound(of: Callable[[str], Column]) -> Column:
        return (of("v") if is_number else F.lit(None)).cast("string")

    def average(c: Column, wanted: bool) -> Column:
        return F.sum(c.cast("double") * F.col("n")) / total if wanted else F.lit(None).cast("double")

    zero = F.lit(0).cast("bigint")
    return values.agg(
        F.coalesce(F.sum("n"), zero).alias("row_count"),
        F.count("v").alias("distinct_values"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), zero).alias("null_count"),
        bound(F.min).alias("min_value"),
        bound(F.max).alias("max_value"),
        average(F.col("v"), is_number).alias("average_value"),
        F.min("size").cast("bigint").alias("min_length"),
        F.max("size").cast("bigint").alias("max_length"),
        average(F.col("size"), is_text).alias("average_length"),
    ).select(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), "*")


def _quick_profile(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """All columns in one aggregate with estimated distinct counts: no value leaves its task."""
    rows = F.count(F.lit(1))
    entries = []
    for f in fields:
        is_number, is_text = isinstance(f.dataType, T.NumericType), isinstance(f.dataType, T.StringType)
        c = F.col(f"`{f.name}`")
        size = F.length(c) if is_text else F.lit(None).cast("int")
        number = c if is_number else F.lit(None).cast("double")
        entries.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                rows.alias("row_count"),
                F.approx_count_distinct(_comparable(c, f.dataType)).alias("distinct_values"),
                F.count_if(c.isNull()).alias("null_count"),
                F.min(number).cast("string").alias("min_value"),
                F.max(number).cast("string").alias("max_value"),
                F.avg(number.cast("double")).alias("average_value"),
                F.min(size).cast("bigint").alias("min_length"),
                F.max(size).cast("bigint").alias("max_length"),
                F.avg(size).alias("average_length"),
            )
        )
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def profile(
    df: DataFrame, table: str, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """One row per column: counts, distinct and missing values, numeric or text-length statistics.

    Each column is a branch that reads only its own data, so the table is read once in all, and its
    values are combined before the shuffle; several exact distinct counts in one aggregate would
    instead send every row once per column. ``approximate`` estimates the distinct counts and takes
    one pass without shuffling values. Numeric bounds are text, so all types stay exact; averages are
    unrounded.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    found = _quick_profile(df, fields) if approximate else union_all([_column_profile(df, f) for f in fields])
    return found.withColumns(
        {"table": F.lit(table), "null_percentage": percentage(F.col("null_count"), F.col("row_count"))}
    ).select(
        "table",
        "column",
        "type",
        "row_count",
        "distinct_values",
        "null_count",
        "null_percentage",
        "min_value",
        "max_value",
        "average_value",
        "min_length",
        "max_length",
        "average_length",
    )


SKETCH_BITS = 14  # an estimate's standard error is about 0.8 %, a sketch at most 16 KB


def partial_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column of what can be merged later: counts, sums, bounds and a sketch of the distinct values.

    One aggregate over one scan; no value leaves its task. Write it next to the rows it describes, such as those
    of one load. Numeric bounds and sums are doubles. An empty table gives counts of 0 and empty sketches.
    """
    entries = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        is_number, is_text = isinstance(f.dataType, T.NumericType), isinstance(f.dataType, T.StringType)
        c = F.col(f"`{f.name}`")
        number = c.cast("double") if is_number else F.lit(None).cast("double")
        size = F.length(c).cast("bigint") if is_text else F.lit(None).cast("bigint")
        # a sketch passes over empty text, so text gets a sign in front
        value = F.concat(F.lit("="), c) if is_text else c.cast("string") if isinstance(f.dataType, T.AtomicType) else F.to_json(F.struct(c.alias("v")))
        entries.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(c.isNull()).alias("null_count"),
                F.min(number).alias("min_value"),
                F.max(number).alias("max_value"),
                F.sum(number).alias("value_sum"),
                F.min(size).alias("min_length"),
                F.max(size).alias("max_length"),
                F.sum(size).alias("length_sum"),
                F.hll_sketch_agg(F.when(c.isNotNull(), value), F.lit(SKETCH_BITS)).alias("sketch"),
            )
        )
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Rows of ``partial_profile`` of any number of loads as one row per column; can be merged again.

    What was described before is not read again: the work follows the number of loads and columns.
    """
    sums = [F.sum(c).alias(c) for c in ("row_count", "null_count", "value_sum", "length_sum")]
    bounds = [F.min(c).alias(c) for c in ("min_value", "min_length")] + [F.max(c).alias(c) for c in ("max_value", "max_length")]
    merged = parts.groupBy("column", "type").agg(*sums, *bounds, F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))
    return merged.select(parts.columns)


def finish_profile(merged: DataFrame, table: str) -> DataFrame:
    """A merged profile in the columns of ``profile``, with estimated distinct counts and bounds as doubles."""
    known = F.nullif(F.col("row_count") - F.col("null_count"), F.lit(0))
    return merged.select(
        F.lit(table).alias("table"),
        "column",
        "type",
        "row_count",
        F.hll_sketch_estimate("sketch").alias("distinct_values"),
        "null_count",
        percentage(F.col("null_count"), F.col("row_count")).alias("null_percentage"),
        "min_value",
        "max_value",
        (F.col("value_sum") / known).alias("average_value"),
        "min_length",
        "max_length",
        (F.col("length_sum") / known).alias("average_length"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table; answered from Parquet row counts, no column is read."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table"), "row_count") for t, df in tables.items()]
    )


def overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tables by size with their share of all rows, next to the totals."""
    counts = table_counts(tables)
    totals = counts.agg(F.sum("row_count"))
    return counts.withColumns(
        {"total_tables": F.lit(len(tables)).cast("bigint"), "total_rows": totals.scalar()}
    ).select(
        "table",
        "row_count",
        percentage(F.col("row_count"), F.col("total_rows")).alias("percentage"),
        "total_tables",
        "total_rows",
    ).orderBy(F.desc("row_count"), "table")
