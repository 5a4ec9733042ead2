"""Helpers shared by the operators: columns, folds, written intermediates."""

from __future__ import annotations

import gc
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nestloom.sources.scratch import materialize

__all__ = ["ascii_lower", "documents", "fold", "materialize", "partitions", "released", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session; sized with the data, as Spark's own shuffles are."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` also folds letters beyond A-Z, so it serves only texts without any; it is the faster way.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def released(visit: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function that gives memory back when its task ends, since workers live on between tasks."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from visit(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()

    return run


def fold(id_column: Column, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``: a fold that never changes."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(modulus))
