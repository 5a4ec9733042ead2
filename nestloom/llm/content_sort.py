"""Exact deduplication by sorting content (operator 3). DataFrame functions only.

Sampled splitters (Spark's range partitioning) deal the normalised texts out by their first bytes and,
among texts with the same beginning, by their digest. Every partition is sorted externally, which puts
equal texts next to each other, and neighbours are compared in full: the window runs over the whole text.

Hot texts. A sample finds every text that would fill a good part of one partition. Its rows are salted
by id into slices, so that range partitioning spreads them. Each slice keeps one row with its text, and a
second comparison of those rows joins the slices. The slices of all hot texts together number at most a
few per partition (a slice stands for at least ``_SLICE`` sampled rows), so that the table of hot texts is
small however large the input is. The sample decides only where rows are worked on, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from nestloom.llm.common import ascii_lower, materialize, partitions

_SAMPLED = 40  # sampled rows per partition
_HOT = 16  # a text seen so often in the sample gets salted
_SLICE = 8  # sampled rows per slice of a hot text
_HEAD = 48  # characters of a text in the splitters; the digest orders the rest


def content_sort(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and ``carry``.

    Texts are equal when identical after lower-casing A-Z. The row with the smallest (or ``largest``) id of
    a group stays.

    Null text counts as empty. A null id is beaten by any other; a group with null ids only has a null
    ``keep_id``. Rows repeated with the same id: exactly one of them is ``kept``. An empty table gives no
    rows. ``carry`` names input columns to return; other columns are ignored, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark, parts = docs.sparkSession, partitions(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.coalesce(ascii_lower(F.col(f"`{text_col}`")), F.lit("")).alias("_norm"),
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_carry") if carry else F.lit(None).cast("string").alias("_carry"),
    )
    total = docs.count()
    share = min(1.0, _SAMPLED * parts / max(total, 1))
    seen = rows.select("_norm").sample(share, 7).groupBy(F.sha2("_norm", 256).alias("_sha")).count()
    hot = materialize(
        seen.where(F.col("count") >= _HOT).select("_sha", F.ceil(F.col("count") / _SLICE).cast("int").alias("_slices")), "hot"
    )

    best = F.min if keep == "smallest" else F.max
    order = F.col("_id").asc_nulls_last() if keep == "smallest" else F.col("_id").desc_nulls_last()
    salted = rows.withColumn("_sha", F.sha2("_norm", 256)).join(F.broadcast(hot), "_sha", "left")
    salted = salted.withColumn("_head", F.substring("_norm", 1, _HEAD)).withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_slices")), F.lit(0))
    )
    # the window's keys contain the range keys: no further exchange, equal texts are adjacent after its sort
    group = Window.partitionBy("_head", "_sha", "_salt", "_norm").orderBy(order)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = (
        salted.repartitionByRange(parts, "_head", "_sha", "_salt")
        .withColumn("_rank", F.row_number().over(group))
        .withColumn("_best", best("_id").over(whole))
        .withColumn("_n", F.count(F.lit(1)).over(whole))
        .select(
            "_id",
            "_carry",
            "_sha",
            "_best",
            "_n",
            (F.col("_rank") == 1).alias("_first"),
            F.when(F.col("_slices").isNotNull() & (F.col("_rank") == 1), F.col("_norm")).alias("_hot_text"),
        )
    )
    runs = materialize(runs, "runs")

    slices = runs.where("_hot_text IS NOT NULL").groupBy("_sha", "_hot_text")
    joined = slices.agg(best("_best").alias("_all_best"), F.sum("_n").alias("_all_n")).drop("_hot_text")
    keep_id, n = F.coalesce("_all_best", "_best"), F.coalesce("_all_n", "_n")
    carried = [F.col(f"_carry.`{c}`").alias(c) for c in carry if c != id_col]
    return runs.join(F.broadcast(joined), "_sha", "left").select(
        F.col("_id").alias(id_col),
        keep_id.alias("keep_id"),
        n.alias("group_size"),
        (F.col("_first") & F.col("_best").eqNullSafe(keep_id) & (F.col("_id").eqNullSafe(F.col("_best")))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        *carried,
    )
