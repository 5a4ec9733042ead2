"""Bounded labelled samples for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``text``, ``y`` of at most about ``per_class`` labelled rows of each class where ``learn`` holds.

    ``learn`` is a condition on the id column. Rows without id or label are left out, and of an id labelled
    twice the larger label counts. The sample of ids is bounded by ``per_class``, so it may be broadcast.
    """
    known = labels.where(learn & F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isin(0, 1))
    known = known.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max(F.col(f"`{label}`")).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    # by a hash of the id: the same rows in every run, however the table is split
    share = F.create_map(*[F.lit(v) for y, n in counts.items() for v in (y, min(1.0, per_class / n))]) if counts else None
    if share is not None:
        known = known.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)) < share[F.col("y")] * 1_000_000)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), "id")
