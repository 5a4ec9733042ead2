"""Corpus pipeline over the documents table: ``STAGES`` in order, each over what its predecessor kept.

All stages keep the columns of documents, whatever further columns there are and whatever they are called;
the last one returns the packed pieces. Null texts count as empty everywhere; rows without id are treated
as documents of their own. Empty tables pass through as empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from nestloom.llm import content_sort, mixing, ngram_join, packing, toxicity
from nestloom.llm.common import documents, fold, materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

WIDTH, PERCENT = 5, 80  # near duplicates: five-word shingles, similarity of 0.8 or more


def _whole(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel model scores below 0.5; it learns from the labelled ones outside fold 0 of 5."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return toxicity.reject(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts, the one with the smallest id; repeated rows count as copies."""
    rows = docs.select("doc_id", "text", _whole(docs))
    return content_sort.content_sort(rows, carry=["row"]).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group that near copies connect, those without id last.

    Rows are told apart by all they hold, so near copies under one id are found too, and one of them stays.
    """
    keyed = docs.select(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("key"), "doc_id", "text", _whole(docs))
    classes = ngram_join.jaccard_classes(keyed.select("key", "text"), WIDTH, PERCENT, id_col="key").select("key", "component_id").distinct()
    places = classes.join(keyed.select("key", "doc_id"), "key")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("m")
    kept = places.groupBy("component_id").agg(first).select(F.col("m.key").alias("key"))
    return keyed.join(kept, "key", "left_semi").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens match raked targets for sources, languages and topics."""
    rows = docs.select("doc_id", "text", "lang", "source", _whole(docs))
    return mixing.mix(rows).where("mix_kept").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs.select("doc_id", "text")))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Toxicity scores come from a trained model, which SQL can't express. Tests compare exact and near copies with brute
#: force; of the toxicity and mixing stages they check what stays and which columns, of packing that all is placed.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the result of each is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
