"""Operator 1: large buckets, large sets, repeated ids, whatever the columns are called."""

import random

import pytest
from helpers import shingle_classes
from pyspark.sql import functions as F

from nestloom.llm import ngram_join


def test_rows_of_a_large_bucket_with_one_stranger_are_linear(spark):
    """50,000 documents of one family and one stranger: the family stays, the stranger visits every block."""
    open_ = spark.range(50_001).select(
        "id", F.lit(1).cast("bigint").alias("bucket"), F.when(F.col("id") < 50_000, 0).otherwise(F.col("id")).cast("bigint").alias("component"),
        F.lit(0).cast("bigint").alias("_main"), F.lit(17).alias("_inner"), F.lit(1).alias("_outer"),
    )
    sent = ngram_join.tasks(open_)
    assert sent.count() == 50_000 + 17 + 1
    assert sent.groupBy("one", "two").count().agg(F.max("count")).first()[0] < 4000


def test_every_pair_that_counts_meets_once(spark):
    open_ = spark.range(40).select(
        "id", F.lit(1).cast("bigint").alias("bucket"), F.when(F.col("id") < 20, 0).otherwise(F.col("id") % 7 + 1).cast("bigint").alias("component"),
        F.lit(0).cast("bigint").alias("_main"), F.lit(3).alias("_inner"), F.lit(4).alias("_outer"),
    )
    rows = ngram_join.tasks(open_).select("id", "component", "block", "one", "two").collect()
    met = {}
    for a in rows:
        for b in rows:
            if a.id < b.id and (a.one, a.two) == (b.one, b.two) and (a.one == a.two or a.block != b.block):
                met[a.id, b.id] = met.get((a.id, b.id), 0) + 1
    assert all(met.get((a, b), 0) == (0 if b < 20 else 1) for a in range(40) for b in range(a + 1, 40))


@pytest.mark.parametrize(("block", "tokens"), [(3000, 6_000_000), (4, 6_000_000), (3000, 150)])
def test_families_and_strangers_equal_brute_force(docs, monkeypatch, block, tokens):
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", tokens)
    rng = random.Random(6)
    base = [f"w{rng.randrange(60)}" for _ in range(60)]
    rows = []
    for i in range(70):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            text[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(text[: rng.choice([60, 58, 40])])))
    rows += [(100, None), (101, ""), (102, " ".join(base) * 40)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_classes(docs(*rows), 3, 70, block=block).collect()}
    assert got == shingle_classes(rows, 3, 70)


def test_texts_under_one_id_belong_together(docs):
    rng = random.Random(1)
    long, short = (" ".join(f"v{rng.randrange(5000)}" for _ in range(n)) for n in (2000, 40))
    near = " ".join([*short.split()[:-1], "other"])
    rows = docs((1, long), (1, short), (2, near), (3, "a b c d e f"), (3, "p q r s t u"), (4, "p q r s t u"), (5, "z"), (None, short), (None, "alone and without id"))
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.jaccard_classes(rows, 4, 85).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (4, 3), (5, 5), (None, 1), (None, None)], key=str)


def test_texts_above_a_mebibyte(docs):
    rng = random.Random(2)
    long = " ".join(f"v{rng.randrange(90000)}" for _ in range(200_000))
    rows = [(1, long), (2, long + " more"), (3, long[: len(long) // 2]), (4, "short text of five words")]
    assert len(long) > 1 << 20
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_classes(docs(*rows)).collect()}
    assert got == shingle_classes(rows, 4, 85)


def test_columns_of_any_name(docs):
    rows = docs((1, "a b c d e f"), (2, "a b c d e f")).withColumnRenamed("doc_id", "my id").withColumnRenamed("text", "the.text").withColumn("n", F.lit("x")).withColumn("id", F.lit(9))
    got = ngram_join.jaccard_classes(rows, 4, 85, id_col="my id", text_col="the.text")
    assert sorted(map(tuple, got.collect())) == [(1, 3, 1), (2, 3, 1)]


def test_near_copies_under_one_id_leave_one_row(spark, docs):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(60))
    kept = corpus_pipeline.near_dedup(spark, docs((7, text), (7, text + " x"), (8, text + " y"), (None, text + " z"), (9, "other")), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [7, 9]
