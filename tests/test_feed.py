from pyspark.sql import functions as F

from nestloom.sources.keyed import KeyedTable
from nestloom.streaming.feed import apply_feed, file_feed

CHANGE = "user bigint, n bigint, v string"


def test_feed_takes_each_file_once_and_late_changes_lose(spark, scratch, rows):
    folder = scratch()
    arrived = lambda *values: rows(CHANGE, *values).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    store = KeyedTable(spark, f"{folder}/store", CHANGE, keys=["user"], parts=2, buckets=2)

    def run(checkpoint="checkpoint"):
        feed = file_feed(spark, f"{folder}/in", CHANGE, files_per_batch=1)
        apply_feed(store, feed, f"{folder}/{checkpoint}", "n").awaitTermination()
        return {r.user: r.v for r in store.items().collect()}

    arrived((1, 1, "a"), (1, 3, "c"), (2, 1, "x"))
    assert run() == {1: "c", 2: "x"}
    assert run() == {1: "c", 2: "x"}
    arrived((1, 2, "late"), (3, 1, "new"))
    assert run() == {1: "c", 2: "x", 3: "new"}
    # a new checkpoint starts over: its batches are taken again, nothing is lost or undone
    arrived((4, 1, "more"))
    assert run("second") == {1: "c", 2: "x", 3: "new", 4: "more"}


def test_feed_can_shape_and_delete(spark, scratch, rows):
    folder = scratch()
    rows(CHANGE, (1, 1, "a"), (2, 1, "b"), (1, 2, "gone")).coalesce(1).write.parquet(f"{folder}/in")
    store = KeyedTable(spark, f"{folder}/store", CHANGE, keys=["user"], parts=2, buckets=2)
    shape = lambda d: d.withColumn("op", F.when(F.col("v") == "gone", "delete").otherwise("update"))
    feed = file_feed(spark, f"{folder}/in", CHANGE, pattern="*.parquet")
    apply_feed(store, feed, f"{folder}/checkpoint", "n", op="op", to_changes=shape).awaitTermination()
    assert {r.user: r.v for r in store.items().collect()} == {2: "b"}
    rows(CHANGE, (1, 0, "late")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    apply_feed(store, file_feed(spark, f"{folder}/in", CHANGE), f"{folder}/checkpoint", "n", op="op", to_changes=shape).awaitTermination()
    assert {r.user: r.v for r in store.items().collect()} == {2: "b"}  # the delete is newer
