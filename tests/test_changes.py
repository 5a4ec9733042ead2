from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from nestloom.operators.changes import diff, drop_stale, extract_since, high_water, latest_per_key, upsert

KV = "k bigint, v string"


def as_dict(df):
    return {r.k: r.v for r in df.collect()}


def test_snapshots_are_classified(rows):
    old = rows(KV, (1, "a"), (2, "b"), (3, "c"), (5, None), (6, ""))
    new = rows(KV, (1, "a"), (2, "x"), (4, "d"), (5, ""), (6, ""))
    got = {r.k: (r.op, r.v) for r in diff(old, new, ["k"]).collect()}
    assert got == {
        1: ("same", "a"), 2: ("update", "x"), 3: ("delete", None), 4: ("insert", "d"), 5: ("update", ""), 6: ("same", ""),
    }
    assert diff(old, new, ["k"], keep_same=False).count() == 4


def test_classified_changes_turn_old_into_new(rows):
    old, new = rows(KV, (1, "a"), (2, "b"), (3, "c")), rows(KV, (1, "a"), (2, None), (4, "d"))
    assert as_dict(upsert(old, diff(old, new, ["k"], keep_same=False), ["k"], op="op")) == as_dict(new)


def test_mark_zero_is_a_mark(rows):
    df = rows(KV, (0, "a"), (1, "b"))
    assert as_dict(extract_since(df, "k", None)) == {0: "a", 1: "b"}
    assert as_dict(extract_since(df, "k", 0)) == {1: "b"}
    assert high_water(df, "k") == 1 and high_water(df.where("k > 9"), "k", 7) == 7


def test_latest_version_wins_and_replay_changes_nothing(rows):
    target = rows(KV, (1, "a"), (2, "b"))
    changes = rows("k bigint, v string, n int", (2, "old", 1), (2, "new", 2), (3, "in", 1))
    once = upsert(target, changes, ["k"], "n")
    assert as_dict(once) == {1: "a", 2: "new", 3: "in"}
    assert as_dict(upsert(once, changes, ["k"], "n")) == as_dict(once)


def test_whole_row_is_replaced(rows):
    target = rows("k bigint, v string, w string", (1, "a", "kept?"))
    got = upsert(target, rows(KV, (1, "b")), ["k"]).first()
    assert (got.v, got.w) == ("b", None)


def test_older_change_does_not_undo_a_newer_row(rows):
    target = rows("k bigint, v string, n int", (1, "new", 5), (2, "x", 1))
    changes = rows("k bigint, v string, n int", (1, "late", 4), (2, "y", 1), (3, "z", 0))
    assert as_dict(upsert(target, changes, ["k"], "n")) == {1: "new", 2: "y", 3: "z"}
    assert {r.k for r in drop_stale(changes, target, ["k"], "n").collect()} == {2, 3}


def test_deletes(rows):
    target = rows(KV, (1, "a"), (2, "b"), (3, "c"))
    changes = rows("k bigint, v string, n int, op string", (1, None, 2, "delete"), (2, "q", 1, "delete"), (2, "r", 2, "update"), (9, None, 1, "delete"))
    assert as_dict(upsert(target, changes, ["k"], "n", "op")) == {2: "r", 3: "c"}


def test_one_key_with_a_third_of_all_changes(spark):
    changes = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").cast("string").alias("v"), F.col("id").alias("n")
    )
    got = latest_per_key(changes, ["k"], "n")
    assert got.where("k = 0").first().n == 29_997 and got.count() == 20_001


def test_ties_are_settled_by_the_other_columns(rows):
    df = rows("k bigint, v string, n int", (1, "a", 1), (1, "b", 1), (1, None, 1))
    assert [r.v for r in latest_per_key(df, ["k"], "n").collect()] == ["b"]


pairs = st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.sampled_from(["", "a", "b"])), max_size=10)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=pairs, new=pairs)
def test_diff_then_upsert_is_the_new_snapshot(spark, old, new):
    before, after = spark.createDataFrame(list(old.items()), KV), spark.createDataFrame(list(new.items()), KV)
    found = diff(before, after, ["k"], keep_same=False)
    result = upsert(before, found, ["k"], op="op")
    assert as_dict(result) == new and result.count() == len(new)
    assert as_dict(upsert(result, found, ["k"], op="op")) == new
