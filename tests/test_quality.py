from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from nestloom.operators import profile as profiles, quality, validate
from nestloom.sources import tables
from nestloom.sources.scratch import materialize, read_or_empty


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_profile_of_edges(rows):
    df = rows(
        "i bigint, z int, s string, d decimal(20,8), b boolean, a array<int>, n string",
        (1, 0, "ab", Decimal("0.00000001"), True, [1], None),
        (2**60 + 1, 0, "", Decimal("0.00000002"), True, [1], None),
        (None, 0, "ab", None, False, None, None),
        (None, 0, "é" * 70, None, None, [], None),
    )
    got = by(profiles.profile(df, "t"), "column")
    assert (got["i"].distinct_values, got["i"].null_count, got["i"].null_percentage, got["i"].max_value) == (2, 2, 50.0, str(2**60 + 1))
    assert (got["z"].average_value, got["z"].min_value, got["z"].distinct_values) == (0.0, "0", 1)
    assert (got["s"].min_length, got["s"].max_length, got["s"].average_length, got["s"].distinct_values) == (0, 70, 18.5, 3)
    assert (got["d"].distinct_values, got["d"].max_value) == (2, "0.00000002")
    assert (got["b"].distinct_values, got["a"].distinct_values, got["a"].null_count) == (2, 2, 1)
    assert (got["n"].distinct_values, got["n"].null_count, got["n"].min_length, got["n"].average_length) == (0, 4, None, None)
    assert list(by(profiles.profile(df, "t", ["i"]), "column")) == ["i"]


def test_estimated_profile_differs_in_distinct_counts_only(spark):
    df = spark.range(5000).select(
        "id", (F.col("id") % 7).cast("double").alias("d"), F.nullif((F.col("id") % 5).cast("string"), F.lit("3")).alias("s")
    )
    exact, quick = by(profiles.profile(df, "t"), "column"), by(profiles.profile(df, "t", approximate=True), "column")
    for c in df.columns:
        assert abs(exact[c].distinct_values - quick[c].distinct_values) <= 0.1 * exact[c].distinct_values
        a, b = exact[c].asDict(), quick[c].asDict()
        assert {k: v for k, v in a.items() if k != "distinct_values"} == {k: v for k, v in b.items() if k != "distinct_values"}


@pytest.mark.parametrize("approximate", [False, True])
def test_profile_of_an_empty_table(rows, approximate):
    got = by(profiles.profile(rows("i int, s string"), "t", approximate=approximate), "column")
    assert len(got) == 2
    for r in got.values():
        assert (r.row_count, r.distinct_values, r.null_count, r.null_percentage, r.min_value, r.average_value) == (0, 0, 0, 0.0, None, None)


def test_overview_of_nothing_and_something(rows):
    got = by(profiles.overview({"a": rows("x int", (1,), (2,), (3,)), "b": rows("x int", (1,)), "c": rows("x int")}), "table")
    assert [(r.table, r.row_count, r.percentage) for r in got.values()] == [("a", 3, 75.0), ("b", 1, 25.0), ("c", 0, 0.0)]
    assert by(profiles.overview({"c": rows("x int")}), "table")["c"].percentage == 0.0


def test_missing_rates_of_an_empty_table(rows):
    assert [r.null_percentage for r in quality.missing_rates(rows("a int, b int")).collect()] == [0.0, 0.0]


def test_rules_pass_or_name_the_first_failure(rows):
    df = rows("id int, n string, s string", (1, "5", "ok"), (2, "x", "ok"), (3, "x", None), (4, None, "far too long"))
    rules = quality.schema_rules(required=["s"], castable={"n": "int"}, max_length={"s": 5})
    passed, rejected = quality.apply_rules(df, rules)
    assert [r.id for r in passed.collect()] == [1] and passed.columns == df.columns
    assert {r.id: r.failed_rule for r in rejected.collect()} == {2: "n as int", 3: "s required", 4: "s length"}
    unknown = quality.apply_rules(df, {"positive": F.col("n").try_cast("int") > 0})[1]
    assert {r.id for r in unknown.collect()} == {2, 3, 4}


def test_oversize_counts_bytes(rows):
    df = rows("a string", ("é" * 10,), ("e" * 10,))
    assert [r.item_bytes for r in quality.oversize(df, 20).collect()] == [len('{"a":""}') + 20]
    assert [r.a for r in quality.apply_rules(df, quality.size_rule(df, 20))[0].collect()] == ["e" * 10]


def test_missing_and_altered_items_are_named(rows):
    want = rows("k int, v string", (1, "a"), (2, "b"), (3, None))
    have = rows("k int, v string", (1, "a"), (3, ""), (4, "d"))
    found = {r.k: r.issue for r in validate.compare_rows(want, have, ["k"]).collect()}
    assert found == {2: "missing", 3: "altered", 4: "unexpected"}
    assert {r.k: r.issue for r in validate.sample_check(want, have, ["k"], 1.0).collect()} == found
    with pytest.raises(ValueError, match="empty sample"):
        validate.sample_check(want, have, ["k"], 0.0)
    counts = validate.reconcile({"t": ([want], have), "u": ([want, want], have)}).collect()
    assert {r.name: (r.source_count, r.target_count, r.count_match) for r in counts} == {"t": (3, 3, True), "u": (6, 3, False)}


def test_sample_takes_the_same_keys_on_both_sides(spark):
    df = spark.range(2000).withColumn("v", F.col("id") * 2)
    assert validate.sample_check(df, df, ["id"], 0.3).count() == 0
    found = validate.sample_check(df, df.withColumn("v", F.col("v") + 1), ["id"], 0.3, seed=1).count()
    assert 450 < found < 750


def test_checksum_is_free_of_order_and_does_not_overflow(spark):
    df = spark.range(10_000).withColumn("v", F.col("id") % 7)
    one, two = validate.compare_checksums(df, df.orderBy(F.desc("id")).repartition(7), ["id", "v"]).collect()
    assert (one.row_count, one.checksum) == (two.row_count, two.checksum)
    assert validate.checksum(df.where("id > 0"), ["id", "v"]).first().checksum != one.checksum
    assert validate.checksum(df.where("id < 0"), ["id"]).first().checksum == 0


def test_orphans_ignore_missing_references(rows):
    child, parent = rows("c int, p int", (1, 1), (2, 9), (3, None)), rows("id int", (1,))
    assert [r.c for r in validate.orphans(child, parent, "p", "id").collect()] == [2]
    keys = {"child": tables.TableKeys(("c",), {"p": ("parent", "id")}), "parent": tables.TableKeys(("id",))}
    got = tables.relationship_report({"child": child, "parent": parent}, keys).first()
    assert (got.child_rows, got.distinct_references, got.orphan_rows) == (3, 2, 1)


def test_completeness_and_recheck(rows):
    source = rows("a string, b string", ("x", None), ("y", "z"))
    target = rows("A string, B string", ("x", None), (None, "z"))
    got = by(validate.completeness(source, target, {"a": "A", "b": "B"}), "attribute")
    assert (got["A"].preserved, got["B"].preserved) == (False, True)
    wrong = validate.recheck(rows("k int, n int", (1, 1), (2, 2), (3, None)), ["k"], rows("k int, n int", (1, 1), (2, 3), (3, None), (4, 0)), ["n"])
    assert {(r.k, r.stored_n, r.expected_n) for r in wrong.collect()} == {(2, 2, 3), (4, None, 0)}


def test_metrics_are_counted_while_writing(rows, scratch):
    df, seen = validate.observe_extraction(rows("a int", (1,), (-1,), (None,)), "m", {"negative": F.col("a") >= 0})
    df.write.parquet(scratch())
    assert seen.get == {"rows": 3, "negative": 2}


def test_catalog_rows(spark, rows):
    rows("a int", (1,)).createOrReplaceTempView("zz_b")
    rows("a int", (1,)).createOrReplaceTempView("sqlite_x")
    listed = [r.table for r in tables.user_tables(spark).collect()]
    assert "zz_b" in listed and "sqlite_x" not in listed and listed == sorted(listed)
    keys = {"t": tables.TableKeys(("a",), {"b": ("u", "x")}, {"t_b": (("b",), False)}), "u": tables.TableKeys()}
    schema = tables.schema_rows(spark, {"t": rows("a int, b string", (1, "x"))}, keys)
    assert [(r.column, r.type, r.primary_key) for r in schema.orderBy("position").collect()] == [("a", "int", True), ("b", "string", False)]
    assert [tuple(r) for r in tables.relationship_rows(spark, keys).collect()] == [("t", "b", "u", "x")]
    assert [(r.name, r.columns, r.unique) for r in tables.index_rows(spark, keys).collect()] == [("t_b", ["b"], False), ("t_pk", ["a"], True)]
    assert [r.rows for r in tables.duplicate_keys(rows("a int", (1,), (1,), (2,)), ["a"]).collect()] == [2]
    music = tables.relationship_rows(spark, tables.MUSIC_STORE_KEYS)
    assert music.count() == 11


def test_scratch_space(spark, scratch, rows):
    kept = materialize(rows("a int", (1,)))
    assert kept.count() == 1 and "Scan ExistingRDD" not in kept._jdf.queryExecution().toString()
    assert read_or_empty(spark, scratch(), "a int").count() == 0


def test_digest_trees_find_what_differs_and_join_no_more(spark):
    from nestloom.operators.digest_tree import differing_leaves, digest_tree, hash_leaf, range_leaf, tree_mismatch

    old = spark.range(20_000).selectExpr("id", "concat('v', id % 7) AS v", "IF(id % 5 = 0, NULL, id) AS w")
    new = old.where("id <> 77").withColumn("v", F.when(F.col("id") == 500, "x|").otherwise(F.col("v"))).unionByName(spark.sql("SELECT -3L AS id, 'n' AS v, 1L AS w"))
    want = {(77, "missing"), (500, "altered"), (-3, "unexpected")}
    for leaf in (None, range_leaf("id")):
        assert {tuple(r) for r in tree_mismatch(old, new, ["id"], leaf).collect()} == want
        trees = [digest_tree(d, ["id"], leaf) for d in (old, new)]
        leaves = differing_leaves(*trees)
        # rows that would be joined follow the number of changes, not of rows
        assert leaves.count() == 3
        joined = old.withColumn("leaf", hash_leaf(["id"]) if leaf is None else leaf).join(leaves, "leaf", "left_semi").count()
        assert joined <= 3 * 256
    assert tree_mismatch(old, old, ["id"]).count() == 0 and tree_mismatch(old.limit(0), old, ["id"]).count() == 20_000


def test_profiles_of_loads_are_merged_without_the_rows_of_earlier_ones(rows):
    schema = "i int, s string, a array<int>, d double"
    first = rows(schema, (1, "a", [1], 0.5), (2, None, [1], None), (2, "long text " * 20, None, None))
    second = rows(schema, (3, "a", [2], 1.5), (None, "", [1, 2], None))
    parts = [profiles.partial_profile(x) for x in (first, second, rows(schema))]
    merged = profiles.merge_profiles(parts[0].unionByName(parts[1]))
    again = profiles.merge_profiles(merged.unionByName(parts[2]))
    both = first.unionByName(second)
    for found in (profiles.finish_profile(merged, "t"), profiles.finish_profile(again, "t")):
        got, want = by(found, "column"), by(profiles.profile(both, "t"), "column")
        for c, w in want.items():
            same = ("row_count", "null_count", "distinct_values", "null_percentage", "average_value", "min_length", "max_length", "average_length")
            assert [got[c][k] for k in same] == [w[k] for k in same], c
            assert got[c].max_value == (None if w.max_value is None else float(w.max_value))
    empty = by(profiles.finish_profile(profiles.merge_profiles(parts[2]), "t"), "column")["i"]
    assert (empty.row_count, empty.distinct_values, empty.average_value) == (0, 0, None)
