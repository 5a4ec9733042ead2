from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from nestloom.operators.nest import (
    bounded_embed,
    child_counts,
    child_sums,
    embed_pages,
    entity_counts,
    first_n,
    nest_tree,
    number_rows,
    paginate,
    union_items,
)

# one parent owns a third of all children, some own none, one child has no parent key
SIZES = {1: 400, 2: 3, 3: 0, 4: 200, 5: 5, 6: 6, 7: 300, 0: 1}


@pytest.fixture()
def family(spark):
    parents = spark.createDataFrame([(p, f"p{p}") for p in SIZES], "id bigint, name string")
    children = [(p, c * 7919 % 1009, f"c{c}") for p, n in SIZES.items() for c in range(n)]
    return parents, spark.createDataFrame([*children, (None, 1, "lost")], "id bigint, rank bigint, label string").repartition(5)


def brute(children):
    groups = defaultdict(list)
    for r in children.collect():
        groups[r.id].append((r.rank, r.label))
    return {k: sorted(v) for k, v in groups.items()}


def test_bounded_embed_with_a_giant_group(family):
    parents, children = family
    got = bounded_embed(
        parents, children, "id", ["rank", "label"], ["rank"], 5, "kids", "n", "is_large",
        totals={"total": F.sum("rank")},
    ).collect()
    want = brute(children)
    assert len(got) == len(SIZES)
    for r in got:
        kids = want.get(r.id, [])
        assert r.n == len(kids) and r.is_large == (len(kids) > 5)
        assert r.total == (sum(k[0] for k in kids) if kids else None)
        assert (None if r.kids is None else [tuple(k) for k in r.kids]) == (kids if len(kids) <= 5 else None)


@pytest.mark.parametrize("above", [0, 5])
def test_number_rows_exact_for_any_group_size(family, above):
    _, children = family
    got = number_rows(children, "id", ["rank", "label"], "rn", above=above).collect()
    want = {k: v for k, v in brute(children).items() if len(v) > above}
    seen = defaultdict(dict)
    for r in got:
        seen[r.id][r.rn] = (r.rank, r.label)
    assert {k: [v[i] for i in sorted(v)] for k, v in seen.items()} == want
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in seen.values())


def test_number_rows_when_the_giant_has_no_key(spark):
    df = spark.range(500).select(F.when(F.col("id") > 400, 1).alias("k"), "id")
    got = number_rows(df, "k", ["id"], "rn")
    assert {(r.k, r.a, r.b, r.n) for r in got.groupBy("k").agg(F.min("rn").alias("a"), F.max("rn").alias("b"), F.count("*").alias("n")).collect()} == {
        (None, 1, 401, 401),
        (1, 1, 99, 99),
    }
    assert got.where("k is null").where("rn != id + 1").count() == 0


def test_pages_rejoined_are_the_full_list(family):
    _, children = family
    pages = paginate(children, "id", ["rank"], 100, ["rank", "label"], "kids", above=100).collect()
    want = {k: v for k, v in brute(children).items() if len(v) > 100}
    assert {k: sorted(p.page for p in pages if p.id == k) for k in want} == {1: [1, 2, 3, 4], 4: [1, 2], 7: [1, 2, 3]}
    for k, kids in want.items():
        mine = sorted((p for p in pages if p.id == k), key=lambda p: p.page)
        assert [tuple(x) for p in mine for x in p.kids] == kids
        assert [p.page_rows for p in mine[:-1]] == [100] * (len(mine) - 1)


def test_first_n_below_and_above_the_limit_that_spark_cuts_at(family, spark):
    _, children = family
    want = sorted((k or -1, *x) for k, v in brute(children).items() for x in v[:4])
    for limit in ("1000", "2"):
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
        try:
            got = first_n(children, "id", ["rank", "label"], 4).collect()
        finally:
            spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
        assert sorted((r.id or -1, r.rank, r.label) for r in got) == want


def test_counts_and_sums(rows):
    parents = rows("id bigint", (0,), (1,), (2,))
    children = rows("id bigint, v bigint", (0, 5), (0, None), (1, None), (None, 9))
    assert {r.id: r.n for r in child_counts(parents, children, "id", "n").collect()} == {0: 2, 1: 1, 2: 0}
    assert {r.id: r.n for r in child_counts(parents, children, "id", "n", "v").collect()} == {0: 1, 1: 0, 2: 0}
    assert {r.id: r.s for r in child_sums(parents, children, "id", s="v").collect()} == {0: 5, 1: 0, 2: 0}


def test_tree_keeps_childless_roots_and_leafless_children(rows):
    root = rows("r bigint, name string", (0, "a"), (1, "b"))
    child = rows("c bigint, r bigint", (0, 0), (1, 0))
    leaf = rows("x bigint, c bigint, t string", *[(i, 0, f"t{i}") for i in range(5)])
    pages = nest_tree(root, child, leaf, "r", "c", ["name"], [], ["t"], "x", 3).orderBy("r", "page").collect()
    assert [(p.r, p.page, p.leaf_count, [(k.c, [x.x for x in k.leaves]) for k in p.children]) for p in pages] == [
        (0, 1, 3, [(0, [0, 1, 2])]),
        (0, 2, 2, [(0, [3, 4]), (1, [])]),
        (1, 1, 0, []),
    ]


def test_tree_of_giant_roots(spark):
    """Two roots, one with most of all leaves, numbered over many tasks."""
    root = spark.range(2).withColumnRenamed("id", "r")
    child = spark.range(10).select(F.col("id").alias("c"), F.when(F.col("id") < 8, 0).otherwise(1).cast("bigint").alias("r"))
    leaf = spark.range(1000).select(F.col("id").alias("x"), (F.col("id") % 9).alias("c"))
    pages = nest_tree(root, child, leaf, "r", "c", [], [], [], "x", 30).collect()
    found = sorted((p.r, p.page, k.c, x.x) for p in pages for k in p.children for x in k.leaves)
    assert [(r, c, x) for r, _, c, x in found] == sorted((int(x % 9 >= 8), x % 9, x) for x in range(1000))
    assert all(p.leaf_count <= 30 for p in pages)
    assert {(p.r, k.c) for p in pages for k in p.children if not k.leaves} == {(1, 9)}


def test_union_of_shapes(rows):
    both = union_items(rows("EntityType string, a int", ("A", 1)), rows("EntityType string, b int", ("B", 2), ("B", 3)))
    assert both.columns == ["EntityType", "a", "b"]
    counts = {r.EntityType: r.items for r in entity_counts(both).collect()}
    assert counts == {"A": 1, "B": 2} and sum(counts.values()) == both.count()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), max_size=60), cap=st.integers(0, 6))
def test_embed_matches_plain_python(spark, data, cap):
    parents = spark.range(4).withColumnRenamed("id", "k")
    children = spark.createDataFrame(data, "k bigint, v bigint")
    for r in bounded_embed(parents, children, "k", ["v"], ["v"], cap, "kids", "n", "big").collect():
        mine = sorted(v for k, v in data if k == r.k)
        assert r.n == len(mine) and r.big == (len(mine) > cap)
        assert (None if r.kids is None else [x.v for x in r.kids]) == (mine if len(mine) <= cap else None)


@pytest.mark.parametrize("spread", [1, 40_000, 5_000_000_000])
def test_embed_pages_numbers_like_one_sort(spark, spread):
    """Dense, sparse and very wide ids, negative ones among them, one parent with most rows, repeated ids."""
    import random

    draw = random.Random(spread)
    given = [(draw.choice([1, 1, 1, 1, 2, 3, 9]), draw.randrange(-60, 60) * spread, draw.choice("abc")) for _ in range(400)]
    given += [(None, 5, "x"), (2, None, "y")]
    parents = [(p, f"p{p}") for p in (1, 2, 3, 4)] + [(None, "none")]
    found = embed_pages(
        spark.createDataFrame(parents, "p long, label string"),
        spark.createDataFrame(given, "p long, id long, v string"),
        "p", ["id", "v"], "id", ["id"], 7, "rows",
    ).collect()
    wanted = {}
    for p, label in parents:
        own = sorted((i, v) for q, i, v in given if q == p and q is not None and i is not None)
        wanted[label, 0] = (len(own), own if len(own) <= 7 else None)
        if len(own) > 7:
            for start in range(0, len(own), 7):
                wanted[label, start // 7 + 1] = (len(own), own[start : start + 7])
    got = {(r.label, r._page): (r._total, None if r.rows is None else [tuple(x) for x in r.rows]) for r in found}
    assert got == wanted and len(found) == len(wanted)


def test_embed_pages_moves_plain_rows_and_counts_once(spark):
    """Lists begin where all rows of a page are, and sums of blocks come from the windows that number them."""
    parent = spark.range(3).withColumnRenamed("id", "p")
    child = spark.range(50).select((F.col("id") % 3).alias("p"), (F.col("id") * 20000).alias("id"))
    found = embed_pages(parent, child, "p", ["id"], "id", ["id"], 7, "rows")
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    begun = next(i for i, line in enumerate(plan) if "partial_collect_list" in line)
    moved = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(p#" in line and "_page#" in line]
    assert any(i > begun for i in moved)
    assert not any("sum(_n#" in line and "Aggregate" in line for line in plan)
    assert sorted((r["p"], r["_page"], r["_total"], r["_rows"]) for r in found.collect())[:4] == [(0, 0, 17, None), (0, 1, 17, 7), (0, 2, 17, 7), (0, 3, 17, 3)]


def test_embed_pages_wants_whole_numbers(spark):
    parent, child = spark.createDataFrame([(1,)], "p long"), spark.createDataFrame([(1, "a")], "p long, id string")
    with pytest.raises(ValueError):
        embed_pages(parent, child, "p", ["id"], "id", ["id"], 7, "rows")


def test_numbering_sends_offsets_to_the_slices(spark):
    """Groups over several slices are numbered without another shuffle of the rows, however many groups there are."""
    rows = spark.range(3000).selectExpr("CASE WHEN id < 2000 THEN NULL ELSE id % 50 END AS k", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = number_rows(rows, "k", ["v"], "rn")
        plan = got._jdf.queryExecution().executedPlan().toString()
        found = {(r.k, r.v): r.rn for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    want = {(None, v): v + 1 for v in range(2000)} | {(v % 50, v): (v - 2000) // 50 + 1 for v in range(2000, 3000)}
    assert found == want
