"""Plans that must hold at scale: no cross joins, no hidden row loops, filters and columns pushed down."""

import re

import pytest
from pyspark.sql import functions as F

from nestloom.suite.queries import REGISTRY
from nestloom.suite.roles import Roles
from nestloom.operators import nest
from nestloom.plans import customers
from nestloom.sources.tables import read_table

FOLDER = "/root/testdata/sf0.001"
# these write targets or run feeds; what they return is a plain read
RUNNERS = {
    "extraction_metrics", "feed_upsert", "index_after_upsert", "load_validation", "load_with_updates_and_deletes", "lookup_loaded_index",
    "refresh_equivalence",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - RUNNERS))
def test_no_cross_joins_and_no_python_in_the_plan(spark, name):
    text = plan(REGISTRY[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text, bad


def test_column_pruning_and_pushdown(spark):
    text = plan(REGISTRY["highwater_extract"](spark, FOLDER))
    assert "GreaterThan(o_orderkey,0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text
    counts = plan(REGISTRY["database_overview"](spark, FOLDER))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", counts)) == {""}


def test_embedding_shuffles_counts_and_cut_lines_only(spark):
    r = Roles(spark, FOLDER)
    lines = r.invoice_line().withColumn("Quantity", F.col("Quantity") * 1)
    text = plan(customers.order_items(r.invoice(), lines, *r.line_parts()[1:], cap=5))
    assert "WindowGroupLimit" in text and text.count("lineitem.parquet") == 2  # counted once, cut and listed once


def test_one_order_with_a_third_of_all_lines_keeps_every_line(spark):
    r = Roles(spark, FOLDER)
    lines = r.invoice_line().withColumn("InvoiceId", F.when(F.col("TrackId") % 3 == 0, 1).otherwise(F.col("InvoiceId")).cast("bigint"))
    found = customers.orders_with_pages(r.invoice(), r.customer(), lines, *r.line_parts()[1:], cap=5)
    held = found.groupBy("EntityType").agg(F.sum(F.size("LineItems")).alias("n"), F.sum("PageLineCount").alias("paged")).collect()
    sums = {x.EntityType: x for x in held}
    assert sums["OrderLinesPage"].n == sums["OrderLinesPage"].paged
    listed = found.where("EntityType = 'Order' AND LineItems IS NOT NULL").agg(F.sum(F.size("LineItems"))).first()[0]
    assert listed + sums["OrderLinesPage"].n == lines.join(r.invoice(), "InvoiceId").count()


def test_first_n_is_cut_before_the_shuffle(spark):
    lines = read_table(spark, FOLDER, "lineitem")
    text = plan(nest.first_n(lines, "l_orderkey", ["l_shipdate", "l_partkey"], 3))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_latest_is_top_k_and_lookup_filters_reach_the_source(spark):
    recent = plan(REGISTRY["lookup_recent"](spark, FOLDER))
    assert "TakeOrderedAndProject" in recent


def test_orders_and_pages_come_from_one_numbering(spark):
    r = Roles(spark, FOLDER)
    parts = r.line_parts()
    found = customers.orders_with_pages(r.invoice(), r.customer(), r.invoice_line(), *parts[1:], cap=5)
    assert "rangepartitioning" not in plan(found)
    found.collect()
    done = found._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    # rows once, and their counts once: the other uses of the counts take the shuffle that is there
    assert done.count("lineitem.parquet") == 2 and "ReusedExchange" in done
