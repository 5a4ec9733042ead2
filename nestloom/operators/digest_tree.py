"""Comparing large snapshots by a tree of digests: only differing subtrees are looked into.

A leaf covers a range of keys (or of their hashes) and holds the number of its rows and an order-free digest
of them; a node holds those of all leaves under it. Two trees are compared from the top, level by level, under
nodes that differ only; then just the rows of differing leaves are joined. A tree is small next to
its table and can be stored with a snapshot, which then need not be read again where nothing changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from nestloom.operators.changes import row_digest
from nestloom.operators.validate import compare_rows
from nestloom.sources.scratch import materialize

STEP_BITS = 5  # a node has up to 32 children
LEVELS = 4


def hash_leaf(keys: Sequence[str]) -> Column:
    """Leaf of any key, by hash: for trees of ``32 ** LEVELS`` leaves."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << STEP_BITS * LEVELS))


def range_leaf(key: str, bits: int = 8) -> Column:
    """Leaf of a whole-number key: ``2 ** bits`` neighbouring keys share one."""
    return F.shiftright(F.col(key).cast("bigint"), bits)


def digest_tree(df: DataFrame, keys: Sequence[str], leaf: Column | None = None) -> DataFrame:
    """``leaf``, ``n``, ``digest`` for every leaf that has rows; one pass, combined before the shuffle."""
    values = [c for c in df.columns if c not in keys]
    # digest of the row, keys included, as JSON that keeps NULL and field borders apart
    row = F.conv(F.substring(row_digest([*keys, *values]), 1, 15), 16, 10).cast("decimal(38,0)")
    rows = df.select((hash_leaf(keys) if leaf is None else leaf).alias("leaf"), row.alias("_row"))
    return rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum("_row").cast("decimal(38,0)").alias("digest"))


def _differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """Nodes whose number or digest differs, or that one side lacks."""
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("digest").eqNullSafe(F.col("_digest"))
    return one.join(two.withColumnsRenamed({"n": "_n", "digest": "_digest"}), "node", "full_outer").where(~same).select("node")


def differing_leaves(one: DataFrame, two: DataFrame) -> DataFrame:
    """Leaves in which two trees differ. Below a node that is equal nothing is compared."""

    def level(tree: DataFrame, up: int) -> DataFrame:
        node = F.shiftright("leaf", STEP_BITS * up)
        return tree.groupBy(node.alias("node")).agg(F.sum("n").alias("n"), F.sum("digest").cast("decimal(38,0)").alias("digest"))

    found: DataFrame | None = None
    for up in range(LEVELS - 1, -1, -1):
        sides = []
        for tree in (one, two):
            if found is not None:
                parents = found.withColumnRenamed("node", "_parent")
                tree = tree.withColumn("_parent", F.shiftright("leaf", STEP_BITS * (up + 1))).join(parents, "_parent", "left_semi").drop("_parent")
            sides.append(level(tree, up))
        found = materialize(_differing(*sides), "nodes")
    return found.withColumnRenamed("node", "leaf")


def tree_mismatch(
    old: DataFrame, new: DataFrame, keys: Sequence[str], leaf: Column | None = None, old_tree: DataFrame | None = None, new_tree: DataFrame | None = None
) -> DataFrame:
    """Keys whose rows differ, with ``missing`` (only in ``old``), ``unexpected`` or ``altered``.

    Keys must be unique in each snapshot. Trees made before may be given, for the same ``leaf``.
    """
    keys = list(keys)
    place = hash_leaf(keys) if leaf is None else leaf
    trees = [materialize(digest_tree(df.select(old.columns), keys, place), "tree") if tree is None else tree for df, tree in ((old, old_tree), (new, new_tree))]
    wanted = differing_leaves(*trees)
    one, two = (df.select(*old.columns, place.alias("leaf")).join(wanted, "leaf", "left_semi").drop("leaf") for df in (old, new))
    return compare_rows(one, two, keys)
