"""Counting, nesting, bounding and paging children under their parents.

A parent may own any share of all child rows, so nothing here gathers a whole group:

* counts are combined before the shuffle;
* embedding and first-n cut every group inside each task before the shuffle;
* numbering sorts by range, or by blocks of ids, so that a group spreads over as many tasks as it needs.

One plan serves groups of every size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from nestloom.functions.items import as_column
from nestloom.sources.scratch import materialize

def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _count_per(child: DataFrame, keys: list[str], name: str, count_column: str | None = None) -> DataFrame:
    """Children per key; without ``count_column`` all rows with a key count."""
    for k in keys:
        child = child.where(F.col(k).isNotNull())
    counted = F.count(F.lit(1) if count_column is None else F.col(count_column))
    return child.groupBy(*keys).agg(counted.alias(name))


def child_counts(
    parent: DataFrame, child: DataFrame, on: str | Sequence[str], name: str, count_column: str | None = None
) -> DataFrame:
    """``parent`` with its number of children, 0 if none. Counted before the join: no fan-out."""
    keys = _names(on)
    counts = _count_per(child, keys, name, count_column)
    return parent.join(counts, keys, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def child_sums(parent: DataFrame, child: DataFrame, on: str | Sequence[str], **sums: Column | str) -> DataFrame:
    """``parent`` with sums over its children, 0 if none or all NULL."""
    keys = _names(on)
    per_key = child.groupBy(*keys).agg(*[F.sum(as_column(c)).alias(n) for n, c in sums.items()])
    return parent.join(per_key, keys, "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in sums})


def first_n(df: DataFrame, by: str | Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of every group; Spark cuts each group to ``n`` rows per task before the shuffle."""
    window = Window.partitionBy(*_names(by)).orderBy(*[as_column(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def bounded_embed(
    parent: DataFrame,
    child: DataFrame,
    on: str | Sequence[str],
    fields: Sequence[str],
    order: Sequence[str],
    cap: int,
    name: str,
    count_name: str,
    large_name: str,
    member: str | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``parent`` with its children as an ordered array of structs.

    ``count_name`` is always exact. The array is empty for no children and NULL above ``cap``, where
    ``large_name`` is true; ``paginate`` gives the rows of those. ``member`` names the child column
    that must be set for a row to count as a child, ``totals`` are further aggregates over all children,
    and ``enrich`` adds fields to the child rows that remain. Order ends in the child's other fields.

    Counts and totals are combined in each task before their shuffle. Lists start from at most ``cap`` rows
    per group and task, so a parent that owns a third of all rows is like any other.
    """
    keys = _names(on)
    for k in [*keys, *([member] if member else [])]:
        child = child.where(F.col(k).isNotNull())
    extra = {f"_{n}": c for n, c in (totals or {}).items()}
    sums = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in extra.items()])
    ties = [f for f in fields if f not in order and f in child.columns]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    kept = child.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= cap)
    kept = kept if enrich is None else enrich(kept)
    placed = F.struct("_rn", F.struct(*fields).alias("v"))
    lists = kept.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(placed)), lambda e: e["v"]).alias(name))
    empty = F.array().cast(lists.schema[name].dataType)
    total = F.coalesce("_n", F.lit(0).cast("bigint"))
    found = parent.join(sums, keys, "left").join(lists, keys, "left")
    return found.withColumns(
        {
            count_name: total,
            name: F.when(total == 0, empty).when(total <= cap, F.col(name)),
            large_name: total > cap,
            **{n: F.col(f"_{n}") for n in (totals or {})},
        }
    ).drop("_n", *extra)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` where NULL equals NULL, keeping the left key columns once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _number_by_range(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """Numbering with many tasks per group: sort by range, count the slices, add their offsets.

    The slices are written out before they are used twice, because a range split is sampled anew
    whenever it is planned.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialize(
        df.repartitionByRange(parts, *[F.col(c) for c in by], *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*by, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(before))
        .where("_before > 0")
        .drop("_n")
    )
    # in a sorted order only the first group of a slice began in an earlier one: at most one row per slice
    within = Window.partitionBy(*by, "_slice").orderBy(*order)
    return (
        _join_null_safe(sliced, F.broadcast(offsets), [*by, "_slice"], "left")
        .withColumn(name, F.row_number().over(within) + F.coalesce("_before", F.lit(0).cast("bigint")))
        .drop("_slice", "_before")
    )


def number_rows(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[Column | str],
    name: str = "rn",
    sizes: DataFrame | None = None,
    above: int = 0,
) -> DataFrame:
    """Row numbers from 1 within each group of more than ``above`` rows, exact for groups of any size.

    Smaller groups are left out before anything is sorted, by ``sizes`` (keys and ``_n``) if a cheaper source
    of the group sizes exists. Runs a job that writes the sorted slices. ``order`` must end in something
    close to unique.
    """
    keys, ordering = _names(by), [as_column(o) for o in order]
    if above:
        if sizes is None:
            sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        df = _join_null_safe(df, sizes.where(F.col("_n") > above).select(*keys), keys, "left_semi")
    return _number_by_range(df, keys, ordering, name)


def paginate(
    child: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    size: int,
    fields: Sequence[str],
    name: str = "members",
    above: int = 0,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """One row per (group, page): pages are numbered from 1 and hold up to ``size`` ordered structs.

    Only groups with more than ``above`` rows are paged.
    """
    keys = _names(by)
    ties = [f for f in fields if f not in order]
    numbered = number_rows(child, keys, [*order, *ties], "_rn", sizes, above)
    placed = F.struct("_rn", F.struct(*fields).alias("v"))
    return (
        numbered.withColumn("page", F.floor((F.col("_rn") - 1) / size) + 1)
        .groupBy(*keys, "page")
        .agg(
            F.count(F.lit(1)).alias("page_rows"),
            F.transform(F.array_sort(F.collect_list(placed)), lambda e: e["v"]).alias(name),
        )
    )


def embed_pages(
    parent: DataFrame,
    child: DataFrame,
    on: str,
    fields: Sequence[str],
    member: str,
    order: Sequence[str],
    cap: int,
    name: str,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``parent`` once for its list and once for each of its pages, from one numbering of the children.

    Adds ``_total`` (all children), ``_page``, ``_rows`` and the array ``name``. Page 0 is the parent itself: up to
    ``cap`` children it holds the whole list, above that NULL, and pages 1, 2, … hold ``cap`` children each.
    ``member`` is the child's whole-number id and the first of the order, which ends in the child's other
    fields; children without key or id don't count, nor do those whose parent is not there.

    Numbers are prefix sums over the id's upper bits: rows are numbered within ``2^16`` neighbouring ids of a
    parent, the counts of those blocks within ``2^32`` ids, and those once more. So no task sorts more of a
    parent than its rows in one block, however many it owns, and nothing is sampled or written before the query
    runs. Counting reads two columns and is combined before its shuffle; rows move by block and by page only.
    """
    dtype = child.schema[member].dataType
    if not isinstance(dtype, T.IntegralType):
        raise ValueError(f"{member} has to be a whole number, not {dtype.simpleString()}")
    child = child.where(F.col(on).isNotNull() & F.col(member).isNotNull())
    # never NULL, so that no join adds a filter of its own and all uses of the counts stay one shuffle
    zero = F.lit(0).cast("bigint")
    child = child.withColumn("_block", F.coalesce(F.shiftright(F.col(member).cast("bigint"), 16), zero))
    blocks = child.groupBy(on, "_block").agg(F.count(F.lit(1)).alias("_n"))
    upper = F.coalesce(F.shiftright("_block", 16), zero).alias("_upper")

    def before(by: list[str], ordered: str) -> Column:
        earlier = Window.partitionBy(*by).orderBy(ordered).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(earlier), F.lit(0))

    def whole(by: list[str], ordered: str) -> Column:
        return F.sum("_n").over(Window.partitionBy(*by).orderBy(ordered).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    # sums come from the windows that number the blocks, so counts move once per level; where nothing is before, a level begins
    inner = blocks.select(on, "_block", upper, "_n").withColumns({"_inner": before([on, "_upper"], "_block"), "_sum": whole([on, "_upper"], "_block")})
    parts = inner.where("_inner = 0").select(on, "_upper", F.col("_sum").alias("_n"))
    starts = parts.select(on, "_upper", before([on], "_upper").alias("_start"), whole([on], "_upper").alias("_total"))
    totals = starts.where("_start = 0").select(on, "_total")
    offsets = inner.join(starts, [on, "_upper"]).select(on, "_block", (F.col("_start") + F.col("_inner")).alias("_before"), "_total")

    ties = [f for f in fields if f not in order and f in child.columns]
    within = Window.partitionBy(on, "_block").orderBy(*order, *ties)
    numbered = child.withColumn("_rn", F.row_number().over(within)).join(offsets, [on, "_block"])
    numbered = numbered.withColumn("_rn", F.col("_rn") + F.col("_before"))
    place = F.when(F.col("_total") <= cap, F.lit(0)).otherwise(F.floor((F.col("_rn") - 1) / cap) + 1).cast("bigint")
    paged = numbered.withColumn("_page", place).drop("_block", "_before", "_total")
    paged = paged if enrich is None else enrich(paged)
    placed = F.struct("_rn", F.struct(*fields).alias("v"))
    # rows of a page are in many tasks: lists begun there would hold one row each and move with all that lists need
    lists = paged.repartition(on, "_page").groupBy(on, "_page").agg(
        F.count(F.lit(1)).alias("_rows"), F.transform(F.array_sort(F.collect_list(placed)), lambda e: e["v"]).alias(name)
    )

    total = F.coalesce("_total", F.lit(0).cast("bigint"))
    pages = F.when(total > cap, F.ceil(total / cap)).otherwise(F.lit(0)).cast("bigint")
    heads = parent.join(totals, on, "left").withColumn("_total", total)
    heads = heads.withColumn("_page", F.explode(F.sequence(F.lit(0).cast("bigint"), pages)))
    empty = F.array().cast(lists.schema[name].dataType)
    return heads.join(lists, [on, "_page"], "left").withColumn(name, F.when(F.col("_total") == 0, empty).otherwise(F.col(name)))


def nest_tree(
    root: DataFrame,
    child: DataFrame,
    leaf: DataFrame,
    root_on: str,
    child_on: str,
    root_fields: Sequence[str],
    child_fields: Sequence[str],
    leaf_fields: Sequence[str],
    leaf_key: str,
    size: int,
) -> DataFrame:
    """Three-level documents ``root{children[{…, leaves[…]}]}`` from two left joins.

    A root with up to ``size`` leaves is one document; a larger one continues on further pages, so a
    document stays bounded while all pages together hold the whole tree. A child without leaves
    takes one place on a page; a root without children is a page with no children.
    """
    flat = root.join(child, root_on, "left").join(leaf, child_on, "left")
    numbered = number_rows(flat, root_on, [child_on, leaf_key], "_rn")
    paged = numbered.withColumn("page", F.floor((F.col("_rn") - 1) / size) + 1).repartition(root_on, "page")
    root_columns = list(dict.fromkeys([root_on, *root_fields]))
    child_columns = list(dict.fromkeys([child_on, *child_fields]))
    leaf_struct = F.when(F.col(leaf_key).isNotNull(), F.struct(leaf_key, *[f for f in leaf_fields if f != leaf_key]))
    children = paged.groupBy(*root_columns, "page", *child_columns).agg(
        F.array_sort(F.collect_list(leaf_struct)).alias("leaves")
    )
    child_struct = F.when(F.col(child_on).isNotNull(), F.struct(*child_columns, "leaves"))
    return children.groupBy(*root_columns, "page").agg(
        F.sum(F.size("leaves")).alias("leaf_count"),
        F.array_sort(F.collect_list(child_struct)).alias("children"),
    )


def union_items(*entities: DataFrame) -> DataFrame:
    """Items of several shapes in one target; attributes an entity lacks are NULL."""
    whole = entities[0]
    for other in entities[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole


def entity_counts(target: DataFrame) -> DataFrame:
    return target.groupBy("EntityType").agg(F.count(F.lit(1)).alias("items"))
