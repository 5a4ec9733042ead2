"""Registered Spark queries: one per operator or composition, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from nestloom.functions.clean import mask_columns, transform_columns
from nestloom.functions.codec import to_typed_json
from nestloom.functions.items import key, money
from nestloom.operators import access, changes, digest_tree, nest, profile as profiles, quality, validate
from nestloom.plans import catalog, customers, playlists, staff
from nestloom.plans.load import Load, Target
from nestloom.plans.music_store import CATALOG_INDEXES, CUSTOMER_INDEXES, music_store_targets
from nestloom.sources import tables as source_tables
from nestloom.sources.keyed import KeyedTable
from nestloom.sources.scratch import fingerprint, materialize, new_path
from nestloom.streaming.feed import apply_feed, file_feed
from nestloom.suite.roles import Roles

Query = Callable[[SparkSession, str], DataFrame]

ORDER_CAP = 5
MEMBER_CAP = 25
PAGE = 100
PROFILED = ["customer", "documents", "events", "lineitem", "orders", "part", "supplier"]

REGISTRY: dict[str, Query] = {}


def registered(build: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    REGISTRY[build.__name__] = lambda spark, folder: flat(build(Roles(spark, folder)))
    return build


def flat(df: DataFrame) -> DataFrame:
    """Plain comparable columns: nested values as JSON text, amounts as double, whole numbers as bigint."""

    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType)):
            return F.to_json(c).alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.IntegralType):
            return c.cast("bigint").alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


# -- items and targets ---------------------------------------------------------------------------


@registered
def order_documents(r: Roles) -> DataFrame:
    return customers.order_items(r.invoice(), *r.line_parts(), cap=ORDER_CAP)


@registered
def customer_profiles(r: Roles) -> DataFrame:
    return customers.profile_items(r.customer(), r.employee(), r.invoice())


@registered
def customer_orders_target(r: Roles) -> DataFrame:
    return customers.customer_orders_target(
        r.customer(), r.employee(), r.invoice(), *r.line_parts(), cap=ORDER_CAP
    )


@registered
def customer_orders_whole(r: Roles) -> DataFrame:
    """Listed and paged lines of all orders together; they are all the lines there are."""
    return customer_orders_target(r).groupBy("EntityType").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("LineItemCount").alias("lines"),
        F.sum("PageLineCount").alias("paged_lines"),
        F.sum(F.when(F.col("LineItems").isNotNull(), F.size("LineItems"))).alias("held_lines"),
    )


@registered
def root_rollup(r: Roles) -> DataFrame:
    return catalog.artist_items(r.artist(), r.album(), r.track())


@registered
def mid_rollup(r: Roles) -> DataFrame:
    return catalog.album_items(r.album(), r.artist(), r.track())


@registered
def leaf_enriched(r: Roles) -> DataFrame:
    return catalog.track_items(r.track(), r.album(), r.artist(), r.genre(), r.media_type())


@registered
def catalog_target(r: Roles) -> DataFrame:
    return catalog.catalog_target(r.artist(), r.album(), r.track(), r.genre(), r.media_type())


@registered
def container_members(r: Roles) -> DataFrame:
    return playlists.playlist_items(
        r.part_playlist(), r.part_bridge(), r.supplier_member(), r.nation_album(), r.region_artist(), cap=MEMBER_CAP
    )


@registered
def container_pages(r: Roles) -> DataFrame:
    return playlists.playlist_pages(r.supplier_bridge(), r.product(), r.product_album(), r.artist(), cap=PAGE)


@registered
def containers_target(r: Roles) -> DataFrame:
    """Containers with their pages, counted and summed per entity type."""
    target = playlists.playlists_target(
        r.part_playlist(), r.part_bridge(), r.supplier_member(), r.nation_album(), r.region_artist(), cap=MEMBER_CAP
    )
    return target.groupBy("EntityType").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("TrackCount").alias("members"),
        F.sum("PageTrackCount").alias("paged_members"),
        F.coalesce(F.sum(F.size("Tracks")), F.lit(0)).alias("listed_members"),
    )


@registered
def container_counts(r: Roles) -> DataFrame:
    bridge = r.table("lineitem").select(F.col("l_partkey").alias("PlaylistId"), F.col("l_suppkey").alias("TrackId"))
    return playlists.playlist_sizes(r.part_playlist(), bridge)


@registered
def member_sample(r: Roles) -> DataFrame:
    return playlists.playlist_sample(
        r.part_bridge(), r.supplier_member(), r.nation_album(), r.region_artist(), playlist_id=1, n=5
    )


@registered
def staff_items(r: Roles) -> DataFrame:
    return staff.employee_items(r.employee(), r.served())


@registered
def order_totals(r: Roles) -> DataFrame:
    named = r.customer().select("CustomerId", "FirstName", "LastName", "Email", "Country", "City", "Company")
    return customers.order_totals(named, r.invoice())


@registered
def hierarchy_tree(r: Roles) -> DataFrame:
    return nest.nest_tree(
        r.table("region"),
        r.table("nation").withColumnRenamed("n_regionkey", "r_regionkey"),
        r.table("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_name"),
        "r_regionkey",
        "n_nationkey",
        ["r_name"],
        ["n_name"],
        ["c_name"],
        "c_custkey",
        PAGE,
    )


@registered
def catalog_tree(r: Roles) -> DataFrame:
    return catalog.catalog_tree(r.artist(), r.album(), r.track(), PAGE)


@registered
def typed_items(r: Roles) -> DataFrame:
    items = r.table("customer").select(
        key("CUSTOMER", "c_custkey").alias("PK"),
        F.lit("PROFILE").alias("SK"),
        F.col("c_custkey").alias("CustomerId"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("Segment"),
        money("c_acctbal").alias("Balance"),
        F.col("c_acctbal").alias("RawBalance"),
        F.when(F.col("c_acctbal") < 0, True).alias("Overdrawn"),
        F.array(F.struct(F.col("c_name").alias("Name"), F.col("c_nationkey").alias("Nation"))).alias("Names"),
    )
    return to_typed_json(items, "item", "PK")


# -- access --------------------------------------------------------------------------------------


# input per bucket of a stored target; copies compress well, so that bytes alone may tell too little
BUCKET_BYTES, BUCKET_ROWS = 16 << 20, 1 << 20
_TARGET_TABLES = ("customer", "lineitem", "orders", "part", "supplier")

_STORED: dict[tuple, KeyedTable] = {}


def _layout(r: Roles) -> dict[str, int]:
    """Buckets of a stored target, and slots of an index key, in proportion to the tables that targets are derived from:
    a task writes and joins one bucket, so it stays the same size. Rows are counted from the files' footers. A key that
    holds a share of an index has several slots in every bucket; with fewer, some buckets get two and others none."""
    files = fingerprint(r.spark, r.folder)
    size = sum(n for path, n, _ in files if any(f"/{t}.parquet" in path for t in _TARGET_TABLES))
    rows = source_tables.union_all([r.table(t).select(F.lit(1).alias("one")) for t in _TARGET_TABLES]).count()
    buckets = max(8, -(-size // BUCKET_BYTES), -(-rows // BUCKET_ROWS))
    return {"buckets": buckets, "index_spread": 4 * buckets}


def _stored(r: Roles, name: str, build: Callable[[Roles], DataFrame], indexes: dict | None = None) -> KeyedTable:
    """The target as stored for the files that the folder holds now; other files, sizes or times mean a new build."""
    place = (r.spark.sparkContext.applicationId, name, fingerprint(r.spark, r.folder))
    if place not in _STORED:
        items = build(r)
        store = KeyedTable(r.spark, new_path(r.spark, name), items.schema, parts=8, indexes=indexes, **_layout(r))
        store.overwrite(items)
        _STORED[place] = store
    return _STORED[place]


def _customer_store(r: Roles) -> KeyedTable:
    return _stored(r, "CustomerOrders", customer_orders_target, CUSTOMER_INDEXES)


def _catalog_store(r: Roles) -> KeyedTable:
    return _stored(r, "MusicCatalog", catalog_target, CATALOG_INDEXES)


def _customer_orders(r: Roles) -> DataFrame:
    return _customer_store(r).items()


@registered
def lookup_collection(r: Roles) -> DataFrame:
    """A customer with all orders."""
    return _customer_store(r).query("CUSTOMER#1").select("PK", "SK", "EntityType", "Total", "TotalOrders")


@registered
def lookup_prefix(r: Roles) -> DataFrame:
    """The orders of a customer."""
    found = _customer_store(r).query("CUSTOMER#7", sk_prefix="ORDER#")
    return found.select("PK", "SK", "InvoiceId", "Total", "LineItemCount")


@registered
def lookup_recent(r: Roles) -> DataFrame:
    """The newest 20 orders of a customer."""
    found = _customer_store(r).query("CUSTOMER#7", sk_prefix="ORDER#", descending=True, limit=20)
    return found.select("PK", "SK", "InvoiceId", "Total")


@registered
def lookup_point(r: Roles) -> DataFrame:
    found = _customer_store(r).get("CUSTOMER#3", "PROFILE")
    return found.select("PK", "SK", "Email", "TotalOrders", "TotalSpent")


@registered
def lookup_parent(r: Roles) -> DataFrame:
    """An artist with its albums, told apart by sort key."""
    found = _catalog_store(r).query("ARTIST#4")
    return found.select("PK", "SK", "EntityType", "Name", "Title", "AlbumCount", "TrackCount").withColumn(
        "part", F.when(F.col("SK") == "METADATA", "artist").when(F.col("SK").startswith("ALBUM#"), "album")
    )


@registered
def lookup_children(r: Roles) -> DataFrame:
    """An album's tracks."""
    return _catalog_store(r).query("ALBUM#5").select("PK", "SK", "Name", "AlbumTitle", "UnitPrice", "GenreName")


@registered
def lookup_index(r: Roles) -> DataFrame:
    """Items by name through the first index."""
    wanted = ["ALBUM_TITLE#Customer#000000009", "ARTIST_NAME#NATION_3", "TRACK_NAME#Order 12"]
    found = _catalog_store(r).index("GSI1").where(F.col("GSI1PK").isin(wanted))
    return found.select("GSI1PK", "GSI1SK", "PK", "SK", "EntityType")


@registered
def lookup_by_email(r: Roles) -> DataFrame:
    found = _customer_store(r).query_index("GSI1", "EMAIL#customer#000000011@example.com")
    return found.select("GSI1PK", "PK", "SK", "FirstName", "LastName")


@registered
def lookup_genre(r: Roles) -> DataFrame:
    """Tracks of a genre through the second index, 50 at most."""
    index = _catalog_store(r).index("GSI2")
    found = access.query(index, "GENRE#ASIA", limit=50, pk_column="GSI2PK", sk_column="SK")
    return found.select("GSI2PK", "PK", "SK", "Name")


@registered
def index_sizes(r: Roles) -> DataFrame:
    """Items per second-index key; items without the key are not in the index."""
    index = _catalog_store(r).index("GSI2")
    return index.groupBy("GSI2PK").agg(F.count(F.lit(1)).alias("items"), F.sum("UnitPrice").alias("price"))


@registered
def lookup_page(r: Roles) -> DataFrame:
    """One page of a large container."""
    found = _stored(r, "Pages", container_pages).get("PLAYLIST#2", "TRACKS_PAGE#1")
    return found.select("PK", "SK", "Page", "PageTrackCount")


@registered
def lookup_batch(r: Roles) -> DataFrame:
    """All items of every customer of one segment."""
    keys = r.table("customer").where(F.col("c_mktsegment") == "BUILDING").select(key("CUSTOMER", "c_custkey").alias("PK"))
    found = _customer_store(r).lookup(keys)
    return found.select("PK", "SK", "EntityType", "InvoiceId", "TotalOrders")


@registered
def entity_scan(r: Roles) -> DataFrame:
    return access.by_entity(catalog_target(r), "Album").select("PK", "SK", "Title", "ArtistName", "TrackCount")


@registered
def latest_orders(r: Roles) -> DataFrame:
    """The newest three orders of every customer."""
    orders = r.table("orders").select(
        key("CUSTOMER", "o_custkey").alias("PK"),
        key("ORDER", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "o_orderkey").alias("SK"),
        "o_orderkey",
        "o_totalprice",
    )
    return access.latest(orders, 3, "ORDER#")


@registered
def access_counts(r: Roles) -> DataFrame:
    patterns = {
        "customer with orders": ("CUSTOMER#1", None),
        "customer orders": ("CUSTOMER#1", "ORDER#"),
        "orders of a month": ("CUSTOMER#2", "ORDER#1998-"),
        "profile": ("CUSTOMER#9", "PROFILE"),
        "unknown": ("CUSTOMER#-1", None),
    }
    table = r.spark.createDataFrame([(n, *p) for n, p in patterns.items()], "pattern string, pk string, prefix string")
    return access.pattern_counts(_customer_orders(r), table)


@registered
def access_counts_table(r: Roles) -> DataFrame:
    """A pattern for every customer, the orders of one year, all counted in one join."""
    year = r.table("customer").select(
        F.col("c_custkey").cast("string").alias("pattern"), key("CUSTOMER", "c_custkey").alias("pk"), F.lit("ORDER#1997-").alias("prefix")
    )
    return access.pattern_counts(_customer_orders(r), year)


# -- profile -------------------------------------------------------------------------------------


def _profile(name: str) -> Callable[[Roles], DataFrame]:
    def build(r: Roles) -> DataFrame:
        found = profiles.profile(r.table(name), name).drop("type")
        shown = {c: F.round(F.col(c).cast("double"), 2) for c in ("min_value", "max_value", "average_value", "average_length", "null_percentage")}
        return found.withColumns(shown)

    build.__name__ = f"profile_{name}"
    return build


for _name in PROFILED:
    registered(_profile(_name))


@registered
def profile_two_loads(r: Roles) -> DataFrame:
    """Lines of two loads, profiled apart and merged; the estimates are held against exact distinct counts."""
    lines, turn = r.table("lineitem"), F.lit("1995-06-17").cast("timestamp")
    first = materialize(profiles.partial_profile(lines.where(F.col("l_shipdate") < turn)), "profile")
    second = profiles.partial_profile(lines.where(F.coalesce(F.col("l_shipdate") >= turn, F.lit(True))))
    merged = profiles.finish_profile(profiles.merge_profiles(first.unionByName(second)), "lineitem")
    exact = profiles.profile(lines, "lineitem").select("column", F.col("distinct_values").alias("exact"))
    # four standard errors; below some hundred values a sketch is exact
    holds = F.abs(F.col("distinct_values") - F.col("exact")) <= 4 * 1.04 / 2 ** (profiles.SKETCH_BITS / 2) * F.col("exact")
    shown = {c: F.round(c, 2) for c in ("min_value", "max_value", "average_value", "average_length", "null_percentage")}
    found = merged.join(exact, "column").withColumns(shown).withColumn("estimate_holds", holds)
    return found.drop("type", "distinct_values").withColumnRenamed("exact", "distinct_values")


@registered
def database_overview(r: Roles) -> DataFrame:
    found = profiles.overview(source_tables.read_tables(r.spark, r.folder))
    return found.withColumn("percentage", F.round("percentage", 2))


@registered
def schema_catalog(r: Roles) -> DataFrame:
    """Columns of every table, with the table's rows."""
    loaded = source_tables.read_tables(r.spark, r.folder)
    columns = source_tables.schema_rows(r.spark, loaded, source_tables.STAR_KEYS)
    return columns.join(profiles.table_counts(loaded), "table").drop("default")


@registered
def relationship_report(r: Roles) -> DataFrame:
    return source_tables.relationship_report(source_tables.read_tables(r.spark, r.folder), source_tables.STAR_KEYS)


@registered
def uniqueness_report(r: Roles) -> DataFrame:
    return source_tables.uniqueness_report(source_tables.read_tables(r.spark, r.folder), source_tables.STAR_KEYS)


@registered
def duplicate_lines(r: Roles) -> DataFrame:
    return source_tables.duplicate_keys(r.table("lineitem"), ["l_orderkey", "l_linenumber"])


@registered
def missing_rates(r: Roles) -> DataFrame:
    derived = r.table("customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.nullif("c_nationkey", F.lit(3)).alias("nation"),
    )
    return quality.missing_rates(derived).withColumn("null_percentage", F.round("null_percentage", 4))


# -- validation ----------------------------------------------------------------------------------


@registered
def entity_counts(r: Roles) -> DataFrame:
    return nest.entity_counts(catalog_target(r))


@registered
def reconcile_counts(r: Roles) -> DataFrame:
    """Sources against targets; the staff target is built without part of its source."""
    short = r.employee().where(F.col("Title") == "Agent")
    return validate.reconcile(
        {
            "MusicCatalog": ((r.artist(), r.album(), r.track()), catalog_target(r)),
            "CustomerOrders": ((r.customer(), r.invoice()), _customer_orders(r).where("EntityType <> 'OrderLinesPage'")),
            "Playlists": ((r.part_playlist(),), container_members(r)),
            "EmployeeManagement": ((r.employee(),), staff.employee_items(short, r.served())),
        }
    )


@registered
def reconcile_by_entity(r: Roles) -> DataFrame:
    sources = {"Artist": r.artist(), "Album": r.album(), "Track": r.track()}
    return validate.reconcile_entities(catalog_target(r), sources)


@registered
def checksums(r: Roles) -> DataFrame:
    cents = r.table("orders").withColumn("cents", (money("o_totalprice") * 100).cast("bigint"))
    return validate.digest_buckets(cents, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "cents"])


@registered
def checksum_sides(r: Roles) -> DataFrame:
    """Source and target checksums; equal when the target holds the same values."""
    source = r.invoice().select("InvoiceId", "Total")
    target = order_documents(r).select("InvoiceId", "Total")
    return validate.compare_checksums(source, target, ["InvoiceId", "Total"]).groupBy("row_count").agg(
        F.count_distinct("checksum").alias("different_checksums"), F.count(F.lit(1)).alias("sides")
    )


def _altered_orders(r: Roles) -> DataFrame:
    """Order items with some missing and some changed."""
    items = order_documents(r).select("PK", "SK", "InvoiceId", "Total", "LineItemCount")
    return items.where(F.col("InvoiceId") % 97 != 5).withColumn(
        "Total", F.when(F.col("InvoiceId") % 89 == 3, F.col("Total") + 1).otherwise(F.col("Total")).cast("decimal(18,2)")
    )


@registered
def sample_mismatch(r: Roles) -> DataFrame:
    expected = order_documents(r).select("PK", "SK", "InvoiceId", "Total", "LineItemCount")
    return validate.sample_check(expected, _altered_orders(r), ["PK", "SK"], fraction=0.5)


@registered
def reconcile_tree(r: Roles) -> DataFrame:
    """Keys in which two snapshots differ, found by their digest trees; a few orders are changed, lost and new."""
    orders = r.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    price = F.when(F.col("o_orderkey") % 997 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    now = orders.where("o_orderkey % 1009 <> 7").withColumn("o_totalprice", price)
    more = orders.where("o_orderkey % 1013 = 9").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return digest_tree.tree_mismatch(orders, now.unionByName(more), ["o_orderkey"], digest_tree.range_leaf("o_orderkey"))


@registered
def completeness(r: Roles) -> DataFrame:
    mapping = {"Company": "Company", "Address": "Address", "City": "City", "Fax": "Fax", "PostalCode": "PostalCode"}
    return validate.completeness(r.customer(), customer_profiles(r), mapping)


@registered
def computed_recheck(r: Roles) -> DataFrame:
    """Stored totals against the orders; totals of some customers are made wrong first."""
    wrong = F.when(F.col("CustomerId") % 10 == 0, F.col("TotalOrders") + 1).otherwise(F.col("TotalOrders"))
    stored = customer_profiles(r).withColumn("TotalOrders", wrong)
    again = customers.order_totals(r.customer().select("CustomerId"), r.invoice()).select(
        "CustomerId", F.col("OrderCount").alias("TotalOrders"), F.col("TotalSpent").cast("decimal(28,2)").alias("TotalSpent")
    )
    return validate.recheck(stored, ["CustomerId"], again, ["TotalOrders", "TotalSpent"])


@registered
def orphans(r: Roles) -> DataFrame:
    """Lines whose part is not among the larger parts."""
    kept = r.table("part").where(F.col("p_size") > 5)
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return validate.orphans(lines, kept, "l_partkey", "p_partkey")


@registered
def extraction_metrics(r: Roles) -> DataFrame:
    """Rows and broken rules counted while the extraction is written."""
    rules = {"early": F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"), "large": F.col("o_totalprice") < 400000}
    seen, metrics = validate.observe_extraction(r.table("orders"), "orders", rules)
    seen.write.parquet(new_path(r.spark, "extract"))
    found = _metrics(metrics)
    return r.spark.createDataFrame([("orders", *found.values())], "source string, rows bigint, early bigint, large bigint")


def _metrics(seen: Observation) -> dict:
    return {n: seen.get[n] for n in ("rows", "early", "large")}


# -- quality -------------------------------------------------------------------------------------


def _order_rules() -> dict:
    rules = quality.schema_rules(
        required=["o_orderkey", "status"], castable={"o_orderpriority": "bigint"}, max_length={"o_orderpriority": 8}
    )
    return {"positive price": F.col("o_totalprice") > 1000, **rules}


@registered
def quality_rejects(r: Roles) -> DataFrame:
    orders = r.table("orders").select(
        "o_orderkey",
        "o_totalprice",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "5").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return quality.apply_rules(orders, _order_rules())[1].select("o_orderkey", "failed_rule")


@registered
def column_rules(r: Roles) -> DataFrame:
    shaped = r.table("customer").select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.concat(F.lit("+1 ("), F.col("c_custkey").cast("string"), F.lit(") 55-00")).alias("phone"),
        F.encode("c_mktsegment", "ISO-8859-1").alias("segment"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("number"),
        F.col("c_name").alias("bad_number"),
    )
    rules = [
        ("name", "lowercase"),
        ("phone", "format_phone"),
        ("segment", "latin1"),
        ("segment", "lowercase"),
        ("number", "to_long"),
        ("bad_number", "to_long"),
    ]
    return transform_columns(shaped, rules)


@registered
def masked_copy(r: Roles) -> DataFrame:
    rules = [("c_name", "digits"), ("c_acctbal", "remove"), ("c_mktsegment", "md5"), ("c_nationkey", "sha256")]
    return mask_columns(r.table("customer"), rules, salt="pepper:")


@registered
def oversize_items(r: Roles) -> DataFrame:
    items = order_documents(r).select("PK", "SK", "LineItemCount", "LineItems")
    return quality.oversize(items, 600).select("PK", "SK", "LineItemCount", "item_bytes")


# -- changes -------------------------------------------------------------------------------------


@registered
def timestamp_extract(r: Roles) -> DataFrame:
    mark = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    fresh = r.table("orders").where(F.col("o_orderdate") > mark)
    return fresh.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("placed"))


@registered
def highwater_extract(r: Roles) -> DataFrame:
    """Everything after mark 0, which is a mark and not a start."""
    return changes.extract_since(r.table("orders"), "o_orderkey", 0).select("o_orderkey", "o_custkey", "o_totalprice")


def _snapshots(r: Roles) -> tuple[DataFrame, DataFrame]:
    orders = r.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    old = orders.where(F.col("o_orderkey") % 10 != 3)
    new = orders.where(F.col("o_orderkey") % 10 != 7).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 10 == 5, F.lit(1.5)).otherwise(F.col("o_totalprice"))
    )
    return old, new


@registered
def snapshot_diff(r: Roles) -> DataFrame:
    return changes.diff(*_snapshots(r), ["o_orderkey"])


@registered
def snapshot_apply(r: Roles) -> DataFrame:
    """The old snapshot after the classified changes, equal to the new one."""
    old, new = _snapshots(r)
    found = changes.diff(old, new, ["o_orderkey"], keep_same=False)
    return changes.upsert(old, found, ["o_orderkey"], op="op")


def _order_changes(r: Roles) -> DataFrame:
    """Two versions for every open order, the later one without its status."""
    open_orders = r.table("orders").where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey", "o_totalprice")
    one = open_orders.withColumns({"o_totalprice": F.lit(1.0), "o_orderstatus": F.lit("X"), "version": F.lit(1)})
    two = open_orders.withColumns({"o_totalprice": F.lit(2.0), "version": F.lit(2)})
    return nest.union_items(one, two)


def _orders(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@registered
def upsert_latest(r: Roles) -> DataFrame:
    return changes.upsert(_orders(r), _order_changes(r), ["o_orderkey"], "version")


@registered
def upsert_with_deletes(r: Roles) -> DataFrame:
    op = F.when(F.col("o_orderkey") % 2 == 0, "delete").otherwise("update")
    return changes.upsert(_orders(r), _order_changes(r).withColumn("op", op), ["o_orderkey"], "version", "op")


@registered
def upsert_replay(r: Roles) -> DataFrame:
    """The same changes twice, and once more for a single key."""
    once = changes.upsert(_orders(r), _order_changes(r), ["o_orderkey"], "version")
    twice = changes.upsert(once, _order_changes(r), ["o_orderkey"], "version")
    one = r.table("orders").where(F.col("o_orderkey") == 0).select("o_orderkey", F.lit("Z").alias("o_orderstatus"))
    return changes.upsert(twice, one, ["o_orderkey"])


@registered
def latest_lines(r: Roles) -> DataFrame:
    """One line per (order, line number), which repeats: the last shipped."""
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return changes.latest_per_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate").drop("l_shipdate")


def _tables(r: Roles, upto: int | None = None, lines_upto: int | None = None) -> dict[str, dict[str, DataFrame]]:
    """Source tables of each target by name, in the state that ``r`` gives them; with limits, as they were when fewer orders
    and lines existed."""
    orders = F.lit(True) if upto is None else F.col("o_orderkey") <= upto
    lines = F.lit(True) if lines_upto is None else F.col("l_orderkey") <= lines_upto
    limits = {"orders": orders, "lineitem": lines}
    cut = Roles(r.spark, r.folder, r.only | {t: c & r.only.get(t, F.lit(True)) for t, c in limits.items()})
    cut.tables = r.tables
    line_id = F.col("InvoiceId") * 100 + F.col("InvoiceLineId")
    return {
        "MusicCatalog": {
            "Artist": cut.artist(), "Album": cut.album(), "Track": cut.track(), "Genre": cut.genre(), "MediaType": cut.media_type(),
        },
        "CustomerOrders": {
            "Customer": cut.customer(), "Employee": cut.employee(), "Invoice": cut.invoice(),
            "InvoiceLine": cut.invoice_line().withColumn("InvoiceLineId", line_id),
            "Track": cut.product(), "Album": cut.product_album(), "Artist": cut.artist(),
        },
        "Playlists": {
            "Playlist": cut.part_playlist(), "PlaylistTrack": cut.part_bridge(), "Track": cut.supplier_member(),
            "Album": cut.nation_album(), "Artist": cut.region_artist(),
        },
        "EmployeeManagement": {"Employee": cut.employee(), "Customer": cut.served()},
    }


def _targets(r: Roles, names: tuple[str, ...] | None = None, upto: int | None = None, lines_upto: int | None = None) -> list[Target]:
    found, tables = [], _tables(r, upto, lines_upto)
    for name, own in tables.items():
        # tables that a target does not use are filled up with those of the others
        whole = {t: df for other in tables.values() for t, df in other.items()} | own
        found += [t for t in music_store_targets(whole, ORDER_CAP, MEMBER_CAP) if t.name == name]
    return [t for t in found if names is None or t.name in names]


@registered
def refresh_equivalence(r: Roles) -> DataFrame:
    """All items of all four targets after two loads: the first when only part of the orders and, for some of
    those, no lines existed. Equal to a single load, as the second derives what new rows reach."""
    root = new_path(r.spark, "load")
    top = changes.high_water(r.table("orders"), "o_orderkey")
    Load(r.spark, root, _targets(r, None, top * 2 // 3, top // 2), parts=4, **_layout(r)).run()
    rest = Load(r.spark, root, _targets(r), parts=4, **_layout(r))
    rest.refresh()
    stored = [s.items().withColumn("target", F.lit(n)) for n, s in rest.stores.items()]
    return nest.union_items(*stored)


@registered
def load_with_updates_and_deletes(r: Roles) -> DataFrame:
    """The catalog after a load from altered orders and a comparison with the real ones: rows are put in, changed and
    taken out."""
    root = new_path(r.spark, "load")
    real, early = _targets(r, ("MusicCatalog",)), Roles(r.spark, r.folder)
    orders = early.table("orders").where("o_orderkey % 10 <> 3").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 10 == 5, 1.5).otherwise(F.col("o_totalprice"))
    )
    gone = orders.where("o_orderkey % 10 = 7").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    early.tables["orders"] = orders.unionByName(gone)
    Load(r.spark, root, _targets(early, ("MusicCatalog",)), parts=4, **_layout(r)).run()
    load = Load(r.spark, root, real, parts=4, **_layout(r))
    load.sync()
    return load.stores["MusicCatalog"].items()


@registered
def index_after_upsert(r: Roles) -> DataFrame:
    """Old and new keys of an index after an item was changed through the store: never behind its table."""
    load = Load(r.spark, new_path(r.spark, "load"), _targets(r, ("MusicCatalog",)), parts=4, **_layout(r))
    load.run()
    store = load.stores["MusicCatalog"]
    item = store.items().where("EntityType = 'Album' AND AlbumId = 9")
    store.upsert(item.withColumns({"Title": F.lit("Renamed"), "GSI1PK": F.lit("ALBUM_TITLE#Renamed")}))
    found = [store.query_index("GSI1", k) for k in ("ALBUM_TITLE#Customer#000000009", "ALBUM_TITLE#Renamed", "ARTIST_NAME#NATION_3")]
    return nest.union_items(*found).select("GSI1PK", "PK", "SK", "Title", "EntityType")


@registered
def lookup_loaded_index(r: Roles) -> DataFrame:
    """Items by album title and by genre from the stored indexes of a loaded target."""
    load = Load(r.spark, new_path(r.spark, "load"), _targets(r, ("MusicCatalog",)), parts=4, **_layout(r))
    load.run()
    one = load.query_index("MusicCatalog", "GSI1", "ALBUM_TITLE#Customer#000000009")
    many = load.query_index("MusicCatalog", "GSI2", "GENRE#ASIA")
    return one.unionByName(many).select("PK", "SK", "EntityType", "GSI1PK", "GSI2PK", "UnitPrice")


@registered
def load_validation(r: Roles) -> DataFrame:
    load = Load(r.spark, new_path(r.spark, "load"), _targets(r, ("MusicCatalog", "EmployeeManagement")), parts=4, **_layout(r))
    load.run()
    return load.validate()


@registered
def feed_upsert(r: Roles) -> DataFrame:
    """Latest event per user from files arriving in a folder, several batches."""
    folder = new_path(r.spark, "feed")
    r.table("events").repartitionByRange(4, "event_id").write.parquet(f"{folder}/in")
    fields = "user_id bigint, event_id bigint, event_type string, value double"
    store = KeyedTable(r.spark, f"{folder}/latest", fields, keys=["user_id"], parts=4, buckets=8)
    feed = file_feed(r.spark, f"{folder}/in", source_tables.STAR_SCHEMAS["events"], files_per_batch=1)
    apply_feed(store, feed, f"{folder}/checkpoint", "event_id").awaitTermination()
    return store.items()


@registered
def feed_late_after_delete(r: Roles) -> DataFrame:
    """Events as changes, some of them deletes; then the older half arrives once more, late: what was deleted stays so."""
    folder = new_path(r.spark, "feed")
    r.table("events").write.parquet(f"{folder}/in")
    r.table("events").where("event_id % 2 = 0").write.parquet(f"{folder}/late")
    fields = "user_id bigint, event_id bigint, event_type string, value double"
    store = KeyedTable(r.spark, f"{folder}/latest", fields, keys=["user_id"], parts=4, buckets=8)
    marked = lambda rows: rows.withColumn("op", F.when(F.col("value") > 50, "delete").otherwise("update"))
    for part in ("in", "late"):
        feed = file_feed(r.spark, f"{folder}/{part}", source_tables.STAR_SCHEMAS["events"])
        # late ones are plain updates
        apply_feed(store, feed, f"{folder}/{part}-checkpoint", "event_id", *(("op", marked) if part == "in" else ())).awaitTermination()
    return store.items()


@registered
def load_late_rows(r: Roles) -> DataFrame:
    """The catalog after two loads, the first without orders whose ids lie between those it had."""
    root, early = new_path(r.spark, "load"), Roles(r.spark, r.folder, {"orders": F.col("o_orderkey") % 7 != 3})
    Load(r.spark, root, _targets(early, ("MusicCatalog",)), parts=4, **_layout(r)).run()
    load = Load(r.spark, root, _targets(r, ("MusicCatalog",)), parts=4, **_layout(r))
    load.refresh()
    return load.stores["MusicCatalog"].items()


def _item_rules(items: DataFrame) -> dict:
    price, name = F.coalesce(F.col("UnitPrice"), F.lit(0)), F.coalesce("Name", "Title")
    return {"price": (F.col("EntityType") != "Track") | (price >= 50000), "name": F.length(name) <= 11, **quality.size_rule(items)}


@registered
def load_rejects(r: Roles) -> DataFrame:
    """Items that a load refuses, by rule, with what it counted on the way."""
    target = replace(_targets(r, ("MusicCatalog",))[0], rules=_item_rules)
    load = Load(r.spark, new_path(r.spark, "load"), [target], parts=4, **_layout(r))
    load.run()
    counted = load.metrics().where("measure = 'rows'").first()["items"]
    return load.rejects("MusicCatalog").select("PK", "SK", "EntityType", "failed_rule", F.lit(counted).alias("rows"))
