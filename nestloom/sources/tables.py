"""Source tables: schemas, loading, and catalog rows (tables, columns, keys, relationships)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# The source model, as documented for the sample music store.
MUSIC_STORE_SCHEMAS = {
    "Artist": "ArtistId bigint, Name string",
    "Album": "AlbumId bigint, Title string, ArtistId bigint",
    "Track": "TrackId bigint, Name string, AlbumId bigint, MediaTypeId bigint, GenreId bigint, "
    "Composer string, Milliseconds bigint, Bytes bigint, UnitPrice decimal(18,2)",
    "Genre": "GenreId bigint, Name string",
    "MediaType": "MediaTypeId bigint, Name string",
    "Playlist": "PlaylistId bigint, Name string",
    "PlaylistTrack": "PlaylistId bigint, TrackId bigint",
    "Customer": "CustomerId bigint, FirstName string, LastName string, Company string, Address string, "
    "City string, State string, Country string, PostalCode string, Phone string, Fax string, "
    "Email string, SupportRepId bigint",
    "Employee": "EmployeeId bigint, LastName string, FirstName string, Title string, ReportsTo bigint, "
    "BirthDate string, HireDate string, Address string, City string, State string, Country string, "
    "PostalCode string, Phone string, Fax string, Email string",
    "Invoice": "InvoiceId bigint, CustomerId bigint, InvoiceDate string, BillingAddress string, "
    "BillingCity string, BillingState string, BillingCountry string, BillingPostalCode string, "
    "Total decimal(18,2)",
    "InvoiceLine": "InvoiceLineId bigint, InvoiceId bigint, TrackId bigint, UnitPrice decimal(18,2), "
    "Quantity bigint",
}

STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@dataclass(frozen=True)
class TableKeys:
    """Declared keys of a table; Spark tables carry no enforced ones."""

    primary: tuple[str, ...] = ()
    # column -> (parent table, parent column)
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    # further indexes: name -> (columns, unique)
    indexes: Mapping[str, tuple[tuple[str, ...], bool]] = field(default_factory=dict)


MUSIC_STORE_KEYS = {
    "Artist": TableKeys(("ArtistId",)),
    "Album": TableKeys(("AlbumId",), {"ArtistId": ("Artist", "ArtistId")}),
    "Track": TableKeys(
        ("TrackId",),
        {
            "AlbumId": ("Album", "AlbumId"),
            "MediaTypeId": ("MediaType", "MediaTypeId"),
            "GenreId": ("Genre", "GenreId"),
        },
    ),
    "Genre": TableKeys(("GenreId",)),
    "MediaType": TableKeys(("MediaTypeId",)),
    "Playlist": TableKeys(("PlaylistId",)),
    "PlaylistTrack": TableKeys(
        ("PlaylistId", "TrackId"),
        {"PlaylistId": ("Playlist", "PlaylistId"), "TrackId": ("Track", "TrackId")},
    ),
    "Customer": TableKeys(("CustomerId",), {"SupportRepId": ("Employee", "EmployeeId")}),
    "Employee": TableKeys(("EmployeeId",), {"ReportsTo": ("Employee", "EmployeeId")}),
    "Invoice": TableKeys(("InvoiceId",), {"CustomerId": ("Customer", "CustomerId")}),
    "InvoiceLine": TableKeys(
        ("InvoiceLineId",),
        {"InvoiceId": ("Invoice", "InvoiceId"), "TrackId": ("Track", "TrackId")},
    ),
}

STAR_KEYS = {
    "region": TableKeys(("r_regionkey",)),
    "nation": TableKeys(("n_nationkey",), {"n_regionkey": ("region", "r_regionkey")}),
    "customer": TableKeys(("c_custkey",), {"c_nationkey": ("nation", "n_nationkey")}),
    "supplier": TableKeys(("s_suppkey",), {"s_nationkey": ("nation", "n_nationkey")}),
    "part": TableKeys(("p_partkey",)),
    "orders": TableKeys(("o_orderkey",), {"o_custkey": ("customer", "c_custkey")}),
    "lineitem": TableKeys(
        (),
        {
            "l_orderkey": ("orders", "o_orderkey"),
            "l_partkey": ("part", "p_partkey"),
            "l_suppkey": ("supplier", "s_suppkey"),
        },
        {"lineitem_order": (("l_orderkey", "l_linenumber"), False)},
    ),
    "events": TableKeys(("event_id",)),
    "documents": TableKeys(("doc_id",)),
    "embeddings": TableKeys(("vec_id",)),
    "pages": TableKeys(("page_id",)),
    "benchmark": TableKeys(("item_id",)),
    "labels": TableKeys(("doc_id",), {"doc_id": ("documents", "doc_id")}),
    "conversations": TableKeys(("conv_id", "turn")),
}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def read_table(spark: SparkSession, folder: str, name: str, schemas: Mapping[str, str] = STAR_SCHEMAS) -> DataFrame:
    """Parquet table with a declared schema, so no job or footer read is spent on inference."""
    return spark.read.schema(schemas[name]).parquet(f"{folder}/{name}.parquet")


def read_tables(spark: SparkSession, folder: str, schemas: Mapping[str, str] = STAR_SCHEMAS) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name, schemas) for name in schemas}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    id_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Database table read in parallel id ranges instead of through one cursor."""
    return spark.read.jdbc(
        url,
        table,
        column=id_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def user_tables(spark: SparkSession, database: str | None = None, hidden_like: str = "sqlite_%") -> DataFrame:
    """Registered tables and views, system ones left out, sorted by name."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(database)]
    listed = spark.createDataFrame(rows, "table string, kind string")
    return listed.where(~F.col("table").like(hidden_like)).orderBy("table")


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame], keys: Mapping[str, TableKeys]) -> DataFrame:
    """One row per column: position, type, nullability, primary-key membership."""
    rows = []
    for table, df in tables.items():
        primary = keys.get(table, TableKeys()).primary
        for position, f in enumerate(df.schema.fields):
            default = f.metadata.get("CURRENT_DEFAULT")
            rows.append((table, position, f.name, f.dataType.simpleString(), not f.nullable, default, f.name in primary))
    return spark.createDataFrame(
        rows, "table string, position int, column string, type string, not_null boolean, default string, primary_key boolean"
    )


def relationship_rows(spark: SparkSession, keys: Mapping[str, TableKeys]) -> DataFrame:
    """Declared foreign keys, sorted as a listing."""
    rows = [
        (table, column, parent, parent_column)
        for table, spec in keys.items()
        for column, (parent, parent_column) in spec.foreign.items()
    ]
    return spark.createDataFrame(
        rows, "table string, column string, references_table string, references_column string"
    ).orderBy("table", "column", "references_table", "references_column")


def index_rows(spark: SparkSession, keys: Mapping[str, TableKeys]) -> DataFrame:
    """Declared indexes, the primary key among them."""
    rows = []
    for table, spec in keys.items():
        if spec.primary:
            rows.append((table, f"{table}_pk", list(spec.primary), True))
        rows += [(table, name, list(columns), unique) for name, (columns, unique) in spec.indexes.items()]
    return spark.createDataFrame(rows, "table string, name string, columns array<string>, unique boolean").orderBy(
        "table", "name"
    )


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values held by more than one row, with their number of rows."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def relationship_report(tables: Mapping[str, DataFrame], keys: Mapping[str, TableKeys]) -> DataFrame:
    """Each declared foreign key with its child rows, distinct references and orphan rows.

    The child is reduced to distinct references before it meets the parent, so a hot reference is
    one row by then.
    """
    parts = []
    for table, spec in keys.items():
        for column, (parent, parent_column) in spec.foreign.items():
            refs = tables[table].groupBy(F.col(column).alias("ref")).agg(F.count(F.lit(1)).alias("n"))
            known = tables[parent].select(F.col(parent_column).alias("ref"), F.lit(True).alias("known")).distinct()
            orphaned: Column = F.col("known").isNull() & F.col("ref").isNotNull()
            parts.append(
                refs.join(known, "ref", "left")
                .agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("child_rows"),
                    F.count("ref").alias("distinct_references"),
                    F.coalesce(F.sum(F.when(orphaned, F.col("n"))), F.lit(0)).alias("orphan_rows"),
                )
                .select(
                    F.lit(table).alias("table"),
                    F.lit(column).alias("column"),
                    F.lit(parent).alias("references_table"),
                    F.lit(parent_column).alias("references_column"),
                    "child_rows",
                    "distinct_references",
                    "orphan_rows",
                )
            )
    return union_all(parts).orderBy("table", "column")


def uniqueness_report(tables: Mapping[str, DataFrame], keys: Mapping[str, TableKeys]) -> DataFrame:
    """Each declared index with its rows, distinct keys and whether it holds as unique."""
    parts = []
    for table, spec in keys.items():
        declared = dict(spec.indexes)
        if spec.primary:
            declared[f"{table}_pk"] = (spec.primary, True)
        for name, (columns, unique) in declared.items():
            parts.append(
                tables[table]
                .groupBy(*columns)
                .agg(F.count(F.lit(1)).alias("n"))
                .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"))
                .select(
                    F.lit(table).alias("table"),
                    F.lit(name).alias("index"),
                    F.lit(",".join(columns)).alias("columns"),
                    F.lit(unique).alias("declared_unique"),
                    "rows",
                    "distinct_keys",
                    (F.col("rows") == F.col("distinct_keys")).alias("is_unique"),
                )
            )
    return union_all(parts).orderBy("table", "index")
