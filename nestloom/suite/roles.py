"""The given star tables in the roles of the music-store model.

nation is the artist, customer the album or the customer, orders the track or the invoice, lineitem
the order line or the bridge, part the product, supplier the playlist member or the employee.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nestloom.functions.items import ISO_FORMAT, money
from nestloom.sources.tables import read_table


class Roles:
    """Role tables over one data folder; every method is lazy."""

    def __init__(self, spark: SparkSession, folder: str, only: Mapping[str, Column] | None = None):
        """``only``: conditions on tables, for loads from an earlier state; ``tables`` may be set to other states."""
        self.spark, self.folder, self.only = spark, folder, dict(only or {})
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        found = self.tables.get(name)
        if found is None:
            found = read_table(self.spark, self.folder, name)
        return found.where(self.only[name]) if name in self.only else found

    # -- catalog: region > nation > customer > orders -----------------------------------------

    def artist(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("ArtistId"), F.col("n_name").alias("Name")
        )

    def album(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("AlbumId"),
            F.col("c_name").alias("Title"),
            F.col("c_nationkey").cast("bigint").alias("ArtistId"),
        )

    def track(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("TrackId"),
            F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("Name"),
            F.col("o_custkey").alias("AlbumId"),
            (F.instr("o_orderstatus", "P") + F.instr("o_orderstatus", "O") * 2).cast("bigint").alias("MediaTypeId"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("GenreId"),
            F.nullif("o_orderstatus", F.lit("P")).alias("Composer"),
            F.col("o_custkey").alias("Milliseconds"),
            F.lit(None).cast("bigint").alias("Bytes"),
            money("o_totalprice").alias("UnitPrice"),
        )

    def genre(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("GenreId"), F.col("r_name").alias("Name")
        )

    def media_type(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("MediaTypeId"), F.col("r_name").alias("Name")
        )

    # -- customers: customer > orders > lineitem > part > supplier > nation -------------------

    def customer(self) -> DataFrame:
        countries = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self.table("customer")
            .join(countries, "c_nationkey", "left")
            .select(
                F.col("c_custkey").alias("CustomerId"),
                F.split_part("c_name", F.lit("#"), F.lit(1)).alias("FirstName"),
                F.split_part("c_name", F.lit("#"), F.lit(2)).alias("LastName"),
                F.nullif("c_mktsegment", F.lit("BUILDING")).alias("Company"),
                F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")).alias("Address"),
                F.col("c_mktsegment").alias("City"),
                F.lit(None).cast("string").alias("State"),
                F.col("n_name").alias("Country"),
                F.col("c_custkey").cast("string").alias("PostalCode"),
                F.lit(None).cast("string").alias("Phone"),
                F.lit("").alias("Fax"),
                F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Email"),
                F.col("c_nationkey").cast("bigint").alias("SupportRepId"),
            )
        )

    def employee(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("EmployeeId"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("LastName"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("FirstName"),
            F.when(key % 10 == 0, "Manager").otherwise("Agent").alias("Title"),
            F.nullif(key - key % 10, key).alias("ReportsTo"),
            *[F.lit(None).cast("string").alias(c) for c in ("BirthDate", "HireDate", "Address", "City", "State")],
            F.col("s_nationkey").cast("string").alias("Country"),
            *[F.lit(None).cast("string").alias(c) for c in ("PostalCode", "Phone")],
            F.lit("").alias("Fax"),
            F.concat(F.lower("s_name"), F.lit("@example.com")).alias("Email"),
        )

    def invoice(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("InvoiceId"),
            F.col("o_custkey").alias("CustomerId"),
            F.date_format("o_orderdate", ISO_FORMAT).alias("InvoiceDate"),
            F.lit(None).cast("string").alias("BillingAddress"),
            F.col("o_orderpriority").alias("BillingCity"),
            F.lit("").alias("BillingState"),
            F.nullif("o_orderstatus", F.lit("P")).alias("BillingCountry"),
            F.lit(None).cast("string").alias("BillingPostalCode"),
            money("o_totalprice").alias("Total"),
        )

    def invoice_line(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_linenumber").cast("bigint").alias("InvoiceLineId"),
            F.col("l_orderkey").alias("InvoiceId"),
            F.col("l_partkey").alias("TrackId"),
            money("l_extendedprice").alias("UnitPrice"),
            F.col("l_quantity").cast("bigint").alias("Quantity"),
        )

    def product(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("TrackId"),
            F.col("p_name").alias("Name"),
            F.col("p_size").cast("bigint").alias("AlbumId"),
            (F.col("p_size").cast("bigint") * 1000).alias("Milliseconds"),
            money("p_retailprice").alias("UnitPrice"),
        )

    def product_album(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("AlbumId"),
            F.col("s_name").alias("Title"),
            F.col("s_nationkey").cast("bigint").alias("ArtistId"),
        )

    def line_parts(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Lines with the track, album and artist tables they lead to."""
        return self.invoice_line(), self.product(), self.product_album(), self.artist()

    # -- containers: part (or supplier) with its suppliers (or parts) -------------------------

    def pairs(self) -> DataFrame:
        """Distinct bridge between parts and suppliers."""
        return self.table("lineitem").select("l_partkey", "l_suppkey").distinct()

    def part_playlist(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("PlaylistId"), F.col("p_name").alias("Name"))

    def part_bridge(self) -> DataFrame:
        return self.pairs().select(F.col("l_partkey").alias("PlaylistId"), F.col("l_suppkey").alias("TrackId"))

    def supplier_member(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("TrackId"),
            F.col("s_name").alias("Name"),
            F.col("s_nationkey").cast("bigint").alias("AlbumId"),
            (F.col("s_suppkey") * 10).alias("Milliseconds"),
            money("s_acctbal").alias("UnitPrice"),
        )

    def nation_album(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("AlbumId"),
            F.col("n_name").alias("Title"),
            F.col("n_regionkey").cast("bigint").alias("ArtistId"),
        )

    def region_artist(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("ArtistId"), F.col("r_name").alias("Name")
        )

    def supplier_bridge(self) -> DataFrame:
        return self.pairs().select(F.col("l_suppkey").alias("PlaylistId"), F.col("l_partkey").alias("TrackId"))

    # -- staff --------------------------------------------------------------------------------

    def served(self) -> DataFrame:
        """Lines as customers in the care of a supplier."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("CustomerId"), F.col("l_suppkey").alias("SupportRepId")
        )
