"""Customer-orders target: one profile and one item per order in each customer's collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nestloom.functions.items import full_name, iso_text, key, money, present, sparse, text
from nestloom.operators.nest import bounded_embed, child_sums, embed_pages, union_items

LINE_CAP = 50

# The optional attributes of a profile and of an order, as documented.
PROFILE_OPTIONAL = ["Company", "Address", "State", "PostalCode", "Phone", "Fax", "SupportRepId"]
BILLING_OPTIONAL = ["BillingAddress", "BillingCity", "BillingState", "BillingCountry", "BillingPostalCode"]


def profile_items(customer: DataFrame, employee: DataFrame, invoice: DataFrame) -> DataFrame:
    """Profiles with order totals, added up exactly and once per order."""
    orders = invoice.groupBy("CustomerId").agg(
        F.count("InvoiceId").alias("TotalOrders"), F.sum(money("Total")).alias("TotalSpent")
    )
    reps = employee.select(
        F.col("EmployeeId").alias("SupportRepId"),
        F.col("FirstName").alias("RepFirstName"),
        F.col("LastName").alias("RepLastName"),
    )
    rows = customer.join(reps, "SupportRepId", "left").join(orders, "CustomerId", "left")
    has_rep = present("SupportRepId", rows.schema["SupportRepId"].dataType)
    return rows.select(
        key("CUSTOMER", "CustomerId").alias("PK"),
        F.lit("PROFILE").alias("SK"),
        F.lit("CustomerProfile").alias("EntityType"),
        "CustomerId",
        "FirstName",
        "LastName",
        "Email",
        "Country",
        "City",
        F.coalesce("TotalOrders", F.lit(0).cast("bigint")).alias("TotalOrders"),
        F.coalesce("TotalSpent", F.lit(0)).cast("decimal(28,2)").alias("TotalSpent"),
        *[sparse(rows, c) for c in PROFILE_OPTIONAL],
        F.when(has_rep, full_name("RepFirstName", "RepLastName")).alias("SupportRepName"),
        key("EMAIL", "Email").alias("GSI1PK"),
        key("CUSTOMER", "CustomerId").alias("GSI1SK"),
    )


LINE_FIELDS = ["InvoiceLineId", "TrackId", "UnitPrice", "Quantity", "TrackName", "ArtistName", "AlbumTitle"]


def plain_lines(line: DataFrame) -> DataFrame:
    return line.select("InvoiceId", "InvoiceLineId", "TrackId", money("UnitPrice").alias("UnitPrice"), "Quantity")


def named_lines(line: DataFrame, track: DataFrame, album: DataFrame, artist: DataFrame) -> DataFrame:
    """Order lines with the names of their track, album and artist where known."""
    names = (
        track.select("TrackId", text("Name").alias("TrackName"), "AlbumId")
        .join(album.select("AlbumId", text("Title").alias("AlbumTitle"), "ArtistId"), "AlbumId", "left")
        .join(artist.select("ArtistId", text("Name").alias("ArtistName")), "ArtistId", "left")
        .select("TrackId", "TrackName", "ArtistName", "AlbumTitle")
    )
    return line.join(names, "TrackId", "left")


def order_items(
    invoice: DataFrame,
    line: DataFrame,
    track: DataFrame,
    album: DataFrame,
    artist: DataFrame,
    cap: int = LINE_CAP,
) -> DataFrame:
    """Orders with their lines in line order; above ``cap`` lines ``orders_with_pages`` adds pages of them."""
    orders = bounded_embed(
        invoice.where(F.col("CustomerId").isNotNull()),
        plain_lines(line),
        "InvoiceId",
        LINE_FIELDS,
        ["InvoiceLineId", "TrackId"],
        cap,
        "LineItems",
        "LineItemCount",
        "LargeOrder",
        member="InvoiceLineId",
        enrich=lambda rows: named_lines(rows, track, album, artist),
    )
    placed = iso_text(invoice, "InvoiceDate")
    return orders.select(
        key("CUSTOMER", "CustomerId").alias("PK"),
        key("ORDER", placed, "InvoiceId").alias("SK"),
        F.lit("Order").alias("EntityType"),
        "InvoiceId",
        placed.alias("InvoiceDate"),
        money("Total").alias("Total"),
        "LineItemCount",
        F.when(F.col("LargeOrder"), True).alias("LargeOrder"),
        *[sparse(invoice, c) for c in BILLING_OPTIONAL],
        "LineItems",
    )


def orders_with_pages(
    invoice: DataFrame, customer: DataFrame, line: DataFrame, track: DataFrame, album: DataFrame, artist: DataFrame, cap: int = LINE_CAP
) -> DataFrame:
    """Orders of known customers, and pages of ``cap`` lines for every order that has too many to embed them.

    The pages' sort keys don't begin like those of orders, so a query for a customer's orders leaves them out.
    """
    owned = invoice.join(customer.select("CustomerId"), "CustomerId", "left_semi")
    found = embed_pages(
        owned,
        plain_lines(line),
        "InvoiceId",
        LINE_FIELDS,
        "InvoiceLineId",
        ["InvoiceLineId", "TrackId"],
        cap,
        "LineItems",
        enrich=lambda rows: named_lines(rows, track, album, artist),
    )
    placed = iso_text(invoice, "InvoiceDate")
    head = F.col("_page") == 0
    page_key = F.concat(key("ORDER_LINES", placed, "InvoiceId"), F.lit("#"), key("PAGE", "_page"))
    return found.select(
        key("CUSTOMER", "CustomerId").alias("PK"),
        F.when(head, key("ORDER", placed, "InvoiceId")).otherwise(page_key).alias("SK"),
        F.when(head, F.lit("Order")).otherwise(F.lit("OrderLinesPage")).alias("EntityType"),
        "InvoiceId",
        F.when(head, placed).alias("InvoiceDate"),
        F.when(head, money("Total")).alias("Total"),
        F.when(head, F.col("_total")).alias("LineItemCount"),
        F.when(head & (F.col("_total") > cap), True).alias("LargeOrder"),
        *[F.when(head, sparse(invoice, c)).alias(c) for c in BILLING_OPTIONAL],
        "LineItems",
        F.when(~head, F.col("_page")).alias("Page"),
        F.when(~head, F.col("_rows")).alias("PageLineCount"),
    )


def customer_orders_target(
    customer: DataFrame,
    employee: DataFrame,
    invoice: DataFrame,
    line: DataFrame,
    track: DataFrame,
    album: DataFrame,
    artist: DataFrame,
    cap: int = LINE_CAP,
) -> DataFrame:
    """Profiles, orders and pages of large orders; an order of an unknown customer is left out."""
    return union_items(
        profile_items(customer, employee, invoice), orders_with_pages(invoice, customer, line, track, album, artist, cap)
    )


def order_totals(customer: DataFrame, invoice: DataFrame) -> DataFrame:
    """Every customer with the number and sum of their orders, 0 for none."""
    counted = invoice.select("CustomerId", money("Total").alias("Total"), F.lit(1).alias("one"))
    return child_sums(customer, counted, "CustomerId", OrderCount="one", TotalSpent="Total")


