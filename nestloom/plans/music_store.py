"""The four targets of the sample music store over its eleven source tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from nestloom.plans.catalog import album_items, artist_items, track_items
from nestloom.plans.customers import LINE_CAP, orders_with_pages, profile_items
from nestloom.plans.load import Dependency, Entity, Target
from nestloom.plans.playlists import MEMBER_CAP, playlists_target
from nestloom.plans.staff import employee_items


# Index layout per target, hash key and range key.
CATALOG_INDEXES = {"GSI1": ("GSI1PK", "GSI1SK"), "GSI2": ("GSI2PK", None)}
CUSTOMER_INDEXES = {"GSI1": ("GSI1PK", "GSI1SK")}


def music_store_targets(
    t: Mapping[str, DataFrame], line_cap: int = LINE_CAP, member_cap: int = MEMBER_CAP
) -> list[Target]:
    """Specs by source table name; any subset of rows of an entity's source gives exactly its items."""
    track, album, invoice, line = t["Track"], t["Album"], t["Invoice"], t["InvoiceLine"]
    as_reps = lambda rows, c: rows.select(F.col(c).alias("EmployeeId"))

    def of(table: str, id_column: str, ids) -> Dependency:
        return Dependency(table, t[table], id_column, ids)

    def albums_of(rows: DataFrame) -> DataFrame:
        """Albums of the artists."""
        return album.join(rows.select("ArtistId"), "ArtistId", "left_semi")

    def tracks_of(rows: DataFrame, column: str) -> DataFrame:
        return track.join(rows.select(column), column, "left_semi")

    def with_tracks(rows: DataFrame, lists: DataFrame) -> DataFrame:
        """Rows of a list of tracks that hold the tracks."""
        return lists.join(rows.select("TrackId"), "TrackId", "left_semi")

    def named(lists: DataFrame) -> tuple[Dependency, ...]:
        """Whatever gives names to the tracks of a list."""
        return (
            of("Track", "TrackId", lambda rows: with_tracks(rows, lists)),
            of("Album", "AlbumId", lambda rows: with_tracks(tracks_of(rows, "AlbumId"), lists)),
            of("Artist", "ArtistId", lambda rows: with_tracks(tracks_of(albums_of(rows), "AlbumId"), lists)),
        )

    return [
        Target(
            "MusicCatalog",
            (
                Entity(
                    "Artist",
                    t["Artist"],
                    "ArtistId",
                    lambda rows: artist_items(rows, album, track),
                    (
                        of("Album", "AlbumId", lambda rows: rows),
                        of("Track", "TrackId", lambda rows: album.join(rows.select("AlbumId"), "AlbumId", "left_semi")),
                    ),
                ),
                Entity(
                    "Album",
                    album,
                    "AlbumId",
                    lambda rows: album_items(rows, t["Artist"], track),
                    (of("Artist", "ArtistId", albums_of), of("Track", "TrackId", lambda rows: rows)),
                ),
                Entity(
                    "Track",
                    track,
                    "TrackId",
                    lambda rows: track_items(rows, album, t["Artist"], t["Genre"], t["MediaType"]),
                    (
                        of("Album", "AlbumId", lambda rows: tracks_of(rows, "AlbumId")),
                        of("Artist", "ArtistId", lambda rows: tracks_of(albums_of(rows), "AlbumId")),
                        of("Genre", "GenreId", lambda rows: tracks_of(rows, "GenreId")),
                        of("MediaType", "MediaTypeId", lambda rows: tracks_of(rows, "MediaTypeId")),
                    ),
                ),
            ),
            indexes=CATALOG_INDEXES,
        ),
        Target(
            "CustomerOrders",
            (
                Entity(
                    "CustomerProfile",
                    t["Customer"],
                    "CustomerId",
                    lambda rows: profile_items(rows, t["Employee"], invoice),
                    (
                        of("Invoice", "InvoiceId", lambda rows: rows),
                        of("Employee", "EmployeeId", lambda rows: t["Customer"].join(as_reps_of(rows), "SupportRepId", "left_semi")),
                    ),
                ),
                Entity(
                    "Order",
                    invoice,
                    "InvoiceId",
                    lambda rows: orders_with_pages(rows, t["Customer"], line, track, album, t["Artist"], line_cap),
                    (
                        of("InvoiceLine", "InvoiceLineId", lambda rows: rows),
                        of("Customer", "CustomerId", lambda rows: invoice.join(rows.select("CustomerId"), "CustomerId", "left_semi")),
                        *named(line),
                    ),
                ),
            ),
            indexes=CUSTOMER_INDEXES,
        ),
        Target(
            "Playlists",
            (
                Entity(
                    "Playlist",
                    t["Playlist"],
                    "PlaylistId",
                    lambda rows: playlists_target(rows, t["PlaylistTrack"], track, album, t["Artist"], member_cap),
                    # the bridge has no id of its own: a playlist with another set of tracks is derived anew
                    (Dependency("PlaylistTrack", t["PlaylistTrack"], None, lambda rows: rows, "PlaylistId"), *named(t["PlaylistTrack"])),
                ),
            ),
        ),
        Target(
            "EmployeeManagement",
            (
                # managers may lie outside the batch, so names come from the whole table
                Entity(
                    "Employee",
                    t["Employee"],
                    "EmployeeId",
                    lambda rows: employee_items(rows, t["Customer"], t["Employee"]),
                    (
                        of("Customer", "CustomerId", lambda rows: as_reps(rows, "SupportRepId")),
                        of("Employee", "EmployeeId", lambda rows: t["Employee"].join(rows.select(F.col("EmployeeId").alias("ReportsTo")), "ReportsTo", "left_semi")),
                    ),
                ),
            ),
        ),
    ]


def as_reps_of(employees: DataFrame) -> DataFrame:
    return employees.select(F.col("EmployeeId").alias("SupportRepId"))
