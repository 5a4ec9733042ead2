"""Catalog target: artist, album and track items in one key space.

Inputs use the column names of ``sources.tables.MUSIC_STORE_SCHEMAS``; any other three-level model is
loaded by renaming its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nestloom.functions.items import key, money, present, sparse
from nestloom.operators.nest import child_counts, nest_tree, union_items


def artist_items(artist: DataFrame, album: DataFrame, track: DataFrame) -> DataFrame:
    """Roots with their numbers of children and grandchildren.

    Tracks are counted per album and albums folded per artist before anything is joined, so no
    distinct count over a fanned-out join is needed.
    """
    albums = child_counts(album.select("AlbumId", "ArtistId"), track.select("AlbumId"), "AlbumId", "TrackCount")
    per_artist = albums.where(F.col("ArtistId").isNotNull()).groupBy("ArtistId").agg(
        F.count("AlbumId").alias("AlbumCount"), F.sum("TrackCount").alias("TrackCount")
    )
    zero = F.lit(0).cast("bigint")
    return artist.join(per_artist, "ArtistId", "left").select(
        key("ARTIST", "ArtistId").alias("PK"),
        F.lit("METADATA").alias("SK"),
        F.lit("Artist").alias("EntityType"),
        "ArtistId",
        "Name",
        F.coalesce("AlbumCount", zero).alias("AlbumCount"),
        F.coalesce("TrackCount", zero).alias("TrackCount"),
        key("ARTIST_NAME", "Name").alias("GSI1PK"),
        key("ARTIST", "ArtistId").alias("GSI1SK"),
    )


def album_items(album: DataFrame, artist: DataFrame, track: DataFrame) -> DataFrame:
    """Children under their root; an album without artist is left out."""
    counted = child_counts(album, track.select("AlbumId"), "AlbumId", "TrackCount")
    names = artist.select("ArtistId", F.col("Name").alias("ArtistName"))
    return counted.join(names, "ArtistId").select(
        key("ARTIST", "ArtistId").alias("PK"),
        key("ALBUM", "AlbumId").alias("SK"),
        F.lit("Album").alias("EntityType"),
        "AlbumId",
        "Title",
        "ArtistId",
        "ArtistName",
        "TrackCount",
        key("ALBUM_TITLE", "Title").alias("GSI1PK"),
        key("ALBUM", "AlbumId").alias("GSI1SK"),
    )


def track_items(
    track: DataFrame, album: DataFrame, artist: DataFrame, genre: DataFrame, media_type: DataFrame
) -> DataFrame:
    """Leaves with parents and lookups written in; a track without album or artist is left out."""
    parents = album.join(artist.select("ArtistId", F.col("Name").alias("ArtistName")), "ArtistId").select(
        "AlbumId", F.col("Title").alias("AlbumTitle"), "ArtistId", "ArtistName"
    )
    enriched = (
        track.join(parents, "AlbumId")
        .join(genre.select("GenreId", F.col("Name").alias("GenreName")), "GenreId", "left")
        .join(media_type.select("MediaTypeId", F.col("Name").alias("MediaTypeName")), "MediaTypeId", "left")
    )
    genre_known = present("GenreId", enriched.schema["GenreId"].dataType)
    media_known = present("MediaTypeId", enriched.schema["MediaTypeId"].dataType)
    genre_name = F.when(genre_known & present("GenreName"), F.col("GenreName"))
    return enriched.select(
        key("ALBUM", "AlbumId").alias("PK"),
        key("TRACK", "TrackId").alias("SK"),
        F.lit("Track").alias("EntityType"),
        "TrackId",
        "Name",
        "AlbumId",
        "AlbumTitle",
        "ArtistId",
        "ArtistName",
        money("UnitPrice").alias("UnitPrice"),
        sparse(enriched, "Composer"),
        sparse(enriched, "Milliseconds"),
        sparse(enriched, "Bytes"),
        sparse(enriched, "GenreId"),
        genre_name.alias("GenreName"),
        sparse(enriched, "MediaTypeId"),
        F.when(media_known & present("MediaTypeName"), F.col("MediaTypeName")).alias("MediaTypeName"),
        key("TRACK_NAME", "Name").alias("GSI1PK"),
        key("TRACK", "TrackId").alias("GSI1SK"),
        key("GENRE", genre_name).alias("GSI2PK"),
    )


def catalog_target(
    artist: DataFrame, album: DataFrame, track: DataFrame, genre: DataFrame, media_type: DataFrame
) -> DataFrame:
    return union_items(
        artist_items(artist, album, track),
        album_items(album, artist, track),
        track_items(track, album, artist, genre, media_type),
    )


def catalog_tree(artist: DataFrame, album: DataFrame, track: DataFrame, size: int = 100) -> DataFrame:
    """Artists with nested albums and tracks, as pages of up to ``size`` tracks."""
    return nest_tree(
        artist.select("ArtistId", F.col("Name").alias("ArtistName")),
        album.select("AlbumId", "ArtistId", F.col("Title").alias("AlbumTitle")),
        track.select("TrackId", "AlbumId", F.col("Name").alias("TrackName")),
        "ArtistId",
        "AlbumId",
        ["ArtistName"],
        ["AlbumTitle"],
        ["TrackName"],
        "TrackId",
        size,
    )
