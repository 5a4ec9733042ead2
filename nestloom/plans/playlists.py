"""Playlist target: containers with their members embedded, or paged when there are many."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nestloom.functions.items import key, money, number, text
from nestloom.operators.nest import bounded_embed, child_counts, paginate, union_items
from nestloom.sources.scratch import materialize

MEMBER_CAP = 100
MEMBER_FIELDS = ["TrackId", "Name", "Duration", "UnitPrice", "ArtistName", "AlbumTitle"]


def member_rows(playlist_track: DataFrame, track: DataFrame, album: DataFrame, artist: DataFrame) -> DataFrame:
    """Bridge rows with the attributes a member carries."""
    details = (
        track.select("TrackId", "Name", "AlbumId", "Milliseconds", "UnitPrice")
        .join(album.select("AlbumId", "Title", "ArtistId"), "AlbumId", "left")
        .join(artist.select("ArtistId", F.col("Name").alias("Artist")), "ArtistId", "left")
        .select(
            "TrackId",
            "Name",
            "Milliseconds",
            number("Milliseconds").alias("Duration"),
            number(money("UnitPrice")).alias("UnitPrice"),
            text("Artist").alias("ArtistName"),
            text("Title").alias("AlbumTitle"),
        )
    )
    bridge = playlist_track.where(F.col("TrackId").isNotNull()).select("PlaylistId", "TrackId")
    return bridge.join(details, "TrackId", "left")


def playlist_items(
    playlist: DataFrame,
    playlist_track: DataFrame,
    track: DataFrame,
    album: DataFrame,
    artist: DataFrame,
    cap: int = MEMBER_CAP,
) -> DataFrame:
    """Containers with count, total duration and up to ``cap`` members ordered by name."""
    lists = bounded_embed(
        playlist.withColumnRenamed("Name", "PlaylistName"),
        member_rows(playlist_track, track, album, artist),
        "PlaylistId",
        MEMBER_FIELDS,
        ["Name", "TrackId"],
        cap,
        "Tracks",
        "TrackCount",
        "LargePlaylist",
        member="TrackId",
        totals={"TotalDuration": F.sum("Milliseconds")},
    )
    return lists.select(
        key("PLAYLIST", "PlaylistId").alias("PK"),
        F.lit("METADATA").alias("SK"),
        F.lit("Playlist").alias("EntityType"),
        "PlaylistId",
        F.col("PlaylistName").alias("Name"),
        "TrackCount",
        F.coalesce("TotalDuration", F.lit(0).cast("bigint")).alias("TotalDuration"),
        "Tracks",
        F.when(F.col("LargePlaylist"), True).alias("LargePlaylist"),
    )


def playlist_pages(
    playlist_track: DataFrame,
    track: DataFrame,
    album: DataFrame,
    artist: DataFrame,
    cap: int = MEMBER_CAP,
) -> DataFrame:
    """Pages of ``cap`` members for every container that is too large to embed them."""
    sizes = (
        playlist_track.where(F.col("TrackId").isNotNull())
        .groupBy("PlaylistId")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    members = member_rows(playlist_track, track, album, artist).drop("Milliseconds")
    pages = paginate(
        members, "PlaylistId", ["Name", "TrackId"], cap, MEMBER_FIELDS, "Tracks", above=cap, sizes=sizes
    )
    return pages.select(
        key("PLAYLIST", "PlaylistId").alias("PK"),
        key("TRACKS_PAGE", "page").alias("SK"),
        F.lit("PlaylistTracksPage").alias("EntityType"),
        "PlaylistId",
        F.col("page").alias("Page"),
        F.col("page_rows").alias("PageTrackCount"),
        "Tracks",
    )


def playlists_target(
    playlist: DataFrame,
    playlist_track: DataFrame,
    track: DataFrame,
    album: DataFrame,
    artist: DataFrame,
    cap: int = MEMBER_CAP,
) -> DataFrame:
    """Containers and the pages of the large ones in one target.

    Counts, lists, sizes and pages all read the bridge, which may be worked out from a much larger table: it is
    written once, without rows of other containers.
    """
    known = playlist_track.join(playlist.select("PlaylistId"), "PlaylistId", "left_semi")
    known = materialize(known.where(F.col("TrackId").isNotNull()).select("PlaylistId", "TrackId"), "bridge")
    return union_items(
        playlist_items(playlist, known, track, album, artist, cap),
        playlist_pages(known, track, album, artist, cap),
    )


def playlist_sizes(playlist: DataFrame, playlist_track: DataFrame) -> DataFrame:
    """Every container with its number of bridge rows."""
    return child_counts(playlist, playlist_track, "PlaylistId", "TrackCount", "TrackId")


def playlist_sample(
    playlist_track: DataFrame, track: DataFrame, album: DataFrame, artist: DataFrame, playlist_id: int, n: int
) -> DataFrame:
    """The first ``n`` fully known members of one container."""
    return (
        playlist_track.where(F.col("PlaylistId") == playlist_id)
        .join(track.select("TrackId", F.col("Name").alias("TrackName"), "AlbumId", "Milliseconds", "UnitPrice"), "TrackId")
        .join(album.select("AlbumId", F.col("Title").alias("AlbumTitle"), "ArtistId"), "AlbumId")
        .join(artist.select("ArtistId", F.col("Name").alias("ArtistName")), "ArtistId")
        .select("TrackId", "TrackName", "Milliseconds", "UnitPrice", "ArtistName", "AlbumTitle")
        .orderBy("TrackName", "TrackId")
        .limit(n)
    )
