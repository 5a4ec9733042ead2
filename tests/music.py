"""A small music store with the edges the star tables lack: NULLs, orphans, empty groups, zeros."""

from decimal import Decimal as D

from nestloom.sources.tables import MUSIC_STORE_SCHEMAS

ROWS = {
    "Artist": [(0, "Zero"), (1, "AC/DC"), (2, "Silent"), (3, None)],
    "Album": [(1, "Rock", 1), (2, "Empty", 1), (10, "Ten", 1), (0, "Nil", 0), (7, "Lost", 99)],
    "Track": [
        (1, "One", 1, 1, 1, None, 343719, 11, D("0.99")),
        (2, "Two", 1, 1, None, "", 0, None, D("0.99")),
        (3, "Three", 10, None, 9, "x", 5, 0, D("1.99")),
        (0, "Nought", 0, 2, 2, "y", 7, 3, D("0.00")),
        (5, "Orphan", 77, 1, 1, None, 1, 1, D("0.99")),
        (6, "Stray", 7, 1, 1, None, 1, 1, D("0.99")),
    ],
    "Genre": [(1, "Rock"), (2, ""), (3, "Jazz")],
    "MediaType": [(1, "MPEG"), (2, "AAC")],
    "Playlist": [(1, "Music"), (2, "Nothing"), (3, "Big")],
    "PlaylistTrack": [(1, 1), (1, 2), (1, 0), *[(3, t) for t in (0, 1, 2, 3, 5, 6)]],
    "Customer": [
        (1, "Ann", "Lee", "Co", None, "Oslo", "", "Norway", "0171", None, "", "ann@x.no", 3),
        (2, "Bob", "Ray", None, "Str 1", "Rome", None, "Italy", None, "+39", None, "bob@x.it", 4),
        (0, "Nil", "Zed", None, None, "Bern", None, "Swiss", None, None, None, None, None),
    ],
    "Employee": [
        (1, "Adams", "Andrew", "Boss", None, "1962-02-18", None, None, None, None, None, None, None, "", "a@x.com"),
        (2, "Ed", "Nan", "Lead", 1, None, None, None, None, None, None, None, None, None, None),
        (3, "Peacock", "Jane", "Agent", 2, None, None, None, None, None, None, None, None, None, None),
        (4, None, "Half", "Agent", 2, None, None, None, None, None, None, None, None, None, None),
    ],
    "Invoice": [
        (1, 1, "2009-01-01 00:00:00", None, "Oslo", "", "Norway", None, D("1.98")),
        (2, 1, "2009-02-01 00:00:00", None, None, None, None, None, D("3.96")),
        (10, 1, "2009-01-01 00:00:00", None, None, None, None, None, D("0.00")),
        (0, 2, "2010-01-01 00:00:00", "Str 1", None, None, None, None, D("5.00")),
        (5, 55, "2010-01-01 00:00:00", None, None, None, None, None, D("9.00")),
    ],
    "InvoiceLine": [
        (1, 1, 1, D("0.99"), 1),
        (2, 1, 2, D("0.99"), 1),
        (5, 2, 5, D("0.99"), 2),
        (4, 2, 3, D("1.99"), 1),
        (3, 2, None, D("0.99"), 1),
        (0, 0, 0, D("5.00"), 1),
    ],
}


def music_tables(spark):
    return {t: spark.createDataFrame(ROWS[t], schema) for t, schema in MUSIC_STORE_SCHEMAS.items()}
