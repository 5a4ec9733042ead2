from decimal import Decimal as D

import pytest
from music import music_tables

from nestloom.operators import access, validate
from nestloom.operators.nest import entity_counts
from nestloom.plans import catalog, customers, playlists, staff


@pytest.fixture(scope="module")
def t(spark):
    return music_tables(spark)


def by(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


def test_artist_counts_match_distinct_counts_over_the_join(spark, t):
    got = by(catalog.artist_items(t["Artist"], t["Album"], t["Track"]), "ArtistId")
    for name in ("Artist", "Album", "Track"):
        t[name].createOrReplaceTempView(name)
    plain = spark.sql(
        """SELECT a.ArtistId, count(DISTINCT al.AlbumId) albums, count(DISTINCT t.TrackId) tracks
        FROM Artist a LEFT JOIN Album al ON a.ArtistId = al.ArtistId LEFT JOIN Track t ON al.AlbumId = t.AlbumId
        GROUP BY a.ArtistId"""
    )
    assert {(r.ArtistId, r.albums, r.tracks) for r in plain.collect()} == {
        (k, r.AlbumCount, r.TrackCount) for k, r in got.items()
    }
    assert (got[2].AlbumCount, got[2].TrackCount) == (0, 0)
    assert (got[1].PK, got[1].SK, got[1].GSI1PK, got[1].GSI1SK) == ("ARTIST#1", "METADATA", "ARTIST_NAME#AC/DC", "ARTIST#1")
    assert got[3].GSI1PK is None  # a missing name leaves the item out of the index, not a key with "None" in it
    assert got[0].PK == "ARTIST#0" and got[0].AlbumCount == 1


def test_album_needs_its_artist(t):
    got = by(catalog.album_items(t["Album"], t["Artist"], t["Track"]), "AlbumId")
    assert set(got) == {0, 1, 2, 10}
    assert (got[1].PK, got[1].SK, got[1].ArtistName, got[1].TrackCount) == ("ARTIST#1", "ALBUM#1", "AC/DC", 2)
    assert got[2].TrackCount == 0


def test_track_optional_and_dependent_attributes(t):
    got = by(catalog.track_items(*[t[n] for n in ("Track", "Album", "Artist", "Genre", "MediaType")]), "TrackId")
    assert set(got) == {0, 1, 2, 3}  # without album, or with an album without artist, a track is left out
    one, two, three, nought = got[1], got[2], got[3], got[0]
    assert (one.PK, one.SK, one.GSI1PK, one.GSI2PK) == ("ALBUM#1", "TRACK#1", "TRACK_NAME#One", "GENRE#Rock")
    assert (one.Composer, one.Milliseconds, one.UnitPrice, one.MediaTypeName) == (None, 343719, D("0.99"), "MPEG")
    assert (two.Composer, two.Milliseconds, two.GenreId, two.GenreName, two.GSI2PK) == (None, None, None, None, None)
    assert (three.GenreId, three.GenreName, three.GSI2PK, three.MediaTypeId, three.Bytes) == (9, None, None, None, None)
    assert (nought.GenreId, nought.GenreName, nought.GSI2PK) == (2, None, None)


def test_catalog_counts_add_up_and_orphans_explain_the_rest(t):
    target = catalog.catalog_target(*[t[n] for n in ("Artist", "Album", "Track", "Genre", "MediaType")])
    counts = {r.EntityType: r["items"] for r in entity_counts(target).collect()}
    assert counts == {"Artist": 4, "Album": 4, "Track": 4} and sum(counts.values()) == target.count()
    found = by(validate.reconcile_entities(target, {n: t[n] for n in ("Artist", "Album", "Track")}), "name")
    assert (found["Track"].source_count, found["Track"].target_count, found["Track"].count_match) == (6, 4, False)
    lost = validate.orphans(t["Track"], t["Album"], "AlbumId", "AlbumId").collect()
    assert [r.TrackId for r in lost] == [5]


def test_artist_page_holds_albums_but_no_tracks(t):
    target = catalog.catalog_target(*[t[n] for n in ("Artist", "Album", "Track", "Genre", "MediaType")])
    assert [r.SK for r in access.query(target, "ARTIST#1").collect()] == ["ALBUM#1", "ALBUM#10", "ALBUM#2", "METADATA"]
    assert [r.SK for r in access.query(target, "ARTIST#1", sk_prefix="ALBUM#1", descending=True).collect()] == ["ALBUM#10", "ALBUM#1"]
    assert [r.SK for r in access.query(target, "ARTIST#1", limit=1).collect()] == ["ALBUM#1"]


def test_profiles_add_up_once_per_order(t):
    got = by(customers.profile_items(t["Customer"], t["Employee"], t["Invoice"]), "CustomerId")
    ann, bob, nil = got[1], got[2], got[0]
    assert (ann.TotalOrders, ann.TotalSpent) == (3, D("5.94"))
    assert (bob.TotalOrders, bob.TotalSpent) == (1, D("5.00"))
    assert (nil.TotalOrders, nil.TotalSpent, nil.GSI1PK) == (0, D("0.00"), None)
    assert (ann.Company, ann.State, ann.Fax, ann.SupportRepName) == ("Co", None, None, "Jane Peacock")
    assert (bob.SupportRepId, bob.SupportRepName) == (4, None)  # half a name is no name
    assert (ann.PK, ann.SK, ann.GSI1PK) == ("CUSTOMER#1", "PROFILE", "EMAIL#ann@x.no")


def orders(t, cap):
    return by(customers.order_items(*[t[n] for n in ("Invoice", "InvoiceLine", "Track", "Album", "Artist")], cap=cap), "InvoiceId")


def test_order_lines_in_line_order_with_optional_names(t):
    got = orders(t, 50)
    two = got[2]
    assert (two.PK, two.SK) == ("CUSTOMER#1", "ORDER#2009-02-01 00:00:00#2")
    assert [(x.InvoiceLineId, x.TrackName, x.ArtistName, x.AlbumTitle) for x in two.LineItems] == [
        (3, None, None, None),
        (4, "Three", "AC/DC", "Ten"),
        (5, "Orphan", None, None),
    ]
    assert got[10].LineItems == [] and got[10].LineItemCount == 0 and got[10].BillingCity is None
    assert [x.InvoiceLineId for x in got[0].LineItems] == [0]  # id 0 is a child like any other
    assert (got[1].BillingCity, got[1].BillingState, got[0].BillingAddress) == ("Oslo", None, "Str 1")


def test_order_lines_above_the_cap_leave_count_and_flag(t):
    got = orders(t, 2)
    assert (len(got[1].LineItems), got[1].LargeOrder) == (2, None)
    assert (got[2].LineItems, got[2].LineItemCount, got[2].LargeOrder) == (None, 3, True)


def test_whole_customer_target(t):
    names = ("Customer", "Employee", "Invoice", "InvoiceLine", "Track", "Album", "Artist")
    target = customers.customer_orders_target(*[t[n] for n in names])
    assert {(r.PK, r.SK) for r in access.query(target, "CUSTOMER#1", sk_prefix="ORDER#").collect()} == {
        ("CUSTOMER#1", "ORDER#2009-01-01 00:00:00#1"),
        ("CUSTOMER#1", "ORDER#2009-01-01 00:00:00#10"),
        ("CUSTOMER#1", "ORDER#2009-02-01 00:00:00#2"),
    }
    newest = access.latest(target, 1, "ORDER#")
    assert {(r.PK, r.InvoiceId) for r in newest.collect()} == {("CUSTOMER#1", 2), ("CUSTOMER#2", 0)}
    assert target.where("PK = 'CUSTOMER#55'").count() == 0


def test_playlists_embed_or_flag(t):
    names = ("Playlist", "PlaylistTrack", "Track", "Album", "Artist")
    got = by(playlists.playlist_items(*[t[n] for n in names], cap=5), "PlaylistId")
    music, nothing, big = got[1], got[2], got[3]
    assert [x.Name for x in music.Tracks] == ["Nought", "One", "Two"]
    assert (music.TrackCount, music.TotalDuration, music.LargePlaylist) == (3, 343726, None)
    assert (nothing.Tracks, nothing.TrackCount, nothing.TotalDuration) == ([], 0, 0)
    assert (big.Tracks, big.TrackCount, big.LargePlaylist) == (None, 6, True)
    assert [x.Duration for x in music.Tracks] == [7, 343719, None]
    assert music.Tracks[0].UnitPrice is None  # a price of zero is absent


def test_playlist_pages_only_for_large_ones(t):
    names = ("PlaylistTrack", "Track", "Album", "Artist")
    pages = playlists.playlist_pages(*[t[n] for n in names], cap=4).orderBy("Page").collect()
    assert [(p.PK, p.SK, p.PageTrackCount) for p in pages] == [
        ("PLAYLIST#3", "TRACKS_PAGE#1", 4),
        ("PLAYLIST#3", "TRACKS_PAGE#2", 2),
    ]
    assert [x.Name for p in pages for x in p.Tracks] == ["Nought", "One", "Orphan", "Stray", "Three", "Two"]
    target = playlists.playlists_target(*[t[n] for n in ("Playlist", *names)], cap=4)
    assert [r.SK for r in access.query(target, "PLAYLIST#3").collect()] == ["METADATA", "TRACKS_PAGE#1", "TRACKS_PAGE#2"]


def test_playlist_sample_and_sizes(t):
    got = playlists.playlist_sample(t["PlaylistTrack"], t["Track"], t["Album"], t["Artist"], 3, 2).collect()
    assert [r.TrackName for r in got] == ["Nought", "One"]
    sizes = by(playlists.playlist_sizes(t["Playlist"], t["PlaylistTrack"]), "PlaylistId")
    assert {k: r.TrackCount for k, r in sizes.items()} == {1: 3, 2: 0, 3: 6}


def test_staff_manager_and_customers(t):
    got = by(staff.employee_items(t["Employee"], t["Customer"]), "EmployeeId")
    assert (got[1].ReportsTo, got[1].ManagerName, got[1].BirthDate, got[1].Fax) == (None, None, "1962-02-18", None)
    assert (got[2].ManagerName, got[3].ManagerName) == ("Andrew Adams", "Nan Ed")
    assert {k: r.CustomerCount for k, r in got.items()} == {1: 0, 2: 0, 3: 1, 4: 1}


def test_index_is_sparse_and_sorted(t):
    target = catalog.catalog_target(*[t[n] for n in ("Artist", "Album", "Track", "Genre", "MediaType")])
    index = access.build_index(target, "GSI2PK")
    assert [(r.GSI2PK, r.SK) for r in index.collect()] == [("GENRE#Rock", "TRACK#1")]
    by_name = access.build_index(target, "GSI1PK", "GSI1SK").collect()
    assert [r.GSI1PK for r in by_name] == sorted(r.GSI1PK for r in by_name) and len(by_name) == 11


def test_batch_lookup_gives_whole_collections(spark, t, rows):
    target = catalog.catalog_target(*[t[n] for n in ("Artist", "Album", "Track", "Genre", "MediaType")])
    keys = rows("PK string", ("ARTIST#0",), ("ARTIST#0",), ("NONE",))
    assert sorted(r.SK for r in access.lookup(target, keys).collect()) == ["ALBUM#0", "METADATA"]
    assert access.get_item(target, "ARTIST#0", "METADATA").count() == 1
    assert access.by_entity(target, "Album").count() == 4
    patterns = spark.createDataFrame([("all", "ARTIST#1", None), ("albums", "ARTIST#1", "ALBUM#"), ("none", "X", None)], "pattern string, pk string, prefix string")
    assert {r.pattern: r["items"] for r in access.pattern_counts(target, patterns).collect()} == {"all": 4, "albums": 3, "none": 0}
