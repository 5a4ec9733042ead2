import os

import pytest
from music import music_tables
from pyspark.sql import functions as F

from nestloom.operators import nest
from nestloom.operators.access import PART, pattern_counts
from nestloom.plans.load import Entity, Load, Target, keys_present
from nestloom.plans.music_store import music_store_targets
from nestloom.sources.control import Control
from nestloom.sources.idset import IdSet
from nestloom.sources.keyed import CheckFailed, KeyedTable
from nestloom.sources.tables import STAR_SCHEMAS

ITEM = "PK string, SK string, v bigint"


@pytest.fixture()
def store(spark, scratch):
    return KeyedTable(spark, scratch(), ITEM, parts=4, buckets=4)


def items(spark, n, step=0):
    return spark.range(n).select(
        F.concat(F.lit("P#"), (F.col("id") % 20).cast("string")).alias("PK"),
        F.concat(F.lit("S#"), F.col("id").cast("string")).alias("SK"),
        (F.col("id") + step).alias("v"),
    )


def content(df):
    return {(r.PK, r.SK): r.v for r in df.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_empty_table(store):
    assert store.count() == 0 and not store.exists()
    assert store.query("P#1").count() == 0


def test_overwrite_replaces_everything(spark, store):
    store.overwrite(items(spark, 100))
    store.overwrite(items(spark, 60, step=1000))
    assert store.exists() and content(store.items()) == content(items(spark, 60, step=1000))
    store.overwrite(store.items().limit(7))  # reads itself
    assert store.count() == 7


def test_refused_items_change_nothing(spark, store):
    store.overwrite(items(spark, 10))
    with pytest.raises(CheckFailed, match="too few"):
        store.overwrite(items(spark, 1), [lambda d: "too few" if d.count() < 5 else None])
    with pytest.raises(CheckFailed, match="without key"):
        store.upsert(items(spark, 3).withColumn("SK", F.lit(None).cast("string")), checks=[keys_present])
    assert content(store.items()) == content(items(spark, 10))


def test_another_session_finds_the_files(spark, store):
    store.overwrite(items(spark, 30))
    spark.sql(f"DROP TABLE {store.name}")
    again = KeyedTable(spark, store.root, ITEM, parts=4, buckets=4)
    assert content(again.items()) == content(items(spark, 30)) and again.query("P#3").count() == 2


def test_upsert_rewrites_touched_folders_only(spark, store, rows):
    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(store.root) for f in names if f.endswith(".parquet")}

    store.overwrite(items(spark, 200))
    before = files()
    change = rows(ITEM, ("P#1", "S#1", -1), ("P#1", "new", 5))
    store.upsert(change)
    assert len({os.path.dirname(f) for f in files() - before}) == 1 and before & files()
    want = content(items(spark, 200)) | {("P#1", "S#1"): -1, ("P#1", "new"): 5}
    assert content(store.items()) == want
    same = files()
    store.upsert(rows(ITEM))
    assert files() == same
    store.upsert(change)  # the same changes again
    assert content(store.items()) == want


def test_stored_rows_are_not_shuffled(spark, store, rows):
    store.overwrite(items(spark, 200))
    # under a stored scan there is no exchange; the only ones are those of the requested or changed keys
    found = plan(store.lookup(rows("PK string", ("P#1",)).hint("merge")))
    stored = found[found.index("SortMergeJoin") :].split(":-")[1].split("+- Sort")[0] if ":-" in found else ""
    assert "Bucketed: true" in stored and "Exchange" not in stored
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        change = store._expanded(rows(ITEM, ("P#1", "S#1", -1)), ["items"], F.lit(False))
        merged = plan(store._merged(change, {"items": [0, 1, 2, 3]}))
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    stored = merged[merged.index("SortMergeJoin") :].split("+- Sort")[0]
    assert "Bucketed: true" in stored and "Exchange" not in stored


def test_late_change_after_a_delete_loses(spark, scratch, rows):
    table = KeyedTable(spark, scratch(), "k bigint, n bigint, v string", keys=["k"], parts=2, buckets=2)
    change = "k bigint, n bigint, v string, op string"
    table.upsert(rows(change, (1, 1, "a", None), (2, 1, "b", None), (None, 1, "none", None)), "n", "op")
    table.upsert(rows(change, (1, 5, None, "delete"), (9, 3, None, "delete")), "n", "op")
    table.upsert(rows(change, (1, 3, "late", None), (9, 2, "late", None), (2, 2, "c", None)), "n", "op")
    assert {(r.k, r.n, r.v) for r in table.items().collect()} == {(2, 2, "c"), (None, 1, "none")}
    table.upsert(rows(change, (1, 6, "back", None)), "n", "op")
    assert {(r.k, r.v) for r in table.items().collect()} == {(1, "back"), (2, "c"), (None, "none")}


def test_deleting_all_items_of_a_folder(spark, store, rows):
    store.overwrite(rows(ITEM, ("a", "1", 1), ("b", "1", 2)))
    store.upsert(rows(ITEM + ", op string", ("a", "1", None, "delete")), op="op")
    assert content(store.items()) == {("b", "1"): 2}


def test_indexes_follow_their_items(spark, scratch, rows):
    fields = "PK string, SK string, G string, H string, n bigint"
    table = KeyedTable(spark, scratch(), fields, parts=2, buckets=2, indexes={"G1": ("G", "H"), "G2": ("H", None)})
    table.upsert(rows(fields, ("a", "1", "g", "2", 1), ("b", "1", "g", "1", 1), ("c", "1", None, "1", 1)), "n")
    found = lambda name, key: [r.PK for r in table.query_index(name, key).collect()]
    assert found("G1", "g") == ["b", "a"] and sorted(found("G2", "1")) == ["b", "c"]
    table.upsert(rows(fields, ("a", "1", "x", "2", 2), ("b", "1", None, "9", 2), ("c", "1", "late", "1", 0)), "n")
    assert found("G1", "g") == [] and found("G1", "x") == ["a"] and found("G1", "late") == [] and found("G2", "9") == ["b"]
    table.upsert(rows(fields + ", op string", ("a", "1", None, None, 3, "delete")), "n", "op")
    assert found("G1", "x") == [] and table.index("G2").count() == 2
    with pytest.raises(ValueError):
        table.index("G3")


def test_lookup_reads_one_folder(spark, store):
    store.overwrite(items(spark, 200))
    found = store.query("P#3", sk_prefix="S#")
    text = found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert f"{PART}#" in text and "isnotnull(_part" in text
    assert "StartsWith(SK" in text and "EqualTo(PK,P#3)" in text
    assert content(found) == {k: v for k, v in content(items(spark, 200)).items() if k[0] == "P#3"}
    assert [r.v for r in store.get("P#3", "S#23").collect()] == [23]


def test_a_dominant_collection_is_spread_over_buckets(spark, scratch):
    wide = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("PK"), F.col("id").cast("string").alias("SK"), "id"
    ).withColumnRenamed("id", "v")
    table = KeyedTable(spark, scratch(), ITEM, parts=2, buckets=16, spread=8)
    table.overwrite(wide)
    assert table.query("hot").count() == 2000 and table.count() == 3000
    hot = spark.table(table.name).where("_key = 'hot'")
    assert hot.select(F.hash("_key", "_slot") % 16).distinct().count() > 3
    assert table.lookup(spark.createDataFrame([("hot",), ("0",)], "PK string")).count() == 2001


def test_thousands_of_patterns_in_one_join(spark):
    target = items(spark, 200)
    asked = spark.range(3000).selectExpr(
        "cast(id AS string) AS pattern", "concat('P#', id % 40) AS pk", "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'S#1' ELSE concat('S#', id % 200) END AS prefix"
    )
    stored = [(r.PK, r.SK) for r in target.collect()]
    want = {r.pattern: sum(k == r.pk and s.startswith(r.prefix or "") for k, s in stored) for r in asked.collect()}
    assert {r.pattern: r["items"] for r in pattern_counts(target, asked).collect()} == want


# -- ids taken over --------------------------------------------------------------------------------


def test_ids_are_remembered_exactly(spark, scratch):
    ids, first = IdSet(spark, scratch()), spark.range(0, 200_000, 3).where("id <> 9")
    seen = ids.look(first, "id")
    assert (seen.fresh.count(), seen.total, seen.last_id) == (first.count(), first.count(), 199_998)
    ids.remember(seen)
    assert not ids.look(first, "id").any
    more = first.union(spark.createDataFrame([(9,), (10,), (-5,), (1 << 40,)], "id bigint"))
    seen = ids.look(more, "id")
    assert sorted(r.id for r in seen.fresh.collect()) == [-5, 9, 10, 1 << 40] and seen.last_id == 1 << 40
    # rows that arrive between the look and the load are left to the next one
    ids.remember(seen)
    assert [r.id for r in ids.look(more.union(spark.range(7, 8)), "id").fresh.collect()] == [7]
    # only the blocks in question are remembered anew
    assert seen.pending.count() == 3 and ids.look(first, "id").any


def test_late_ids_between_known_ones_are_found_without_looking_through_the_runs(spark, scratch):
    """Every seventh id comes late, so a block has thousands of runs: no row may carry them or be compared with each."""
    ids = IdSet(spark, scratch())
    numbers = spark.range(-70_000, 70_000).select("id", (F.col("id") * 2).alias("v"))
    ids.remember(ids.look(numbers.where("id % 7 <> 3 AND id % 7 <> -4"), "id"))
    twice = numbers.union(spark.createDataFrame([(3, 0), (4, 0), (None, 1)], "id bigint, v bigint"))  # one late, one known
    late = {(i, 2 * i) for i in range(-70_000, 70_000) if i % 7 == 3} | {(3, 0)}
    seen = ids.look(twice, "id")
    assert {tuple(r) for r in seen.fresh.collect()} == late and seen.fresh.count() == len(late)
    text = plan(seen.fresh)
    assert "exists(" not in text and "runs" not in text
    # blocks that are new as a whole beside those that are not
    more = numbers.union(spark.range(200_000, 300_000).select("id", F.lit(0)))
    seen = ids.look(more, "id")
    assert seen.fresh.count() == 120_000 and "exists(" not in plan(seen.fresh) and "runs" not in plan(seen.fresh)
    ids.remember(seen)
    assert not ids.look(more, "id").any


def test_owners_whose_rows_changed(spark, scratch, rows):
    ids, fields = IdSet(spark, scratch()), "p bigint, t bigint"
    owners = lambda *values: sorted(r.p for r in ids.look_at_owners(rows(fields, *values), "p").fresh.collect())
    given = [(1, 1), (1, 2), (2, 1), (3, 5), (None, 4)]
    assert owners(*given) == [1, 2, 3]
    ids.remember(ids.look_at_owners(rows(fields, *given), "p"))
    assert owners(*given) == [] and owners(*given[::-1]) == []
    assert owners((1, 1), (1, 3), (2, 1), (4, 4)) == [1, 3, 4]
    ids.remember(ids.look_at_owners(rows(fields, (1, 1), (2, 1)), "p"))
    assert owners((1, 1), (2, 1)) == [] and owners((1, 1), (2, 1), (3, 5)) == [3]


# -- loads ---------------------------------------------------------------------------------------


def albums(spark, upto):
    return spark.range(1, upto + 1).withColumnRenamed("id", "AlbumId")


def album_target(source):
    def build(batch):
        return batch.select(
            F.concat(F.lit("ALBUM#"), F.col("AlbumId").cast("string")).alias("PK"),
            F.lit("METADATA").alias("SK"),
            F.lit("Album").alias("EntityType"),
            "AlbumId",
        )

    return Target("Catalog", (Entity("Album", source, "AlbumId", build),))


def test_interrupted_then_continued_load_equals_one_full_load(spark, scratch):
    root = scratch()
    assert Load(spark, root, [album_target(albums(spark, 200))], buckets=4, parts=2).run()
    rest = Load(spark, root, [album_target(albums(spark, 347))], buckets=4, parts=2)
    assert rest.control.entities("Catalog")["Album"].last_id == 200
    assert rest.refresh()
    row = rest.control.entities("Catalog")["Album"]
    assert (row.migrated, row.total, row.last_id, row.status) == (347, 347, 347, "completed")
    full = Load(spark, scratch(), [album_target(albums(spark, 347))], buckets=4, parts=2)
    full.run()
    keys = ["PK", "SK", "AlbumId"]
    left, right = rest.stores["Catalog"].items().select(keys), full.stores["Catalog"].items().select(keys)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
    # taking the same rows over again changes nothing
    rest.control.reset({"Catalog": ["Album"]})
    assert rest.run() and rest.stores["Catalog"].count() == 347


def test_first_load_keeps_one_item_per_key(spark, scratch):
    source = albums(spark, 50).withColumn("AlbumId", F.col("AlbumId") % 40)
    load = Load(spark, scratch(), [album_target(source)], buckets=4, parts=2)
    assert load.run() and load.stores["Catalog"].count() == 40


def test_failed_target_stops_the_run_and_can_be_resumed(spark, scratch):
    root = scratch()
    bad = Target("Second", album_target(albums(spark, 5)).entities, (lambda d: "refused",))
    good = album_target(albums(spark, 9))
    third = Target("Third", album_target(albums(spark, 3)).entities)
    load = Load(spark, root, [good, bad, third], buckets=4, parts=2)
    assert not load.run()
    assert {r.target: r.status for r in load.status().collect()} == {
        "Catalog": "completed", "Second": "failed", "Third": "not_started",
    }
    assert [r.error for r in load.control.errors().collect()] == ["refused"]
    assert {r.target for r in load.control.pending().collect()} == {"Second", "Third"}
    again = Load(spark, root, [good, Target("Second", bad.entities), third], buckets=4, parts=2)
    assert again.resume()
    summary = again.control.summary().first()
    assert (summary.overall_status, summary.completed_tables, summary.total_records, summary.migrated_records) == (
        "completed", 3, 17, 17,
    )
    assert (summary.progress_percentage, summary.error_count) == (100.0, 1)
    assert {r.target: r.live_items for r in again.status(live=True).collect()} == {"Catalog": 9, "Second": 5, "Third": 3}


def test_force_rebuilds_a_completed_target(spark, scratch):
    root = scratch()
    load = Load(spark, root, [album_target(albums(spark, 9))], buckets=4, parts=2)
    load.run()
    files = lambda: {f for d, _, names in os.walk(load.stores["Catalog"].root) for f in names}
    before = files()
    assert load.run() and files() == before  # completed: skipped
    assert load.run("Catalog", force=True)
    assert files() != before and load.stores["Catalog"].count() == 9
    load.reset()
    assert {r.status for r in load.status().collect()} == {"not_started"}
    assert load.control.summary().first().progress_percentage == 0.0


def test_the_four_music_store_targets(spark, scratch):
    t = music_tables(spark)
    load = Load(spark, scratch(), music_store_targets(t, line_cap=2, member_cap=5), buckets=4, parts=2)
    assert load.run()
    found = {(r.target, r.entity): (r.source_count, r.target_count) for r in load.validate().collect()}
    assert found == {
        ("MusicCatalog", "Artist"): (4, 4),
        ("MusicCatalog", "Album"): (5, 4),
        ("MusicCatalog", "Track"): (6, 4),
        ("CustomerOrders", "CustomerProfile"): (3, 3),
        ("CustomerOrders", "Order"): (5, 4),  # one order of an unknown customer
        ("Playlists", "Playlist"): (3, 3),
        ("EmployeeManagement", "Employee"): (4, 4),
    }
    kept = load.stores["CustomerOrders"].get("CUSTOMER#1", "ORDER#2009-01-01 00:00:00#1").first()
    assert [x.TrackName for x in kept.LineItems] == ["One", "Two"]
    assert [r.SK for r in load.query_index("MusicCatalog", "GSI1", "ALBUM_TITLE#Ten").collect()] == ["ALBUM#10"]
    assert [r.SK for r in load.query_index("MusicCatalog", "GSI2", "GENRE#Rock", limit=50).collect()] == ["TRACK#1"]
    assert [r.PK for r in load.query_index("CustomerOrders", "GSI1", "EMAIL#bob@x.it").collect()] == ["CUSTOMER#2"]
    assert {r.stale_items for r in load.validate().collect()} == {0}
    pages = load.stores["Playlists"].query("PLAYLIST#3", sk_prefix="TRACKS_PAGE#").collect()
    assert [len(r.Tracks) for r in pages] == [5, 1]
    store = load.stores["CustomerOrders"]
    bob = store.items().where("Email = 'bob@x.it'").withColumn("GSI1PK", F.lit("EMAIL#new@x.it"))
    store.upsert(bob)
    assert [r.PK for r in load.query_index("CustomerOrders", "GSI1", "EMAIL#new@x.it").collect()] == ["CUSTOMER#2"]
    assert load.query_index("CustomerOrders", "GSI1", "EMAIL#bob@x.it").count() == 0
    store.overwrite(store.items().limit(0))
    assert load.index("CustomerOrders", "GSI1").count() == 0  # never an index of another version


def test_refresh_derives_what_new_rows_reach_and_sync_what_changed(spark, scratch):
    t = music_tables(spark)
    early = t | {
        "Track": t["Track"].where("TrackId <= 2"), "Invoice": t["Invoice"].where("InvoiceId <= 1"),
        "InvoiceLine": t["InvoiceLine"].where("InvoiceLineId <= 1"), "PlaylistTrack": t["PlaylistTrack"].where("TrackId < 2"),
    }
    root = scratch()
    assert Load(spark, root, music_store_targets(early, 2, 5), buckets=4, parts=2).run()
    late = Load(spark, root, music_store_targets(t, 2, 5), buckets=4, parts=2)
    assert late.refresh()
    assert {r.stale_items for r in late.validate().collect()} == {0}
    renamed = t | {"Artist": t["Artist"].withColumn("Name", F.concat("Name", F.lit("!"))), "Playlist": t["Playlist"].where("PlaylistId <> 3")}
    other = Load(spark, root, music_store_targets(renamed, 2, 5), buckets=4, parts=2)
    assert max(r.stale_items for r in other.validate().collect()) > 0
    other.sync()
    assert {r.stale_items for r in other.validate().collect()} == {0}
    assert other.stores["Playlists"].query("PLAYLIST#3").count() == 0


def test_a_load_is_set_up_without_sorting_its_source(spark, scratch, monkeypatch):
    """The schema of a target with pages comes from no rows; a load derives its items when it runs, once."""
    written = []
    real = nest.materialize
    monkeypatch.setattr(nest, "materialize", lambda df, label: written.append((out := real(df, label)).count()) or out)
    target = next(t for t in music_store_targets(music_tables(spark), member_cap=2) if t.name == "Playlists")
    load = Load(spark, scratch(), [target], parts=2, buckets=2)
    assert sum(written) == 0
    assert load.stores["Playlists"].schema == target.items().schema and sum(written) == 9  # of three lists, two have pages
    assert load.run() and sum(written) == 18
    assert load.stores["Playlists"].count() == 3 + 2 + 3
    assert load.rejects("Playlists").count() == 0 and sum(written) == 18


def test_late_rows_and_changed_owners_are_derived_alone(spark, scratch):
    """Only what changed is derived again: the builder is asked for no other row."""
    t = music_tables(spark)
    root = scratch()
    lists = lambda tables: [x for x in music_store_targets(tables, 2, 5) if x.name in ("Playlists", "EmployeeManagement")]
    early = t | {"Track": t["Track"].where("TrackId <> 2"), "PlaylistTrack": t["PlaylistTrack"].where("NOT (PlaylistId = 3 AND TrackId = 5)")}
    assert Load(spark, root, lists(early), buckets=4, parts=2).run()
    asked = {}

    def counting(target):
        from dataclasses import replace

        def watched(e):
            def build(batch):
                asked.setdefault(e.name, set()).update(r[0] for r in batch.select(e.id_column).collect())
                return e.items(batch)

            return replace(e, items=build)

        return replace(target, entities=tuple(watched(e) for e in target.entities))

    late = Load(spark, root, lists(t), buckets=4, parts=2)
    late.targets = {n: counting(x) for n, x in late.targets.items()}
    asked.clear()
    assert late.refresh()
    assert asked == {"Playlist": {1, 3}}
    assert {r.stale_items for r in Load(spark, root, lists(t), buckets=4, parts=2).validate().collect()} == {0}


def test_rejected_items_are_kept_apart_and_counted(spark, scratch):
    target = Target("Catalog", album_target(albums(spark, 30)).entities, rules=lambda d: {"odd": F.col("AlbumId") % 2 == 0, "small": F.col("AlbumId") < 20})
    load = Load(spark, scratch(), [target], buckets=4, parts=2)
    assert load.run() and load.stores["Catalog"].count() == 9
    assert {(r.AlbumId, r.failed_rule) for r in load.rejects("Catalog").collect()} == {(i, "odd") for i in range(1, 31, 2)} | {(i, "small") for i in range(20, 31, 2)}
    assert {(r.measure, r["items"]) for r in load.metrics().collect()} == {("rows", 30), ("odd", 15), ("small", 6)}


def test_control_starts_empty(spark, scratch):
    control = Control(spark, scratch())
    assert control.summary().first().total_tables == 0 and control.errors().count() == 0


def test_hot_index_key_is_spread_with_the_buckets(spark, scratch):
    """All rows under one index key: more slots mean smaller buckets, and every lookup still finds them."""
    table = KeyedTable(spark, scratch(), ITEM + ", G string", parts=2, buckets=16, indexes={"G": ("G", None)}, index_spread=32)
    table.overwrite(items(spark, 600).withColumn("G", F.lit("hot")))
    held = spark.table(table.name).where("_copy = 'G'").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in held) == 600 and max(r["count"] for r in held) < 200 and len(held) > 4
    assert table.query_index("G", "hot").count() == 600
    assert table.lookup(spark.createDataFrame([("hot",)], "PK string"), copy="G").count() == 600
    table.upsert(items(spark, 3).withColumn("G", F.lit("cold")))
    assert table.query_index("G", "hot").count() == 597 and table.query_index("G", "cold").count() == 3


def test_stored_targets_get_buckets_by_input(spark, tmp_path, monkeypatch):
    """Four times the input, four times the buckets: no task of a build grows with the folder."""
    from nestloom.suite import queries

    for n in (1, 4):
        for name in ("customer", "supplier", "orders", "lineitem", "part", "nation", "region"):
            rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
            for i in range(n):
                rows.write.mode("append").parquet(f"{tmp_path}/{n}/{name}.parquet")
    monkeypatch.setattr(queries, "BUCKET_BYTES", 4096)
    small, large = (queries._layout(queries.Roles(spark, f"{tmp_path}/{n}")) for n in (1, 4))
    assert 4 * small["buckets"] - 4 <= large["buckets"] <= 4 * small["buckets"] and large["index_spread"] > 3 * small["index_spread"]
    assert small["buckets"] > 8 and queries._catalog_store(queries.Roles(spark, f"{tmp_path}/1")).buckets == small["buckets"]


def test_buckets_follow_rows_where_files_compress_well(spark, tmp_path, monkeypatch):
    """Ten times the rows in hardly larger files: ten times the buckets, and a hot index key lies in all of them alike."""
    from nestloom.suite import queries

    for n in (1, 10):
        for name in ("customer", "supplier", "orders", "lineitem", "part"):
            fields = spark.createDataFrame([], STAR_SCHEMAS[name]).schema.fields
            alike = spark.range(0, 400 * n, 1, 1).select(*[F.lit("7").cast(f.dataType).alias(f.name) if f.dataType.typeName() != "timestamp_ntz" else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
            alike.write.parquet(f"{tmp_path}/{n}/{name}.parquet")
    monkeypatch.setattr(queries, "BUCKET_ROWS", 100)
    small, large = (queries._layout(queries.Roles(spark, f"{tmp_path}/{n}")) for n in (1, 10))
    assert small["buckets"] == 20 and large["buckets"] == 200
    table = KeyedTable(spark, f"{tmp_path}/store", ITEM + ", G string", parts=2, indexes={"G": ("G", None)}, **small)
    table.overwrite(items(spark, 4000).withColumn("G", F.lit("hot")))
    held = [r["count"] for r in spark.table(table.name).where("_copy = 'G'").groupBy(F.input_file_name()).count().collect()]
    assert sum(held) == 4000 and max(held) <= 3 * 4000 / 20


def test_renewed_items_meet_the_stored_ones_without_moving_them(spark, scratch):
    """Equal items are passed over, of repeated keys one is taken, and index entries follow; stored rows are not shuffled."""
    table = KeyedTable(spark, scratch(), ITEM + ", G string", parts=2, buckets=4, indexes={"G": ("G", None)})
    before = items(spark, 40).withColumn("G", F.lit("old"))
    table.overwrite(before)
    seen, changed = [], (F.col("v") < 5)
    now = before.withColumns({"G": F.when(changed, "new").otherwise(F.col("G"))})
    table.put(now.unionByName(now), checks=[lambda d: seen.append(d.count())])
    assert seen == [5] and table.count() == 40
    assert table.query_index("G", "new").count() == 5 and table.query_index("G", "old").count() == 35
    main = table._expanded(now, ["items"], F.lit(False)).select(*table._columns)
    with table._joining():
        joined = plan(table._moved(main, None, renew=True).hint("merge"))
        assert joined.count("Exchange hashpartitioning") <= 1 and "_new" in joined


def test_items_move_without_their_place(spark, scratch, monkeypatch):
    """A first write shuffles the values and the name of the copy; each bucket of a folder is still one file, packed tightly."""
    table = KeyedTable(spark, scratch(), ITEM + ", G string", parts=2, buckets=4, indexes={"G": ("G", None)}, index_spread=8)
    seen, insert = [], table._insert
    monkeypatch.setattr(table, "_insert", lambda rows, mode: (seen.append(rows._jdf.queryExecution().optimizedPlan().toString()), insert(rows, mode)))
    rows = items(spark, 300).withColumn("G", F.when(F.col("v") % 3 > 0, F.concat(F.lit("g"), (F.col("v") % 5).cast("string"))))
    table.overwrite(rows)
    moved = seen[0].split("RepartitionByExpression")[1]
    assert "_copy#" in moved and not any(f"AS {c}#" in moved for c in ("_key", "_id", "_slot", "_part", "_gone"))
    assert table.count() == 300 and table.index("G").count() == 200 and table.query_index("G", "g1").count() == 40
    names = [r[0].split("/")[-3:] for r in spark.table(table.name).select(F.input_file_name()).distinct().collect()]
    buckets = [(*folders, n.split("_")[-1]) for *folders, n in names]
    assert len(set(buckets)) == len(buckets) and all(".zstd." in n for *_, n in names)


def test_early_loads_see_early_tables(spark):
    """Loads from an earlier state read that state: rows kept out, and tables that were put in place of the files."""
    from nestloom.suite import queries

    r = queries.Roles(spark, "/nowhere", {"orders": F.col("o_orderkey") % 7 != 3})
    r.tables = {n: spark.createDataFrame([], STAR_SCHEMAS[n]) for n in ("region", "nation", "customer", "supplier", "part", "lineitem")}
    r.tables["orders"] = spark.range(20).select(*[F.col("id").cast(t).alias(c) if c == "o_orderkey" else F.lit(None).cast(t).alias(c) for c, t in spark.createDataFrame([], STAR_SCHEMAS["orders"]).dtypes])
    whole, part = (queries._targets(r, ("MusicCatalog",), upto)[0].entities[-1].source for upto in (None, 9))
    assert sorted(x.TrackId for x in whole.select("TrackId").collect()) == [n for n in range(20) if n % 7 != 3]
    assert sorted(x.TrackId for x in part.select("TrackId").collect()) == [0, 1, 2, 4, 5, 6, 7, 8, 9]


def test_repeats_are_looked_for_bucket_by_bucket(spark, scratch, monkeypatch):
    """Digests are dealt over the buckets before any is counted, so no task holds those of a whole file; one repeat among many is found."""
    from nestloom.sources import keyed

    seen, find = [], keyed.duplicate_keys
    monkeypatch.setattr(keyed, "duplicate_keys", lambda df, columns: (seen.append(find(df, columns)), seen[-1])[1])
    table = KeyedTable(spark, scratch(), ITEM, parts=2, buckets=23)
    one_file = spark.createDataFrame(items(spark, 5000).coalesce(1).collect(), ITEM).coalesce(1)
    assert not table._repeats(one_file) and table._repeats(one_file.unionByName(one_file.where("v = 4321")))
    assert [df.rdd.getNumPartitions() for df in seen] == [23, 23]
    for df in seen:
        below = plan(df.select("*")).split("hashpartitioning")
        assert len(below) == 2 and "HashAggregate" not in below[1]
    table.overwrite(one_file.unionByName(one_file.where("v = 4321")))
    assert table.count() == 5000


def test_a_large_file_is_read_by_many_tasks(spark, monkeypatch):
    """A table on its way to the buckets is shared out by its bytes, in one file as in many."""
    from nestloom.sources import scratch

    monkeypatch.setattr(scratch, "SPLIT_BYTES", 1 << 20, raising=False)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with scratch.written(spark.range(0, 600000, 1, 1).select("id", F.xxhash64("id").alias("v"))) as rows:
        held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 600000 and max(held) <= 250000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == usual
