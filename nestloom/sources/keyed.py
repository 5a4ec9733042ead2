"""Stored targets as Spark tables: partitioned, bucketed and sorted Parquet in the session catalog.

A row belongs to its partition key (``_key``), identified within it by ``_id``. Rows of a key are spread over
``spread`` slots (``index_spread`` in an index), so a collection with a third of all rows is never one bucket. Buckets are hashed by key
and slot: a join of requested or changed keys with the stored rows shuffles the keys only. Rows are sorted by key
and identifier, and ``_part`` folders, a hash of the key, are what a lookup reads and what an upsert
rewrites (dynamic partition overwrite).

Secondary indexes are copies of the rows under their index key, in the same table (``_copy``) and written by the same
job. A deleted item stays as a row without values that remembers its version, so an older change that arrives
late finds it. Applying the same changes again gives the same table, so a repeated batch does no harm.
One writer at a time; readers that started before a write may have to run again.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from nestloom.operators.access import PART, get_item, part_of, query
from nestloom.operators.changes import latest_per_key
from nestloom.sources.scratch import PACKED, path_exists, settings, written
from nestloom.sources.tables import duplicate_keys

Check = Callable[[DataFrame], str | None]

MAIN = "items"  # the copy that holds every item
_BORDER = "\u001f"


class CheckFailed(Exception):
    """Items or changes did not pass their checks; nothing was written."""


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


class KeyedTable:
    """One target under ``root``, keyed by ``keys``; the first is the partition key."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType | str,
        keys: Sequence[str] = ("PK", "SK"),
        parts: int = 16,
        buckets: int = 16,
        spread: int = 4,
        indexes: Mapping[str, tuple[str, str | None]] | None = None,
        index_spread: int | None = None,
    ):
        """``indexes``: name to hash key and range key (or None). ``parts``, ``buckets``, ``spread`` and ``index_spread``
        belong to the layout and may not change between uses of one ``root``. ``index_spread`` (else ``spread``) is the
        number of slots of an index key: few keys may hold all rows there, so it should grow with ``buckets``."""
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.parts, self.buckets, self.spread, self.indexes = parts, buckets, spread, dict(indexes or {})
        self.index_spread = spread if index_spread is None else index_spread
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.name = "keyed_" + hashlib.md5(self.root.encode()).hexdigest()
        inner = [("_key", "string"), ("_id", "string"), ("_slot", "int"), ("_gone", "boolean"), ("_copy", "string"), (PART, "int")]
        self._columns = [*self.schema.names, *[c for c, _ in inner]]
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields] + [f"{c} {t}" for c, t in inner]
        # the files are what counts: the catalog entry is made anew in every session
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        spark.sql(
            f"CREATE TABLE {self.name} ({', '.join(fields)}) USING parquet OPTIONS (compression '{PACKED}') PARTITIONED BY (_copy, {PART}) "
            f"CLUSTERED BY (_key, _slot) SORTED BY (_key, _id) INTO {buckets} BUCKETS LOCATION '{self.root}'"
        )
        if path_exists(spark, self.root):
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    # -- reading -----------------------------------------------------------------------------

    def exists(self) -> bool:
        """Whether anything was ever stored."""
        return not self.spark.sql(f"SHOW PARTITIONS {self.name}").isEmpty()

    def _stored(self, copy: str = MAIN) -> DataFrame:
        return self.spark.table(self.name).where(F.col("_copy") == copy)

    def read(self, copy: str = MAIN) -> DataFrame:
        """Live items with their partition column, for pruned lookups."""
        return self._stored(copy).where("NOT _gone").select(*self.schema.names, PART)

    def items(self) -> DataFrame:
        return self.read().drop(PART)

    def count(self) -> int:
        """Exact number of live items, 0 before the first write."""
        return self.items().count()

    def query(self, pk: str, **options) -> DataFrame:
        return query(self.read(), pk, parts=self.parts, **options).drop(PART)

    def get(self, pk: str, sk: str) -> DataFrame:
        return get_item(self.read(), pk, sk, parts=self.parts).drop(PART)

    def index(self, name: str) -> DataFrame:
        """Items that have the index key."""
        if name not in self.indexes:
            raise ValueError(f"no index {name!r}")
        return self.read(name).drop(PART)

    def query_index(self, name: str, pk: str, **options) -> DataFrame:
        """Items found by index key, in range-key order where the index has one."""
        if name not in self.indexes:
            raise ValueError(f"no index {name!r}")
        pk_column, sk_column = self.indexes[name]
        return query(self.read(name), pk, parts=self.parts, pk_column=pk_column, sk_column=sk_column, **options).drop(PART)

    def lookup(self, keys: DataFrame, column: str = "PK", copy: str = MAIN) -> DataFrame:
        """All items for a table of requested partition keys; the stored side of the join is not shuffled."""
        wanted = keys.select(F.col(column).cast("string").alias("_key")).where("_key IS NOT NULL").distinct()
        slots = self.spread if copy == MAIN else self.index_spread
        wanted = wanted.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        return self._stored(copy).where("NOT _gone").join(wanted, ["_key", "_slot"], "left_semi").select(*self.schema.names)

    # -- writing -----------------------------------------------------------------------------

    def _place(self, copy: str, value: Callable[[str], Column] = _column) -> tuple[Column, Column]:
        """Key and identifier of an item in a copy; without a key it is not in there."""
        own = F.concat_ws(_BORDER, *[_text(value(k)) for k in self.keys[1:]]) if len(self.keys) > 1 else F.lit("")
        if copy == MAIN:
            return _text(value(self.keys[0])), own
        first, second = self.indexes[copy]
        return value(first).cast("string"), F.concat_ws(_BORDER, _text(value(second)) if second else F.lit(""), _text(value(self.keys[0])), own)

    def _places(self, copies: Sequence[str], value: Callable[[str], Column] = _column) -> Column:
        """Where an item belongs: under its own key and under every index key that it has."""
        places = [(c, *self._place(c, value)) for c in copies]
        structs = [F.struct(F.lit(c).alias("_copy"), k.alias("_key"), i.alias("_id")) for c, k, i in places]
        return F.filter(F.array(*structs), lambda x: x["_key"].isNotNull())

    def _slot_of(self, identifier: Column) -> Column:
        slots = F.when(F.col("_copy") == MAIN, F.lit(self.spread)).otherwise(F.lit(self.index_spread))
        return F.pmod(F.xxhash64(identifier), slots).cast("int")

    def _slotted(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_slot": self._slot_of(F.col("_id")), PART: part_of(F.col("_key"), self.parts)})

    def _expanded(self, rows: DataFrame, copies: Sequence[str], gone: Column) -> DataFrame:
        """One row per copy."""
        out = rows.select(*self.schema.names, gone.alias("_gone"), F.explode(self._places(copies)).alias("_at"))
        return self._slotted(out.select(*self.schema.names, "_gone", "_at.*"))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """One row per copy, dealt over the buckets. Rows travel with the name of their copy only; where they belong is
        worked out before and after, as keys and identifiers are values of the row once more."""
        copies = [MAIN, *self.indexes]
        named = F.array(*[F.when(self._place(c)[0].isNotNull(), F.lit(c)) for c in copies])
        out = rows.select(*self.schema.names, F.explode(F.array_compact(named)).alias("_copy"))
        key, identifier = (F.coalesce(*[F.when(F.col("_copy") == c, self._place(c)[i]) for c in copies]) for i in (0, 1))
        out = out.repartition(self.buckets, key, self._slot_of(identifier))
        return self._slotted(out.select("*", F.lit(False).alias("_gone"), key.alias("_key"), identifier.alias("_id")))

    def _joining(self, **more: str) -> contextlib.AbstractContextManager:
        """While joins on the place of a row may use the buckets, which know less than the whole place."""
        return settings(self.spark, spark__sql__requireAllClusterKeysForCoPartition="false", **more)

    def _insert(self, rows: DataFrame, mode: str) -> None:
        with self._joining(spark__sql__sources__partitionOverwriteMode=mode):
            rows.select(*self._columns).write.insertInto(self.name, overwrite=True)

    def _repeats(self, rows: DataFrame) -> bool:
        """Whether a key may come twice. Unique keys are the rule; only digests of the keys travel to find that out,
        and a chance match costs time only. They are dealt like the rows, so that a task counts one bucket's share:
        counted where they are read, as many would be held as a file has keys."""
        digests = rows.select(F.xxhash64(*self.keys).alias("_digest")).repartition(self.buckets, "_digest")
        return not duplicate_keys(digests, ["_digest"]).isEmpty()

    def overwrite(self, items: DataFrame, checks: Sequence[Check] = ()) -> None:
        """Store these items and nothing else. Of several items with one key, one is kept."""
        with written(items.select(*self.schema.names), "items") as rows:
            self._check(rows, checks)
            if self._repeats(rows):
                rows = latest_per_key(rows, self.keys)
            self._insert(self._dealt(rows), "static")

    def shaped(self, rows: DataFrame, *more: Column) -> DataFrame:
        """The columns of the schema, NULL where ``rows`` has none, and ``more``."""
        values = [F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return rows.select(*values, *more)

    def _check(self, rows: DataFrame, checks: Sequence[Check]) -> None:
        complaints = [c for c in (check(rows) for check in checks) if c]
        if complaints:
            raise CheckFailed("; ".join(complaints))

    def upsert(self, changes: DataFrame, version: str | None = None, op: str | None = None, checks: Sequence[Check] = ()) -> None:
        """Replace whole items by key, or delete them where ``op`` is ``delete``; folders without a change stay.

        A change older than what is stored under its key is dropped, deleted items included, if the
        schema holds ``version``.
        """
        with written(latest_per_key(changes, self.keys, version), "changes") as last:
            self._apply(last, version, op, checks)

    def put(self, rows: DataFrame, op: str | None = None, checks: Sequence[Check] = ()) -> None:
        """``upsert`` for rows that are written already. Without ``op``, rows equal to the stored ones are passed over,
        and checks see the others only."""
        with contextlib.ExitStack() as until:
            if self._repeats(rows):
                rows = until.enter_context(written(latest_per_key(rows, self.keys), "changes"))
            self._apply(rows, None, op, checks, renew=op is None)

    def _apply(self, last: DataFrame, version: str | None, op: str | None, checks: Sequence[Check], renew: bool = False) -> None:
        gone = F.lit(False) if op is None else F.coalesce(F.col(op) == "delete", F.lit(False))
        rows = self.shaped(last, gone.alias("_out"))
        if not renew:
            self._check(rows.where("NOT _out").drop("_out"), checks)
        kept = {*self.keys, version}
        emptied = [_column(c) if c in kept else F.when(~F.col("_out"), _column(c)).alias(c) for c in self.schema.names]
        main = self._expanded(rows.select(*emptied, "_out"), [MAIN], F.col("_out")).select(*self._columns)
        version = version if version in self.schema.names else None
        if not self.indexes and not renew:
            self._put(main, version)
            return
        # indexes have to know which changes count and what they replace
        with contextlib.ExitStack() as until:
            with self._joining():
                moved = until.enter_context(written(self._moved(main, version, renew), "changes"))
            if renew:
                self._check(moved.where(F.col("_copy") == MAIN).select(*self.schema.names), checks)
            self._put(moved, version)

    def _put(self, moved: DataFrame, version: str | None) -> None:
        touched = moved.groupBy("_copy").agg(F.collect_set(PART).alias("parts")).collect()
        if touched:
            self._insert(self._merged(moved, {r["_copy"]: r["parts"] for r in touched}, version), "dynamic")

    def _moved(self, main: DataFrame, version: str | None, renew: bool = False) -> DataFrame:
        """The changes of all copies: new rows, and marks where an old row leaves its index key. With ``renew``, only of
        items that differ. One join by place, in which the changes are shuffled and the stored rows are not."""
        place, names = ["_key", "_slot", "_id"], self.schema.names
        near = F.col(PART).isin([r[0] for r in main.select(PART).distinct().collect()])
        row = F.struct(*names, "_gone")
        joined = main.select(*place, row.alias("_new")).join(self._stored().where(near).select(*place, row.alias("_old")), place, "left")
        old, new = (lambda c: F.col("_old")[c]), (lambda c: F.col("_new")[c])
        counts = F.lit(True)
        if version:
            counts = F.coalesce(old(version) <= new(version), F.lit(True))
        if renew:
            one, two = (F.struct(*[of(c).alias(c) for c in names]) for of in (old, new))
            alike = F.to_json(one) == F.to_json(two) if "map<" in self.schema.simpleString() else one.eqNullSafe(two)
            counts = counts & ~F.coalesce(~old("_gone") & ~new("_gone") & alike, F.lit(False))

        def marked(places: Column, left: bool) -> Column:
            return F.transform(places, lambda x: F.struct(x.alias("to"), F.lit(left).alias("left")))

        at = marked(F.array(F.struct(F.lit(MAIN).alias("_copy"), "_key", "_id")), False)
        if self.indexes:
            entered = F.filter(self._places([*self.indexes], new), lambda _: ~new("_gone"))
            left = F.array_except(F.filter(self._places([*self.indexes], old), lambda _: F.coalesce(~old("_gone"), F.lit(False))), entered)
            at = F.concat(at, marked(entered, False), marked(left, True))
        out = joined.where(counts).select("_new", "_old", F.explode(at).alias("_at"))
        values = [F.when(F.col("_at.left"), old(c)).otherwise(new(c)).alias(c) for c in names]
        out = out.select(*values, (F.col("_at.left") | new("_gone")).alias("_gone"), "_at.to.*")
        return self._slotted(out).select(*self._columns)

    def _merged(self, moved: DataFrame, touched: Mapping[str, Sequence[int]], version: str | None = None) -> DataFrame:
        """All rows of the touched folders after the changes, of which older ones than what is stored are
        dropped; the stored rows keep their buckets."""
        place = ["_copy", "_key", "_slot", "_id"]
        within = F.lit(False)
        for copy, parts in touched.items():
            within = within | ((F.col("_copy") == copy) & F.col(PART).isin(list(parts)))
        rest = [c for c in self._columns if c not in place]
        before = self.spark.table(self.name).where(within).select(*place, F.struct(*rest).alias("_old"))
        after = moved.select(*place, F.struct(*rest).alias("_new"))
        joined = before.join(after.hint("merge"), place, "full_outer")
        row = F.coalesce("_new", "_old")
        if version:
            row = F.when(F.col("_old")[version] > F.col("_new")[version], F.col("_old")).otherwise(row)
        return joined.select(*place, row.alias("_row")).select(*place, "_row.*")
