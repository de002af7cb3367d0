"""Marts that are kept up to date batch by batch.

`MartStore` holds, below one folder and behind one commit, what is needed to
apply a batch of raw feeds without going through the history again:

* ``latest``: the latest valid snapshot of every (hotel, reservation, source),
  bucketed by (hotel, reservation). A batch is exchanged to the buckets and
  merged with what stands there; the stored rows are read in place and never
  exchanged, however late or early a snapshot arrives. Snapshots of one source
  only ever add up, so the latest of each is enough; where flat rows add up to
  one booking (Nordic), its header is made again from all its rows.
* ``flat``: the flat rows of such bookings, one folder a batch.
* ``cells``: the sums of the fact, by month: rows, occupied rooms and exact
  revenue per (hotel, night).

A batch changes some reservations. The room-nights that they had are taken off
their cells and those that they have now are added; sums are exact, so a cell
is what a full rebuild makes of it, and one without rows ends. Months without a
changed cell keep their files.

All three are staged first and become visible with one commit: a batch counts
whole or not at all, and can be applied again after a failure. The inventory
decides which nights count; cells of another inventory would be wrong, so it
is remembered by fingerprint and `rebuild` makes the cells again from the
stored reservations.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.contract import counts_for_occupancy
from staylens.operators import adapters, kpis, reservations
from staylens.schemas import CONTRACT, CONTRACT_STATUSES
from staylens.session import ensure_checkpoint_dir
from staylens.sinks.files import NIGHT_ORDER, PARTITION_COLUMN
from staylens.sinks.versioned import VERSION_COLUMN, Commit, CommitLog, VersionedTable, by_month, drop_versions
from staylens.sources.feeds import empty_feed
from staylens.sources.landing import COMPACT, remove, shuffles_dropped, small_splits

KEY = ["hotel_id", "reservation_id"]
SOURCE_KEY = [*KEY, "source_system"]
SNAPSHOT = [c for c in CONTRACT.names if c != "is_valid"]
CELLS = "hotel_id string, night date, n_rows long, occupied_rooms long, revenue decimal(38,6)"


@dataclass(frozen=True)
class Applied:
    """What a batch did: the commit it made and the months whose files it wrote."""

    number: int
    months: tuple[str, ...]


class MartStore:
    """Reservations and fact below ``path``, with the cleaned ``inventory``
    (hotel_id, room_type_id, quantity) that the cells are made for."""

    def __init__(self, spark: SparkSession, path: str, inventory: DataFrame):
        self.spark, self.path, self.inventory = spark, path.rstrip("/"), inventory
        self.log = CommitLog(spark, self.path)
        self._registered: dict[str, str] = {}

    # --- state ----------------------------------------------------------------
    def _state(self, number: int | None = None) -> tuple[int, dict]:
        numbers = self.log.numbers()
        number = number if number is not None else numbers[-1] if numbers else 0
        return number, self.log.read(number) if number else {}

    def _table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}/{name}")

    def _commit_of(self, state: dict, name: str) -> Commit | None:
        return Commit.of(0, state[name]) if state else None

    @cached_property
    def _flat_schema(self) -> T.StructType:
        """Columns of the flat rows; the scale of an amount shows in its text,
        so types are those of the projection."""
        return adapters.nordic_nights(empty_feed(self.spark, "nordic")).schema

    def _plain(self, state: dict, name: str, schema) -> DataFrame:
        commit = self._commit_of(state, name)
        if commit is None:
            return self.spark.createDataFrame([], schema)
        return self._table(name).read_folders(commit, commit.folders.values())

    def _latest(self, state: dict) -> DataFrame:
        """The stored snapshots as a bucketed table of the catalog (registered
        on first use, its files stay where they are)."""
        if not state:
            return self.spark.createDataFrame([], T.StructType([CONTRACT[c] for c in SNAPSHOT]))
        folder, buckets = state["latest"]["folder"], state["latest"]["buckets"]
        if folder not in self._registered:
            name = f"staylens_store_{uuid.uuid4().hex[:12]}"
            schema = self.spark._jsparkSession.parseDataType(T.StructType([CONTRACT[c] for c in SNAPSHOT]).json()).toDDL()
            self.spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({', '.join(KEY)}) INTO {buckets} BUCKETS "
                           f"LOCATION '{self.path}/latest/{folder}'")
            self._registered[folder] = name
        return self.spark.table(self._registered[folder])

    def close(self) -> None:
        """Take the tables out of the catalog; their files stay."""
        for name in self._registered.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._registered.clear()

    # --- reading ----------------------------------------------------------------
    def kept(self, number: int | None = None) -> DataFrame:
        """The latest snapshot of every reservation."""
        return _winners(self._latest(self._state(number)[1]))

    def flat_items(self, number: int | None = None) -> DataFrame:
        """The line items of bookings that have flat rows."""
        return adapters.nordic_line_items(self._plain(self._state(number)[1], "flat", self._flat_schema))

    def cells(self, number: int | None = None) -> DataFrame:
        return self._plain(self._state(number)[1], "cells", CELLS)

    def fact(self, capacity: DataFrame, number: int | None = None) -> DataFrame:
        """The daily KPI fact, a projection of the stored sums."""
        return kpis.kpis_of(self.cells(number), capacity)

    # --- writing ----------------------------------------------------------------
    def apply(self, feeds: dict[str, DataFrame]) -> Applied:
        """Bring the store up to date with a batch of raw feeds, late or
        repeated snapshots included."""
        number, state = self._state()
        self._check_inventory(state)
        aside = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/incremental/{uuid.uuid4().hex}"
        try:
            with shuffles_dropped(self.spark):
                return self._apply(feeds, number, state, aside)
        finally:
            remove(self.spark, aside)

    def _apply(self, feeds: dict[str, DataFrame], number: int, state: dict, aside: str) -> Applied:
        def written(df: DataFrame, name: str) -> DataFrame:
            df.write.options(**COMPACT).parquet(f"{aside}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{aside}/{name}")

        old_flat = self._plain(state, "flat", self._flat_schema)
        new_rows = written(adapters.nordic_nights(feeds["nordic"]).where("hotel_id IS NOT NULL AND reservation_id IS NOT NULL")
                           .select(*self._flat_schema.names), "flat") if "nordic" in feeds else old_flat.limit(0)
        with small_splits(self.spark):
            changes = written(self._changes(feeds, old_flat, new_rows), "changes")
        keys = written(changes.select(*KEY).distinct(), "keys")

        # the merged snapshots, staged; then what the changed reservations were and are
        stored = self._latest(state)
        folder, buckets, merged = self._stage_latest(stored if state else None, changes)
        remove(self.spark, f"{aside}/changes")
        old, new = (written(_winners(t.join(keys, KEY, "left_semi")), name) for t, name in ((stored, "old"), (merged, "new")))
        touched = written(old_flat.join(keys, KEY, "left_semi"), "touched")
        before = reservations.reservation_nights(old, self.inventory, adapters.nordic_line_items(touched))
        after = reservations.reservation_nights(new, self.inventory, adapters.nordic_line_items(touched.unionByName(new_rows)))
        delta = written(by_month(_sums(before, -1).unionByName(_sums(after, 1)).groupBy("hotel_id", "night").agg(
            *[F.sum(c).cast(t).alias(c) for c, t in (("n_rows", "long"), ("occupied_rooms", "long"), ("revenue", "decimal(38,6)"))])
            .where("n_rows <> 0 OR occupied_rooms <> 0 OR revenue <> 0"), PARTITION_COLUMN), "delta")
        for name in ("old", "new", "touched"):
            remove(self.spark, f"{aside}/{name}")
        months = sorted(r[0] for r in delta.select(PARTITION_COLUMN).distinct().collect())

        state = dict(state) or {"inventory": self._inventory_mark(), "cells": None, "flat": None}
        state["latest"] = {"folder": folder, "buckets": buckets}
        state["cells"] = self._stage_cells(state["cells"], delta, months)
        state["flat"] = self._stage_flat(state["flat"], new_rows)
        self.log.publish(number + 1, state)
        return Applied(number + 1, tuple(months))

    def _changes(self, feeds: dict[str, DataFrame], old_flat: DataFrame, new_rows: DataFrame) -> DataFrame:
        """The batch as snapshots: the latest valid one of every (reservation,
        source), and the new header of every booking with flat rows in it."""
        nested = {s: df for s, df in feeds.items() if s not in adapters.FLAT_ITEMS}
        rows = old_flat.join(new_rows.select(*KEY).distinct(), KEY, "left_semi").unionByName(new_rows)
        out = adapters.regroup_nordic(rows)
        if nested:
            out = out.unionByName(reservations.latest_snapshots(adapters.unified_feed(nested, fingerprint=False), SOURCE_KEY))
        return out

    def _stage_latest(self, stored: DataFrame | None, changes: DataFrame) -> tuple[str, int, DataFrame]:
        """The merged snapshots as a table of their own. What stands already and
        what is new are written one after the other, so that the changes lie on
        disk as shuffle files once at a time."""
        folder = f"{VERSION_COLUMN}={uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"staylens_store_{uuid.uuid4().hex[:12]}"
        with _stored_in_place(self.spark):
            parts = [_added(None, changes, buckets)] if stored is None else [_merged(stored, changes), _added(stored, changes, buckets)]
            for part in parts:
                part.write.bucketBy(buckets, *KEY).options(**COMPACT).option("path", f"{self.path}/latest/{folder}").mode("append").saveAsTable(name)
        self._registered[folder] = name
        return folder, buckets, self.spark.table(name)

    def _stage_cells(self, now: dict | None, delta: DataFrame, months: list[str]) -> dict:
        """Cells with ``delta`` added; only the folders of ``months`` are read
        and written again."""
        table = self._table("cells")
        if now is None:
            return table.stage(delta.where("n_rows > 0"), PARTITION_COLUMN, NIGHT_ORDER, now=Commit(0, T.StructType(), None, {})).content()
        commit = Commit.of(0, now)
        if not months:
            return now
        stored = table.read_folders(commit, [f for m, f in commit.folders.items() if m in months])
        names = [c for c in stored.columns if c != PARTITION_COLUMN]
        added = stored.select(*names).unionByName(delta.select(*names)).groupBy("hotel_id", "night").agg(
            *[F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in names[2:]]).where("n_rows > 0")
        return table.stage_partitions(by_month(added, PARTITION_COLUMN), months, NIGHT_ORDER, now=commit).content()

    def _stage_flat(self, now: dict | None, rows: DataFrame) -> dict:
        staged = self._table("flat").stage(rows, now=Commit(0, T.StructType(), None, {})).content()
        folders = {} if now is None else now["folders"]
        return staged | {"folders": folders | {str(len(folders)): staged["folders"][""]}}

    # --- inventory ----------------------------------------------------------------
    def _inventory_mark(self) -> list:
        """Count and commutative hash of the sellable rooms."""
        rooms = self.inventory.select("hotel_id", "room_type_id").distinct()
        row = rooms.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hotel_id", "room_type_id").cast("decimal(38,0)")).alias("h")).first()
        return [row["n"], str(row["h"])]

    def _check_inventory(self, state: dict) -> None:
        if state and state["inventory"] != self._inventory_mark():
            raise ValueError("the sellable rooms have changed since the cells were made: rebuild() first")

    def rebuild(self) -> Applied:
        """Make all cells again, for the inventory of this store."""
        number, state = self._state()
        nights = reservations.reservation_nights(self.kept(), self.inventory, self.flat_items())
        cells = by_month(_sums(nights, 1), PARTITION_COLUMN)
        staged = self._table("cells").stage(cells, PARTITION_COLUMN, NIGHT_ORDER, now=Commit(0, T.StructType(), None, {}))
        self.log.publish(number + 1, state | {"cells": staged.content(), "inventory": self._inventory_mark()})
        return Applied(number + 1, tuple(sorted(staged.folders)))

    def vacuum(self, keep: int = 1) -> None:
        """Delete what none of the last ``keep`` commits names. Not to be run
        while a writer works or a reader holds an older commit."""
        numbers = self.log.numbers()
        states = [self.log.read(n) for n in numbers[-keep:]]
        for name in ("cells", "flat", "latest"):
            kept = {s[name]["folder"] for s in states} if name == "latest" else {f for s in states for f in s[name]["folders"].values()}
            drop_versions(self.log, self.log.hadoop_path(name), kept)
            for folder in set(self._registered) - kept if name == "latest" else ():
                self.spark.sql(f"DROP TABLE IF EXISTS {self._registered.pop(folder)}")
        for n in numbers[:-keep]:
            self.log.forget(n)


@contextmanager
def _stored_in_place(spark: SparkSession):
    """Joins on more columns than a table is bucketed by read it in place; by
    default Spark exchanges both sides of them."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def merge_latest(stored: DataFrame, changes: DataFrame, buckets: int | None = None) -> DataFrame:
    """``stored`` snapshots (one a reservation and source) with ``changes`` (as
    many at most): of two of a nested source the one that precedes stays, and a
    header of flat rows takes the place of the one before; what is not valid
    goes. On a stored table that is bucketed by reservation only the changes
    are exchanged; with ``buckets`` new reservations are dealt to them, so that a
    bucket gets one file of them and not one a task."""
    return _merged(stored, changes).unionByName(_added(stored, changes, buckets))


def _merged(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """The stored snapshots, with those in their place that replace them."""
    new = changes.select(*SOURCE_KEY, F.struct(*SNAPSHOT, "is_valid").alias("_new"))
    old = stored.select(*SOURCE_KEY, F.struct(*SNAPSHOT).alias("_old"))
    flat = F.col("source_system").isin(*adapters.FLAT_ITEMS)
    replaced = F.col("_new").isNotNull() & (flat | reservations.precedes(F.col("_new"), F.col("_old")))
    both = old.join(new, SOURCE_KEY, "left").where(~replaced | F.col("_new.is_valid"))
    return both.select(F.when(replaced, F.struct(*[F.col(f"_new.{c}").alias(c) for c in SNAPSHOT])).otherwise(F.col("_old")).alias("s")).select("s.*")


def _added(stored: DataFrame | None, changes: DataFrame, buckets: int | None) -> DataFrame:
    """The changes that nothing stands for yet (None: nothing at all)."""
    added = changes.where("is_valid")
    if stored is not None:
        added = added.join(stored.select(*SOURCE_KEY), SOURCE_KEY, "left_anti")
    added = added.select(*SNAPSHOT)
    return added.repartition(buckets, *KEY) if buckets else added


def _winners(latest: DataFrame) -> DataFrame:
    """The latest snapshot of each reservation, whichever source it is of."""
    order = Window.partitionBy(*KEY).orderBy(*reservations.snapshot_order())
    return (latest.where(F.col("status").isin(*CONTRACT_STATUSES)).withColumn("_rn", F.row_number().over(order)).where("_rn = 1")
            .select(*reservations.KEPT_COLUMNS, counts_for_occupancy().alias("counts_for_occupancy")))


def _sums(nights: DataFrame, sign: int) -> DataFrame:
    """The cells that room-nights add up to, times ``sign``."""
    return nights.groupBy("hotel_id", "night").agg(
        (F.count(F.lit(1)) * sign).alias("n_rows"), (F.count_if(F.col("counts_for_occupancy")) * sign).alias("occupied_rooms"),
        (F.sum("total_net_revenue") * sign).cast("decimal(38,6)").alias("revenue"))
