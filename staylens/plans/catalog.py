"""Named queries over the driver's benchmark tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; the first one on
a folder lands the feeds and builds the marts. Inputs are the raw feeds and seeds that ``staylens.sources.testdata`` derives from the
given tables; every query runs over all of them. Nested values are flattened
(item counts and an engine-neutral fingerprint) and money is served as DOUBLE
so results compare cell by cell with a SQL engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators import adapters, checks, quality, reservations
from staylens.operators.kpis import FACT_COLUMNS
from staylens.plans.incremental import MartStore
from staylens.plans.marts import Marts
from staylens.schemas import CONTRACT_STATUSES, NATIVE_EVENT
from staylens.session import small_batches
from staylens.sources import testdata
from staylens.sources.envelope import read_records
from staylens.sources.feeds import NATIVE_ENVELOPE_KEY
from staylens.sources.landing import COMPACT, SORTED_BYTES, land, landing_root, remove, shuffles_dropped, small_splits

Query = Callable[[SparkSession, str], DataFrame]

_MARTS: dict[tuple[str, str], Marts] = {}


def marts_for(spark: SparkSession, sf_dir: str) -> Marts:
    """The marts over one data folder, built once per session, as a serving
    job builds them: the latest snapshots and the fact are materialized on
    first use (checkpoints in ``spark.checkpoint.dir``) and every later query
    on that folder reads them, as do the dimension size proofs."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MARTS:
        _MARTS[key] = _build_marts(spark, sf_dir)
    return _MARTS[key]


def landed_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw feeds projected from the driver tables, landed once per
    session and folder (all-text Parquet), as the raw landing step does. The
    joined events that they are projected from end with that."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        root = landing_root(spark, f"{sf_dir}-{uuid.uuid4().hex}")
        with shuffles_dropped(spark):
            _LANDED[key] = land(testdata.feeds(spark, sf_dir, f"{root}/events"), root)
        remove(spark, f"{root}/events")
        _ROOTS.append((spark, root))
    return _LANDED[key]


_LANDED: dict[tuple[str, str], dict[str, DataFrame]] = {}
_ROOTS: list[tuple[SparkSession, str]] = []


_STORES: dict[tuple[str, str], MartStore] = {}


def store_for(spark: SparkSession, sf_dir: str) -> MartStore:
    """A store that got the feeds of one data folder in three batches, built
    once per session. Which batch a row comes with does not depend on its time,
    so snapshots come late and bookings in parts."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        root = landing_root(spark, f"{sf_dir}-store-{uuid.uuid4().hex}")
        store = MartStore(spark, root, marts_for(spark, sf_dir).inventory)
        feeds = landed_feeds(spark, sf_dir)
        for batch in range(3):
            store.apply({s: df.where(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == batch) for s, df in feeds.items()})
            store.vacuum()
        _STORES[key] = store
        _ROOTS.append((spark, root))
    return _STORES[key]


#: Bytes of the landed native feed, for every task that runs at a time, that
#: stand as enveloped documents together; as JSON they are some fifteen times as much.
SHARE_BYTES = SORTED_BYTES


def envelopes(feed: DataFrame, path: str) -> None:
    """A native feed as enveloped JSON documents in the folder ``path``, one a partition."""
    def wrap(batches):
        before = '{"data": ['
        for batch in batches:
            lines = []
            for record in batch["value"].to_pylist():
                lines, before = [*lines, before, record], ","
            yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": pa.array(['{"data": []}' if before != "," else "]}"], pa.string())})

    feed.select(F.to_json(F.struct(*feed.columns), {"ignoreNullFields": "false"}).alias("value")).mapInArrow(wrap, "value string").write.text(path)


def shares(spark: SparkSession, files: list[str], most: int) -> list[list[str]]:
    """``files`` in lists of at most ``most`` bytes, or one file."""
    conf, new_path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out, held = [], 0
    for file in sorted(files):
        at = new_path(file)
        size = at.getFileSystem(conf).getFileStatus(at).getLen()
        if not out or held + size > most:
            out, held = [*out, []], 0
        out[-1].append(file)
        held += size
    return out


def records_of_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the native feed, written as enveloped documents and read
    from them in ranges, one share of its files after the other: the documents
    of a share, which are as JSON many times as large as the feed, and what was
    cut from them end when its records are written."""
    root = landing_root(spark, f"{sf_dir}-envelopes-{uuid.uuid4().hex}")
    _ROOTS.append((spark, root))
    feed = landed_feeds(spark, sf_dir)["native"]
    read = spark.read.schema(feed.schema)
    with small_splits(spark), small_batches(spark), shuffles_dropped(spark):
        for i, files in enumerate(shares(spark, feed.inputFiles(), SHARE_BYTES * spark.sparkContext.defaultParallelism)):
            envelopes(read.parquet(*files), f"{root}/docs-{i}")
            records = read_records(spark, f"{root}/docs-{i}", NATIVE_ENVELOPE_KEY, NATIVE_EVENT, f"{root}/chunks-{i}")
            records.write.mode("append").options(**COMPACT).parquet(f"{root}/records")
            remove(spark, f"{root}/docs-{i}")
            remove(spark, f"{root}/chunks-{i}")
    return spark.read.schema(NATIVE_EVENT).parquet(f"{root}/records")


def reset() -> None:
    """Delete built marts and landed feeds: the next query rebuilds them."""
    for store in _STORES.values():
        store.close()
    _STORES.clear()
    for marts in _MARTS.values():
        marts.drop()
    for spark, root in _ROOTS:
        remove(spark, root)
    _ROOTS.clear()
    _LANDED.clear()
    _MARTS.clear()


def _build_marts(spark: SparkSession, sf_dir: str) -> Marts:
    return Marts(
        feeds=landed_feeds(spark, sf_dir),
        inventory_raw=testdata.inventory_raw(spark, sf_dir),
        manifest_raw=testdata.manifest_raw(spark, sf_dir),
        market_raw=testdata.market_raw(spark, sf_dir),
        as_of=testdata.AS_OF,
        materialize=True,
    )


def _flat_contract(df: DataFrame, with_fingerprint: bool = True) -> DataFrame:
    cols = ["source_system", "hotel_id", "reservation_id", "status", "arrival_date",
            "departure_date", "created_at", "updated_at"]
    extra = [F.col("n_items").cast("int").alias("n_items")]
    if with_fingerprint:
        extra.append(F.col("items_md5"))
    rest = [c for c in ("is_valid", "counts_for_occupancy") if c in df.columns]
    return df.select(*cols, *extra, *rest)


def _money(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


# --- adapters ----------------------------------------------------------------
def q_adapter_native(spark, sf_dir):
    return _flat_contract(adapters.adapt_native(landed_feeds(spark, sf_dir)["native"]))


def q_enveloped_feed(spark, sf_dir):
    """The native feed written as enveloped documents, read in ranges."""
    return _flat_contract(adapters.adapt_native(records_of_envelopes(spark, sf_dir)))


def q_adapter_cloud(spark, sf_dir):
    return _flat_contract(adapters.adapt_cloud(landed_feeds(spark, sf_dir)["cloud"]))


def q_adapter_nordic_status(spark, sf_dir):
    n = adapters.nordic_nights(landed_feeds(spark, sf_dir)["nordic"])
    return n.select("hotel_id", "reservation_id", "status", "arrival_date", "departure_date",
                    "stay_night", "room_type_id")


def q_adapter_nordic_vat(spark, sf_dir):
    n = adapters.nordic_nights(landed_feeds(spark, sf_dir)["nordic"])
    return n.select("hotel_id", "reservation_id", "stay_night", "room_type_id",
                    *[_money(c) for c in ("room_gross", "room_net", "fnb_gross", "fnb_net")])


def q_adapter_nordic_regroup(spark, sf_dir):
    return _flat_contract(adapters.adapt_nordic(landed_feeds(spark, sf_dir)["nordic"], keyless_apart=False))


def q_validity_flags(spark, sf_dir):
    u = marts_for(spark, sf_dir).unified
    return u.groupBy("source_system", "status", "is_valid").agg(F.count(F.lit(1)).alias("n_events"))


# --- dimensions --------------------------------------------------------------
def q_clean_inventory(spark, sf_dir):
    return marts_for(spark, sf_dir).inventory


def q_clean_manifest(spark, sf_dir):
    return marts_for(spark, sf_dir).manifest


def q_clean_market(spark, sf_dir):
    return marts_for(spark, sf_dir).market


def q_hotel_capacity(spark, sf_dir):
    return marts_for(spark, sf_dir).capacity


# --- reservation layer -------------------------------------------------------
def q_unified_feed(spark, sf_dir):
    return _flat_contract(marts_for(spark, sf_dir).unified)


def q_dedup_latest(spark, sf_dir):
    return _flat_contract(marts_for(spark, sf_dir).kept)


def _items(m: Marts) -> DataFrame:
    return reservations.line_items(m.kept, m.flat_items)


def q_line_item_validation(spark, sf_dir):
    items = _items(marts_for(spark, sf_dir))
    return items.select("hotel_id", "reservation_id", "room_type_id", "sd_start", "sd_end",
                        _money("room_net"), _money("fnb_net"),
                        reservations.valid_line_item().alias("is_valid_item"))


def _stocked(m: Marts) -> DataFrame:
    return reservations.in_inventory(reservations.validated_line_items(m.kept, m.flat_items), m.inventory)


def q_inventory_filter(spark, sf_dir):
    s = _stocked(marts_for(spark, sf_dir))
    rev = F.coalesce(F.col("room_net"), F.lit(0)) + F.coalesce(F.col("fnb_net"), F.lit(0))
    return s.select("hotel_id", "reservation_id", "room_type_id", "sd_start", "sd_end",
                    rev.cast("double").alias("total_net_revenue"))


def q_night_explosion(spark, sf_dir):
    n = reservations.expand_nights(_stocked(marts_for(spark, sf_dir)))
    return n.select("hotel_id", "reservation_id", "night", "status", "room_type_id",
                    _money("total_net_revenue"))


def q_one_room_night(spark, sf_dir):
    n = marts_for(spark, sf_dir).nights
    return n.select(*[c for c in reservations.NIGHT_COLUMNS if c != "total_net_revenue"],
                    _money("total_net_revenue"))


# --- KPI marts ---------------------------------------------------------------
def q_fct_daily_kpis(spark, sf_dir):
    return marts_for(spark, sf_dir).fact.select(*FACT_COLUMNS)


def q_kpi_report(spark, sf_dir):
    return marts_for(spark, sf_dir).report(testdata.REPORT_HOTEL, testdata.REPORT_FROM,
                                           testdata.REPORT_TO)


# --- marts kept up batch by batch ----------------------------------------------
def q_incremental_kept(spark, sf_dir):
    """Latest snapshots after three batches, merged onto the stored ones."""
    return _flat_contract(store_for(spark, sf_dir).kept())


def q_incremental_fact(spark, sf_dir):
    """The fact after three batches, from cells that were retracted and added to."""
    return store_for(spark, sf_dir).fact(marts_for(spark, sf_dir).capacity).select(*FACT_COLUMNS)


# --- data-quality marts --------------------------------------------------------
def q_event_watermarks(spark, sf_dir):
    return marts_for(spark, sf_dir).watermarks


def q_data_freshness(spark, sf_dir):
    return marts_for(spark, sf_dir).freshness


def q_availability_spine(spark, sf_dir):
    return marts_for(spark, sf_dir).availability.select("hotel_id", "night", "is_missing_day")


def q_data_availability(spark, sf_dir):
    return marts_for(spark, sf_dir).availability


def q_source_control(spark, sf_dir):
    return marts_for(spark, sf_dir).control.drop("net_revenue_exact")


def q_reconciliation(spark, sf_dir):
    return marts_for(spark, sf_dir).reconciliation.drop("net_revenue_exact", "fct_net_revenue_exact")


def q_market_blend(spark, sf_dir):
    return marts_for(spark, sf_dir).market_blend


# --- checks ------------------------------------------------------------------
def q_check_not_null(spark, sf_dir):
    return checks.not_null(marts_for(spark, sf_dir).unified, "updated_at",
                           keep=["source_system", "hotel_id", "reservation_id"])


def q_check_unique_grain(spark, sf_dir):
    return checks.unique(marts_for(spark, sf_dir).unified, ["hotel_id", "reservation_id"])


def q_check_accepted_values(spark, sf_dir):
    return checks.accepted_values(marts_for(spark, sf_dir).unified, "status", CONTRACT_STATUSES,
                                  keep=["source_system", "hotel_id", "reservation_id", "status"])


def q_check_relationships(spark, sf_dir):
    m = marts_for(spark, sf_dir)
    items = reservations.validated_line_items(m.kept, m.flat_items)
    return checks.relationships(items, "room_type_id", m.inventory, "room_type_id",
                                keep=["hotel_id", "reservation_id", "room_type_id"])


# The checks below hold on the marts as built, which `check_suite` shows. Here
# each one reads the marts with a fault put in, so that it has rows to find.
def q_check_fact_invariants(spark, sf_dir):
    """A fact that books revenue of the first of a month as a refund, counts
    one room less a day, and has a rate whether a room is taken or not."""
    fact = marts_for(spark, sf_dir).fact
    faulty = fact.withColumns({
        "total_net_revenue": F.when(F.dayofmonth("night") == 1, -F.col("total_net_revenue")).otherwise(F.col("total_net_revenue")),
        "occupancy_percentage": F.when(F.col("occupied_rooms") == 0, F.lit(-1.0)).otherwise(F.col("occupancy_percentage")),
        "occupied_rooms": F.col("occupied_rooms") - 1})
    return checks.fact_invariants(faulty)


def q_check_dedup_latest(spark, sf_dir):
    """The earliest snapshot kept instead of the latest."""
    u = marts_for(spark, sf_dir).unified
    earliest = u.where("is_valid").groupBy("hotel_id", "reservation_id").agg(F.min("updated_instant").alias("updated_instant"))
    return checks.dedup_keeps_latest(earliest, u)


def _without_cloud(m: Marts) -> DataFrame:
    return quality.reconciliation(m.control.where(F.col("source_system") != "cloud"), m.fact)


def q_check_reconciliation_gate(spark, sf_dir):
    """The cloud source missing from the control totals."""
    return checks.reconciliation_gate(_without_cloud(marts_for(spark, sf_dir)))


def q_check_availability_bounds(spark, sf_dir):
    """Hotel H0 without capacity."""
    m = marts_for(spark, sf_dir)
    return checks.availability_bounds(quality.data_availability(m.fact, m.capacity.where(F.col("hotel_id") != "H0")))


def q_check_freshness_sla(spark, sf_dir):
    """The stale flags of the native source turned round."""
    f = marts_for(spark, sf_dir).freshness
    flipped = F.when(F.col("source_system") == "native", ~F.col("is_stale")).otherwise(F.col("is_stale"))
    return checks.freshness_sla(f.withColumn("is_stale", flipped))


def q_check_source_totals(spark, sf_dir):
    """The cloud source missing from the control totals."""
    return checks.source_totals_match_fact(_without_cloud(marts_for(spark, sf_dir)))


def q_check_suite(spark, sf_dir):
    from staylens.plans.suite import run_suite
    m = marts_for(spark, sf_dir)
    return run_suite(m, m.report(testdata.REPORT_HOTEL, testdata.REPORT_FROM, testdata.REPORT_TO))


def q_table_diff(spark, sf_dir):
    """The stored fact against the fact recomputed by the control path, which
    here lacks the first of every month and counts hotel H1 one room too high:
    unlike values, rows of one side only, and the unlike numbers of rows."""
    m = marts_for(spark, sf_dir)
    cells = ["hotel_id", "night", "occupied_rooms", F.col("net_revenue_exact").cast("decimal(38,6)").alias("net_revenue")]
    recomputed = quality.control_daily(m.control_cells).select(*cells)
    faulty = recomputed.where(F.dayofmonth("night") != 1).withColumn(
        "occupied_rooms", F.col("occupied_rooms") + F.when(F.col("hotel_id") == "H1", 1).otherwise(0))
    return checks.table_diff(m.fact.select(*cells), faulty, ["hotel_id", "night"])


QUERIES: dict[str, Query] = {
    "adapter_native": q_adapter_native,
    "adapter_nordic_status": q_adapter_nordic_status,
    "adapter_nordic_vat": q_adapter_nordic_vat,
    "adapter_nordic_regroup": q_adapter_nordic_regroup,
    "adapter_cloud": q_adapter_cloud,
    "enveloped_feed": q_enveloped_feed,
    "validity_flags": q_validity_flags,
    "clean_inventory": q_clean_inventory,
    "clean_manifest": q_clean_manifest,
    "clean_market": q_clean_market,
    "unified_feed": q_unified_feed,
    "dedup_latest": q_dedup_latest,
    "line_item_validation": q_line_item_validation,
    "inventory_filter": q_inventory_filter,
    "night_explosion": q_night_explosion,
    "one_room_night": q_one_room_night,
    "hotel_capacity": q_hotel_capacity,
    "fct_daily_kpis": q_fct_daily_kpis,
    "kpi_report": q_kpi_report,
    "incremental_kept": q_incremental_kept,
    "incremental_fact": q_incremental_fact,
    "event_watermarks": q_event_watermarks,
    "data_freshness": q_data_freshness,
    "availability_spine": q_availability_spine,
    "data_availability": q_data_availability,
    "source_control": q_source_control,
    "reconciliation": q_reconciliation,
    "market_blend": q_market_blend,
    "check_not_null": q_check_not_null,
    "check_unique_grain": q_check_unique_grain,
    "check_accepted_values": q_check_accepted_values,
    "check_relationships": q_check_relationships,
    "check_fact_invariants": q_check_fact_invariants,
    "check_dedup_latest": q_check_dedup_latest,
    "check_reconciliation_gate": q_check_reconciliation_gate,
    "check_availability_bounds": q_check_availability_bounds,
    "check_freshness_sla": q_check_freshness_sla,
    "check_source_totals": q_check_source_totals,
    "check_suite": q_check_suite,
    "table_diff": q_table_diff,
}
