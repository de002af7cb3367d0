"""The mart DAG as plain function composition.

raw feeds -> adapters -> unified feed -> latest snapshot -> nights -> fact
-> {report, availability, market blend, reconciliation}; latest snapshot ->
{event watermarks -> freshness, per-source control -> reconciliation}.

Every attribute is a DataFrame, lazy unless ``materialize=True``: then taking
one runs the jobs that write the shared intermediates once into the session's ``spark.checkpoint.dir``
(shared storage on a cluster):

* the unified feed as a Parquet table, unless ``materialize_unified`` is
  off, when it is first asked for (read by the contract checks, which then read
  only the columns they test, and by a later dedup; for the dedup alone the copy
  of the whole feed is not worth writing);
* the latest snapshots as a table bucketed by (hotel_id, reservation_id)
  (read by nights, watermarks, the control path and the dedup check); the
  bucketing carries the dedup's partitioning, so the night expansion, the
  one-room-per-night rank and the control aggregate need no shuffle;
* the daily fact as a table partitioned by month and clustered by (hotel_id,
  night): a report opens the files of its months that hold its hotel.

That cuts lineage: a lost executor re-reads a materialized table instead of
recomputing from the raw feeds.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import cached_property
import uuid

from pyspark.sql import DataFrame

from staylens.operators import adapters, dimensions, kpis, quality, reservations
from staylens.session import ensure_checkpoint_dir
from staylens.sources.landing import remove, small_splits, write_bucketed, write_by_month, write_table


@dataclass
class Marts:
    feeds: dict[str, DataFrame]
    inventory_raw: DataFrame
    manifest_raw: DataFrame | None = None
    market_raw: DataFrame | None = None
    as_of: datetime | None = None
    materialize: bool = False
    materialize_unified: bool = True

    @cached_property
    def _tables(self) -> str:
        """This build's own folder for everything it materializes."""
        spark = next(iter(self.feeds.values())).sparkSession
        return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"

    def drop(self) -> None:
        """Delete what this build materialized; its frames end with it."""
        if self.materialize:
            remove(next(iter(self.feeds.values())).sparkSession, self._tables)

    def _keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write a small shared frame once when materializing (seeds and
        per-source totals are tables, as in a warehouse)."""
        if not self.materialize:
            return df
        return write_table(df, f"{self._tables}/{label}-{uuid.uuid4().hex[:12]}")

    # --- dimensions -------------------------------------------------------
    @cached_property
    def inventory(self) -> DataFrame:
        return self._keep(dimensions.clean_inventory(self.inventory_raw), "inventory")

    @cached_property
    def capacity(self) -> DataFrame:
        return dimensions.hotel_capacity(self.inventory)

    @cached_property
    def manifest(self) -> DataFrame:
        return self._keep(dimensions.clean_manifest(self.manifest_raw), "manifest")

    @cached_property
    def market(self) -> DataFrame:
        return self._keep(dimensions.clean_market(self.market_raw), "market")

    # --- reservation layer ------------------------------------------------
    @cached_property
    def unified(self) -> DataFrame:
        unified = adapters.unified_feed(self.feeds)
        if not (self.materialize and self.materialize_unified):
            return unified
        return write_table(unified, f"{self._tables}/unified-{uuid.uuid4().hex[:12]}")

    @cached_property
    def kept(self) -> DataFrame:
        # without the copy of the unified feed (no check has asked for it) the
        # fingerprint is made of the latest snapshots only
        unified = self.unified if "unified" in self.__dict__ else adapters.unified_feed(self.feeds, fingerprint=False)
        kept = reservations.dedup_latest(unified)
        if not self.materialize:
            return kept
        with small_splits(kept.sparkSession):
            return write_bucketed(kept, self._tables, "kept", ["hotel_id", "reservation_id"])

    @cached_property
    def flat_items(self) -> DataFrame | None:
        """Line items that are rows of their own (a narrow projection)."""
        return adapters.flat_items(self.feeds)

    @cached_property
    def nights(self) -> DataFrame:
        return reservations.reservation_nights(self.kept, self.inventory, self.flat_items)

    # --- marts --------------------------------------------------------------
    @cached_property
    def fact(self) -> DataFrame:
        fact = kpis.daily_kpis(self.nights, self.capacity)
        if not self.materialize:
            return fact
        return write_by_month(fact, f"{self._tables}/fact-{uuid.uuid4().hex[:12]}")

    def report(self, hotel_id: str, from_date, to_date) -> DataFrame:
        return kpis.kpi_report(self.fact, hotel_id, from_date, to_date)

    @cached_property
    def watermarks(self) -> DataFrame:
        return quality.event_watermarks(self.kept)

    @cached_property
    def freshness(self) -> DataFrame:
        return quality.data_freshness(self.watermarks, self.manifest, self.as_of)

    @cached_property
    def availability(self) -> DataFrame:
        return quality.data_availability(self.fact, self.capacity)

    @cached_property
    def control_cells(self) -> DataFrame:
        """The control path per source, hotel and night, computed once."""
        return self._keep(quality.control_cells(self.kept, self.inventory, self.flat_items), "control")

    @cached_property
    def control(self) -> DataFrame:
        return quality.source_control(self.control_cells)

    @cached_property
    def reconciliation(self) -> DataFrame:
        return quality.reconciliation(self.control, self.fact)

    @cached_property
    def market_blend(self) -> DataFrame:
        return quality.market_blend(self.fact, self.market)
