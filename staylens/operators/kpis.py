"""The daily KPI fact (grain hotel, night) and the served report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.measures import adr, money_to_double, percent_2dp

FACT_COLUMNS = ["hotel_id", "night", "occupied_rooms", "total_rooms", "occupancy_percentage",
                "total_net_revenue", "adr"]
#: The unrounded revenue kept beside the served one, for reconciling.
EXACT_COLUMN = "net_revenue_exact"
MONTH_COLUMN = "night_month"
REPORT_COLUMNS = ["NIGHT_OF_STAY", "OCCUPANCY_PERCENTAGE", "TOTAL_NET_REVENUE", "ADR"]


def daily_aggregate(nights: DataFrame) -> DataFrame:
    """Occupied rooms (all statuses but cancelled) and unrounded net revenue
    (every status) per hotel and night. Partial aggregation runs before the
    shuffle, so a hot hotel-night is combined map-side."""
    return nights.groupBy("hotel_id", "night").agg(
        F.count_if(F.col("counts_for_occupancy")).cast("long").alias("occupied_rooms"),
        F.sum("total_net_revenue").alias("revenue"),
    )


def daily_kpis(nights: DataFrame, capacity: DataFrame) -> DataFrame:
    """KPI fact: occupancy % of capacity (NULL at capacity 0 or unknown),
    revenue rounded half-up to cents, ADR from the unrounded revenue."""
    return kpis_of(daily_aggregate(nights), capacity)


def kpis_of(cells: DataFrame, capacity: DataFrame) -> DataFrame:
    """The fact's columns from its sums (hotel_id, night, occupied_rooms, revenue)."""
    joined = cells.join(capacity, "hotel_id", "left")
    return joined.select(
        "hotel_id", "night", "occupied_rooms",
        F.col("total_rooms"),
        percent_2dp("occupied_rooms", "total_rooms").alias("occupancy_percentage"),
        money_to_double("revenue").alias("total_net_revenue"),
        adr("revenue", "occupied_rooms").alias("adr"),
        F.col("revenue").cast("decimal(38,6)").alias(EXACT_COLUMN),
    )


def _as_date(value) -> F.Column:
    if isinstance(value, date):
        return F.lit(value)
    return F.to_date(F.lit(str(value)))


def kpi_report(fact: DataFrame, hotel_id: str, from_date, to_date) -> DataFrame:
    """One row per night in [from_date, to_date] for one hotel, zero-filled,
    newest first, with the exact output contract (upper-case headers, text
    date, decimal(9,2) and decimal(14,2) values, bigint ADR).

    The hotel and date filters are applied to the fact before the join, so on
    a stored fact they reach the Parquet scan (partition and row-group
    pruning). The spine holds at most one row per requested night.
    """
    lo, hi = _as_date(from_date), _as_date(to_date)
    spark = fact.sparkSession
    # An empty range (from after to) yields no night, as a generated series does.
    days = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 DAY")))
    spine = spark.range(1).select(F.explode(days).alias("night"))
    wanted = (F.col("hotel_id") == hotel_id) & (F.col("night") >= lo) & (F.col("night") <= hi)
    if MONTH_COLUMN in fact.columns:
        # A stored fact partitioned by month: prune folders as well as rows.
        wanted = wanted & (F.col(MONTH_COLUMN) >= F.date_format(lo, "yyyy-MM")) \
            & (F.col(MONTH_COLUMN) <= F.date_format(hi, "yyyy-MM"))
    sliced = fact.where(wanted).select(
        "night", "occupancy_percentage", "total_net_revenue", "adr")
    # The slice has the fact's grain (hotel, night), so it holds at most one
    # row per requested night: a size bound that makes the broadcast safe.
    joined = spine.join(F.broadcast(sliced), "night", "left")
    return joined.select(
        F.date_format("night", "yyyy-MM-dd").alias("NIGHT_OF_STAY"),
        F.coalesce(F.col("occupancy_percentage"), F.lit(0.0)).cast("decimal(9,2)").alias("OCCUPANCY_PERCENTAGE"),
        F.coalesce(F.col("total_net_revenue"), F.lit(0.0)).cast("decimal(14,2)").alias("TOTAL_NET_REVENUE"),
        F.coalesce(F.col("adr"), F.lit(0)).cast("long").alias("ADR"),
    ).orderBy(F.col("NIGHT_OF_STAY").desc())
