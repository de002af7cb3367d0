"""Projection of the driver's benchmark tables onto the raw feed shapes.

The benchmark tables hold orders and line items, not reservations. Each
``lineitem`` row becomes one snapshot event of the reservation ``l_orderkey``
(its order), so one reservation has several snapshots, as a PMS re-sends a
booking on every change. Hotels come from ``o_custkey % 5``: hotels H0 and H1
report through the native feed, H2 through the Nordic CSV, H3 and H4 through
the cloud feed. The rules below deliberately produce every case the pipeline
must handle: invalid statuses and stays, malformed numbers, dates and
offsets, line items outside the stay or the inventory, duplicate nights,
equal timestamps between snapshots, and overbooked nights.

Amounts derived from prices keep every digit they have (up to four decimals),
so fractions of a cent reach every sum.

Everything is a lazy DataFrame derived from the given tables, so the work
grows with them; nothing is collected. The oracle SQL in ``__spark_entry__``
builds the same feeds with the same rules.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Request parameters used for the driver data.
AS_OF = datetime(2001, 8, 1, 6, 0, 0)
REPORT_HOTEL = "H1"
REPORT_FROM = "1995-01-01"
REPORT_TO = "2001-12-31"
# Fixed value: hours after which a load is late.
SLA_HOURS = "24"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def _text(amount: Column, scale: int = 4) -> Column:
    return amount.cast(f"decimal(18,{scale})").cast("string")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item joined to its order, with the shared derived
    columns every feed uses."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    od = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ev = li.join(od, li.l_orderkey == od.o_orderkey)
    arr = F.to_date(F.col("o_orderdate"))
    return ev.select(
        (F.col("o_custkey") % 5).alias("hn"),
        F.col("l_orderkey").cast("string").alias("rid"),
        "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
        "l_shipdate", "o_orderdate",
        arr.alias("arr"),
        F.date_add(arr, F.col("l_quantity").cast("int") % 5).alias("dep"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("p"),
        F.col("l_discount").cast("decimal(4,2)").alias("d"),
    )


def native_feed(ev: DataFrame) -> DataFrame:
    """Hotels H0/H1 as native events (``NATIVE_EVENT`` shape)."""
    p, d, ln = F.col("p"), F.col("d"), F.col("l_linenumber")
    status = (F.when(F.col("l_returnflag") == "R", F.lit(" Cancelled "))
              .when(F.col("l_returnflag") == "A", F.lit("checked_out"))
              .when(ln == 7, F.lit("bogus"))
              .when(F.col("l_linestatus") == "F", F.lit("checked_in"))
              .otherwise(F.lit("confirmed")))
    room1 = F.concat(F.lit("R"), (F.col("l_partkey") % 6).cast("string"))
    room2 = F.concat(F.lit("R"), (F.col("l_suppkey") % 6).cast("string"))
    item1 = F.struct(
        _iso(F.col("arr")).alias("start_date"),
        _iso(F.col("dep")).alias("end_date"),
        room1.alias("room_type_id"),
        F.concat(F.lit("Room "), room1).alias("room_type_name"),
        p.cast("string").alias("room_revenue_gross_amount"),
        _text(p * (1 - d)).alias("room_revenue_net_amount"),
        F.when(d == 0, F.lit("")).otherwise(_text(p * (d + F.lit(0.01).cast("decimal(3,2)")))).alias("fnb_gross_amount"),
        F.when(d == 0, F.lit("")).otherwise(_text(p * d)).alias("fnb_net_amount"),
    )
    fnb2 = F.when(ln == 4, F.lit(None).cast("string")).otherwise(F.lit(""))
    item2 = F.struct(
        _iso(F.when(ln == 2, F.date_sub(F.col("arr"), 1)).otherwise(F.col("arr"))).alias("start_date"),
        F.when(ln == 5, F.lit("not-a-date")).otherwise(_iso(F.col("arr"))).alias("end_date"),
        room2.alias("room_type_id"),
        F.concat(F.lit("Room "), room2).alias("room_type_name"),
        _text(p * F.lit(1.1).cast("decimal(2,1)")).alias("room_revenue_gross_amount"),
        F.when(ln == 3, F.lit("n/a"))
         .otherwise(_text(p * (F.lit(1.05).cast("decimal(3,2)") - d))).alias("room_revenue_net_amount"),
        fnb2.alias("fnb_gross_amount"),
        fnb2.alias("fnb_net_amount"),
    )
    return ev.where(F.col("hn") <= 1).select(
        F.concat(F.lit("H"), F.col("hn").cast("string")).alias("hotel_id"),
        F.col("rid").alias("reservation_id"),
        status.alias("status"),
        _iso(F.col("arr")).alias("arrival_date"),
        _iso(F.col("dep")).alias("departure_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss.SSS").alias("updated_at"),
        F.array(item1, item2).alias("stay_dates"),
    )


def nordic_feed(ev: DataFrame) -> DataFrame:
    """Hotel H2 as flat Nordic night rows (``NORDIC_ROW`` shape)."""
    p, d, ln = F.col("p"), F.col("d"), F.col("l_linenumber")
    status = (F.when(F.col("l_returnflag") == "R", F.lit("CXL"))
              .when((F.col("l_returnflag") == "A") & (ln == 2), F.lit(" out "))
              .when(F.col("l_returnflag") == "A", F.lit("OUT"))
              .when(F.col("l_linestatus") == "F", F.lit("OK"))
              .otherwise(F.lit("NOSHOW")))
    night = F.date_add(F.col("arr"), ln - 1)
    night_text = F.when(ln == 4, F.date_format(night, "d.M.yyyy")).otherwise(
        F.date_format(night, "dd.MM.yyyy"))
    return ev.where(F.col("hn") == 2).select(
        F.lit("H2").alias("property_code"),
        F.col("rid").alias("booking_ref"),
        status.alias("stay_status"),
        F.date_format("arr", "dd.MM.yyyy").alias("checkin"),
        F.date_format(F.date_add(F.col("arr"), 7), "dd.MM.yyyy").alias("checkout"),
        night_text.alias("stay_night"),
        F.concat(F.lit("R"), (F.col("l_partkey") % 6).cast("string")).alias("room_code"),
        F.lit("EUR").alias("currency"),
        p.cast("string").alias("room_gross_eur"),
        _text(p * F.lit(0.1).cast("decimal(2,1)"), 3).alias("room_vat_eur"),
        F.when(d == 0, F.lit(None).cast("string"))
         .otherwise(_text(p * F.lit(0.12).cast("decimal(3,2)"))).alias("board_gross_eur"),
    )


def cloud_feed(ev: DataFrame) -> DataFrame:
    """Hotels H3/H4 as cloud snapshots (``CLOUD_RESERVATION`` shape)."""
    p, d, ln = F.col("p"), F.col("d"), F.col("l_linenumber")
    status = (F.when(ln == 6, F.lit("CheckedOut"))
              .when(F.col("l_returnflag") == "R", F.lit("cancelled"))
              .when(F.col("l_returnflag") == "A", F.lit("checkedOut"))
              .when(F.col("l_linestatus") == "F", F.lit("checkedIn"))
              .when(ln == 1, F.lit(" Confirmed "))
              .otherwise(F.lit("confirmed")))
    offset = (F.when(ln == 5, F.lit("Z")).when(ln == 4, F.lit("-0500"))
              .otherwise(F.lit("-05:00")))
    incidentals = d >= F.lit(0.05).cast("decimal(4,2)")
    rate1 = F.struct(
        F.concat(F.lit("R"), (F.col("l_partkey") % 6).cast("string")).alias("roomCode"),
        _iso(F.col("arr")).alias("stayDate"),
        F.lit("BAR").alias("ratePlan"),
        p.cast("string").alias("roomChargeGross"),
        _text(p * (1 - d)).alias("roomChargeNet"),
        F.when(incidentals, _text(p * (d + F.lit(0.01).cast("decimal(3,2)")))).alias("incidentalsGross"),
        F.when(incidentals, _text(p * d)).alias("incidentalsNet"),
    )
    rate2 = F.struct(
        F.concat(F.lit("R"), (F.col("l_suppkey") % 6).cast("string")).alias("roomCode"),
        _iso(F.date_add(F.col("arr"), 1)).alias("stayDate"),
        F.lit("BAR").alias("ratePlan"),
        _text(p * F.lit(0.5).cast("decimal(2,1)")).alias("roomChargeGross"),
        _text(p * (F.lit(0.5).cast("decimal(2,1)") - d)).alias("roomChargeNet"),
        F.lit(None).cast("string").alias("incidentalsGross"),
        F.lit(None).cast("string").alias("incidentalsNet"),
    )
    return ev.where(F.col("hn") >= 3).select(
        F.concat(F.lit("H"), F.col("hn").cast("string")).alias("propertyId"),
        F.col("rid").alias("confirmationId"),
        status.alias("reservationStatus"),
        _iso(F.col("arr")).alias("arrival"),
        _iso(F.col("dep")).alias("departure"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias("createdAt"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("modifiedAt"),
        F.lit("BAR").alias("ratePlanCode"),
        F.array(rate1, rate2).alias("nightlyRates"),
    )


def feeds(spark: SparkSession, sf_dir: str, events_path: str | None = None) -> dict[str, DataFrame]:
    """The three raw feeds derived from ``lineitem`` and ``orders``. With
    ``events_path`` the joined events are written there first, partitioned by
    hotel, and each feed is a narrow projection of its hotels' folders: one
    scan and one join serve all three."""
    ev = events(spark, sf_dir)
    if events_path:
        schema = ev.schema
        ev.write.mode("overwrite").partitionBy("hn").option("compression", "zstd").parquet(events_path)
        ev = spark.read.schema(schema).parquet(events_path)
    return {"native": native_feed(ev), "nordic": nordic_feed(ev), "cloud": cloud_feed(ev)}


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Room inventory from ``supplier``: one row per (hotel, room type), the
    quantity being the number of suppliers mapped there. Room type R5 is
    published with a negative quantity, which the cleaning step rejects."""
    s = _read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("H"), (F.col("s_suppkey") % 5).cast("string")).alias("hotel_id"),
        F.concat(F.lit("R"), (F.col("s_nationkey") % 6).cast("string")).alias("room_type_id"))
    counted = s.groupBy("hotel_id", "room_type_id").agg(F.count(F.lit(1)).alias("n"))
    qty = F.when(F.col("room_type_id") == "R5", -F.col("n")).otherwise(F.col("n"))
    return counted.select("hotel_id", "room_type_id", qty.cast("string").alias("quantity"))


def market_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market index from ``orders`` per (hotel, order date): index 90 + number
    of orders; a local event when any order that day is urgent."""
    o = _read(spark, sf_dir, "orders")
    g = o.groupBy(
        F.concat(F.lit("H"), (F.col("o_custkey") % 5).cast("string")).alias("hotel_id"),
        F.to_date("o_orderdate").alias("night"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("urgent"),
    )
    return g.select(
        "hotel_id",
        _iso(F.col("night")).alias("night"),
        (F.col("n") + 90).cast("string").alias("comp_rate_index"),
        F.when(F.col("urgent") == 1, F.lit(" city_event ")).otherwise(F.lit("")).alias("local_event"),
    )


def manifest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load manifest from ``orders``: a source was loaded when the latest order
    of its hotels came in."""
    o = _read(spark, sf_dir, "orders").select((F.col("o_custkey") % 5).alias("hn"), "o_orderdate")
    source = F.when(F.col("hn") <= 1, "native").when(F.col("hn") == 2, "nordic").otherwise("cloud")
    loads = o.groupBy(source.alias("source_system")).agg(F.max("o_orderdate").alias("t"))
    return loads.select("source_system", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
                        F.lit(SLA_HOURS).alias("freshness_sla_hours"))
