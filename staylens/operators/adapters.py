"""One adapter per PMS feed, each mapping raw text onto the reservation
contract (``staylens.schemas.CONTRACT``) and attaching ``is_valid``.

Native and cloud adapters are narrow projections (no shuffle) with nested line
items. The Nordic adapter sums flat night rows up to reservation headers, which
is one shuffle on (hotel, booking) with map-side partial aggregation; its line
items stay flat rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.contract import digest_parts, fingerprint_of_sums, is_valid_reservation, item_text, stay_dates_fingerprint
from staylens.functions.parsing import (
    computed, offset_instant, parse_date, parse_date_dmy, parse_money, parse_offset_timestamp, parse_timestamp,
)
from staylens.schemas import CONTRACT, CONTRACT_COLUMNS

# Status vocabularies mapped onto the contract statuses.
NORDIC_STATUS = {"ok": "checked_in", "out": "checked_out", "cxl": "cancelled", "noshow": "confirmed"}
CLOUD_STATUS = {"checkedOut": "checked_out", "checkedIn": "checked_in",
                "confirmed": "confirmed", "cancelled": "cancelled"}
# Fixed value: VAT rate of Nordic board (F&B) prices.
NORDIC_VAT_RATE = Decimal("0.10")


def _map_status(key: Column, mapping: dict[str, str], fallback: Column) -> Column:
    out = None
    for raw, status in mapping.items():
        out = (F.when(key == raw, F.lit(status)) if out is None
               else out.when(key == raw, F.lit(status)))
    return out.otherwise(fallback)


def normalise_status(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(col))


def with_validity(df: DataFrame) -> DataFrame:
    """Append the shared reservation-level ``is_valid`` flag."""
    return df.withColumn("is_valid", is_valid_reservation())


def _finish(df: DataFrame, fingerprint: bool = True) -> DataFrame:
    """Count and fingerprint nested line items where the adapter has not, and
    judge the reservation. Without ``fingerprint`` it is NULL for nested items."""
    if "n_items" not in df.columns:
        md5 = stay_dates_fingerprint("stay_dates") if fingerprint else F.lit(None).cast("string")
        df = df.withColumn("n_items", F.size("stay_dates").cast("long")).withColumn("items_md5", md5)
    return with_validity(df).select(*CONTRACT_COLUMNS)


def adapt_native(raw: DataFrame, fingerprint: bool = True) -> DataFrame:
    """Native events -> contract. Line items keep their text amounts."""
    items = F.transform("stay_dates", lambda sd: F.struct(
        sd["room_type_id"].alias("room_type_id"),
        sd["start_date"].alias("start_date"),
        sd["end_date"].alias("end_date"),
        sd["room_revenue_gross_amount"].alias("room_gross"),
        sd["room_revenue_net_amount"].alias("room_net"),
        sd["fnb_gross_amount"].alias("fnb_gross"),
        sd["fnb_net_amount"].alias("fnb_net"),
    ))
    return _finish(computed(raw, [F.lit("native").alias("source_system"), "stay_dates"], [
        F.col("hotel_id"), F.col("reservation_id"),
        normalise_status("status").alias("status"),
        parse_date("arrival_date").alias("arrival_date"),
        parse_date("departure_date").alias("departure_date"),
        parse_timestamp("created_at").alias("created_at"),
        parse_timestamp("updated_at").alias("updated_at"),
        parse_timestamp("updated_at").alias("updated_instant"),
    ]).withColumn("stay_dates", items), fingerprint)


def nordic_nights(raw: DataFrame, vat_rate: Decimal = NORDIC_VAT_RATE) -> DataFrame:
    """Per-night projection of the Nordic feed: renamed columns, contract
    status, parsed dates and net amounts (room net = gross - VAT; board net =
    board / (1 + rate), half-up to cents)."""
    key = normalise_status("stay_status")
    gross = parse_money("room_gross_eur")
    vat = parse_money("room_vat_eur")
    board = parse_money("board_gross_eur")
    divisor = F.lit(Decimal(1) + vat_rate).cast("decimal(6,4)")
    return raw.select(
        F.col("property_code").alias("hotel_id"),
        F.col("booking_ref").alias("reservation_id"),
        _map_status(key, NORDIC_STATUS, key).alias("status"),
        parse_date_dmy("checkin").alias("arrival_date"),
        parse_date_dmy("checkout").alias("departure_date"),
        parse_date_dmy("stay_night").alias("stay_night"),
        F.col("room_code").alias("room_type_id"),
        gross.alias("room_gross"),
        (gross - vat).alias("room_net"),
        board.alias("fnb_gross"),
        F.round(board / divisor, 2).alias("fnb_net"),
    )


def nordic_item() -> Column:
    """The line item of one Nordic night, amounts written back as text."""
    def text(c: str) -> Column:
        return F.col(c).cast("string")

    night = F.date_format("stay_night", "yyyy-MM-dd")
    return F.struct(F.col("room_type_id").alias("room_type_id"), night.alias("start_date"), night.alias("end_date"),
                    text("room_gross").alias("room_gross"), text("room_net").alias("room_net"),
                    text("fnb_gross").alias("fnb_gross"), text("fnb_net").alias("fnb_net"))


def regroup_nordic(nights: DataFrame, keyless_apart: bool = True) -> DataFrame:
    """Flat Nordic nights -> one contract row per (hotel, booking), its header.

    Status is the smallest status text of the booking (deterministic; the feed
    repeats one status per booking). ``created_at`` and ``updated_at`` are the
    first arrival at midnight: the feed has no revision history.

    The line items stay rows of their own (`nordic_items`): ``stay_dates`` is
    NULL, ``n_items`` counts them and ``items_md5`` is made of sums over them.
    Everything aggregates map-side, so a booking with a third of all rows is
    one partial row a task, never a list.

    Rows without hotel or booking id never form a valid reservation. With
    ``keyless_apart`` each becomes its own (invalid) one; without it they are
    grouped like all others, a NULL id being a key, as the feeds' union does.
    """
    keys = ["hotel_id", "reservation_id"]
    if keyless_apart:
        keyless = F.col("hotel_id").isNull() | F.col("reservation_id").isNull()
        nights, keys = nights.withColumn("_row", F.when(keyless, F.monotonically_increasing_id())), [*keys, "_row"]
    hashed = nights.withColumn("_digest", F.md5(item_text(nordic_item())))
    # a sum over any number of rows, so not a long
    sums = [F.sum(part.cast("decimal(20,0)")).alias(f"_sum{i}") for i, part in enumerate(digest_parts(F.col("_digest")))]
    grouped = hashed.groupBy(*keys).agg(
        F.min("status").alias("status"),
        F.min("arrival_date").alias("arrival_date"),
        F.max("departure_date").alias("departure_date"),
        F.count(F.lit(1)).alias("n_items"),
        *sums,
    )
    first_arrival = F.col("arrival_date").cast("timestamp_ntz")
    return _finish(grouped.select(
        F.lit("nordic").alias("source_system"),
        "hotel_id", "reservation_id", "status", "arrival_date", "departure_date",
        first_arrival.alias("created_at"),
        first_arrival.alias("updated_at"),
        first_arrival.alias("updated_instant"),
        F.lit(None).cast(CONTRACT["stay_dates"].dataType).alias("stay_dates"),
        "n_items",
        fingerprint_of_sums([F.col(f"_sum{i}") for i in range(len(sums))], F.col("n_items")).alias("items_md5"),
    ))


def adapt_nordic(raw: DataFrame, vat_rate: Decimal = NORDIC_VAT_RATE, keyless_apart: bool = True) -> DataFrame:
    return regroup_nordic(nordic_nights(raw, vat_rate), keyless_apart)


def nordic_items(raw: DataFrame, vat_rate: Decimal = NORDIC_VAT_RATE) -> DataFrame:
    """The line items of the Nordic feed as flat rows (source_system, hotel_id,
    reservation_id, sd), a narrow projection of its nights."""
    return nordic_line_items(nordic_nights(raw, vat_rate))


def nordic_line_items(nights: DataFrame) -> DataFrame:
    """`nordic_items` of rows that are projected already."""
    return nights.where(F.col("hotel_id").isNotNull() & F.col("reservation_id").isNotNull()).select(
        F.lit("nordic").alias("source_system"), "hotel_id", "reservation_id", nordic_item().alias("sd"))


def adapt_cloud(raw: DataFrame, fingerprint: bool = True) -> DataFrame:
    """Cloud snapshots -> contract. Exact-case status codes map first, other
    text is lower-cased and trimmed; offset timestamps serve the wall clock and
    are ordered by the instant."""
    status_raw = F.col("reservationStatus")
    items = F.transform("nightlyRates", lambda r: F.struct(
        r["roomCode"].alias("room_type_id"),
        r["stayDate"].alias("start_date"),
        r["stayDate"].alias("end_date"),
        r["roomChargeGross"].alias("room_gross"),
        r["roomChargeNet"].alias("room_net"),
        r["incidentalsGross"].alias("fnb_gross"),
        r["incidentalsNet"].alias("fnb_net"),
    ))
    return _finish(computed(raw, [F.lit("cloud").alias("source_system"), "nightlyRates"], [
        F.col("propertyId").alias("hotel_id"),
        F.col("confirmationId").alias("reservation_id"),
        _map_status(status_raw, CLOUD_STATUS, normalise_status(status_raw)).alias("status"),
        parse_date("arrival").alias("arrival_date"),
        parse_date("departure").alias("departure_date"),
        parse_offset_timestamp("createdAt").alias("created_at"),
        parse_offset_timestamp("modifiedAt").alias("updated_at"),
        offset_instant("modifiedAt").alias("updated_instant"),
    ]).withColumn("stay_dates", items), fingerprint)


ADAPTERS = {"native": adapt_native, "nordic": adapt_nordic, "cloud": adapt_cloud}
#: Sources whose line items are rows of their own, with the function that gives them.
FLAT_ITEMS = {"nordic": nordic_items}


def unified_feed(feeds: dict[str, DataFrame], fingerprint: bool = True) -> DataFrame:
    """Union of every adapted source, by column name (no shuffle). Without
    ``fingerprint`` nested line items have none yet, for a reader that needs it
    of few rows (`reservations.dedup_latest`)."""
    out = None
    for source, raw in feeds.items():
        adapted = ADAPTERS[source](raw, keyless_apart=False) if source in FLAT_ITEMS else ADAPTERS[source](raw, fingerprint)
        out = adapted if out is None else out.unionByName(adapted)
    return out


def flat_items(feeds: dict[str, DataFrame]) -> DataFrame | None:
    """Flat line items of the sources that have them, None without such a source."""
    out = None
    for source, items in FLAT_ITEMS.items():
        if source in feeds:
            part = items(feeds[source])
            out = part if out is None else out.unionByName(part)
    return out
