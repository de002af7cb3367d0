"""Declared schemas: raw feeds (all text), the reservation contract, seeds.

Raw feeds are never schema-inferred: every leaf is a string so that malformed
values land as text and are judged by the parsing rules, not by the reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names]


# --- raw native feed: envelope {"data": [event, ...]} -----------------------
NATIVE_STAY_DATE = T.StructType(_strings(
    "start_date", "end_date", "room_type_id", "room_type_name",
    "room_revenue_gross_amount", "room_revenue_net_amount",
    "fnb_gross_amount", "fnb_net_amount",
))
NATIVE_EVENT = T.StructType(_strings(
    "hotel_id", "reservation_id", "status", "arrival_date", "departure_date",
    "created_at", "updated_at",
) + [T.StructField("stay_dates", T.ArrayType(NATIVE_STAY_DATE), True)])
NATIVE_ENVELOPE = T.StructType([T.StructField("data", T.ArrayType(NATIVE_EVENT), True)])

# --- raw Nordic feed: flat CSV, one row per room-night -----------------------
NORDIC_ROW = T.StructType(_strings(
    "property_code", "booking_ref", "stay_status", "checkin", "checkout",
    "stay_night", "room_code", "currency", "room_gross_eur", "room_vat_eur",
    "board_gross_eur",
))

# --- raw cloud feed: envelope {"reservations": [reservation, ...]} -----------
CLOUD_RATE = T.StructType(_strings(
    "roomCode", "stayDate", "ratePlan", "roomChargeGross", "roomChargeNet",
    "incidentalsGross", "incidentalsNet",
))
CLOUD_RESERVATION = T.StructType(_strings(
    "propertyId", "confirmationId", "reservationStatus", "arrival", "departure",
    "createdAt", "modifiedAt", "ratePlanCode",
) + [T.StructField("nightlyRates", T.ArrayType(CLOUD_RATE), True)])
CLOUD_ENVELOPE = T.StructType([T.StructField("reservations", T.ArrayType(CLOUD_RESERVATION), True)])

# --- the reservation contract every adapter emits ----------------------------
LINE_ITEM = T.StructType(_strings(
    "room_type_id", "start_date", "end_date", "room_gross", "room_net",
    "fnb_gross", "fnb_net",
))
LINE_ITEM_FIELDS = [f.name for f in LINE_ITEM.fields]

CONTRACT = T.StructType([
    T.StructField("source_system", S, False),
    T.StructField("hotel_id", S, True),
    T.StructField("reservation_id", S, True),
    T.StructField("status", S, True),
    T.StructField("arrival_date", T.DateType(), True),
    T.StructField("departure_date", T.DateType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
    # The same moment as an instant: what snapshots are ordered by.
    T.StructField("updated_instant", T.TimestampNTZType(), True),
    # Line items that the feed nests; NULL where they are rows of their own.
    T.StructField("stay_dates", T.ArrayType(LINE_ITEM), True),
    T.StructField("n_items", T.LongType(), True),
    T.StructField("items_md5", S, True),
    T.StructField("is_valid", T.BooleanType(), False),
])
CONTRACT_COLUMNS = [f.name for f in CONTRACT.fields]

# The four contract statuses.
CONTRACT_STATUSES = ("confirmed", "cancelled", "checked_in", "checked_out")

# --- seeds (text on disk, typed by the cleaning step) ------------------------
INVENTORY_RAW = T.StructType(_strings("hotel_id", "room_type_id", "quantity"))
MANIFEST_RAW = T.StructType(_strings("source_system", "loaded_at", "freshness_sla_hours"))
MARKET_RAW = T.StructType(_strings("hotel_id", "night", "comp_rate_index", "local_event"))

# Money is carried as exact decimals until the served value is rounded: 22
# digits before the point and 6 behind it; sums have 32 and 6.
MONEY = T.DecimalType(28, 6)
