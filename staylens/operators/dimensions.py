"""Typing and cleaning of the seed tables, plus hotel capacity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.parsing import blank_to_null, parse_date, parse_timestamp


def _int(c: str):
    return F.trim(F.col(c)).try_cast("int")


def clean_inventory(raw: DataFrame) -> DataFrame:
    """Typed inventory; rows without keys or quantity, or with quantity < 0,
    are dropped (quantity 0 is kept)."""
    typed = raw.select(
        F.col("hotel_id").cast("string").alias("hotel_id"),
        F.col("room_type_id").cast("string").alias("room_type_id"),
        _int("quantity").alias("quantity"),
    )
    return typed.where(
        F.col("hotel_id").isNotNull() & F.col("room_type_id").isNotNull()
        & F.col("quantity").isNotNull() & (F.col("quantity") >= 0))


def clean_manifest(raw: DataFrame) -> DataFrame:
    """Typed load manifest; rows with any NULL are dropped."""
    return raw.select(
        F.col("source_system").cast("string").alias("source_system"),
        parse_timestamp("loaded_at").alias("loaded_at"),
        _int("freshness_sla_hours").alias("freshness_sla_hours"),
    ).dropna()


def clean_market(raw: DataFrame) -> DataFrame:
    """Typed market index; a blank event becomes NULL and sets
    ``has_local_event`` false. Rows without key or index are dropped."""
    event = blank_to_null("local_event")
    return raw.select(
        F.col("hotel_id").cast("string").alias("hotel_id"),
        parse_date("night").alias("night"),
        _int("comp_rate_index").alias("comp_rate_index"),
        event.alias("local_event"),
        event.isNotNull().alias("has_local_event"),
    ).where(F.col("hotel_id").isNotNull() & F.col("night").isNotNull()
            & F.col("comp_rate_index").isNotNull())


def hotel_capacity(inventory: DataFrame) -> DataFrame:
    """Sellable rooms per hotel (occupancy denominator)."""
    return inventory.groupBy("hotel_id").agg(F.sum("quantity").cast("long").alias("total_rooms"))
