"""Reservation layer: latest valid snapshot per reservation, and the
expansion of kept reservations into occupied room-nights.

Shuffle plan: one shuffle on (hotel_id, reservation_id) for the snapshot
dedup. The night expansion, the inventory semi-join (broadcast) and the
one-room-per-night rank all keep that partitioning: (hotel, reservation,
night) is clustered by (hotel, reservation), so no further exchange is
needed until the daily aggregate.

Two kinds of reservations would put too much into one task that way and take a
path of their own, ranked on (hotel, reservation, night): those whose line items
are flat rows (any number of them), and stays of more than `LONG_STAY` nights.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.contract import counts_for_occupancy, stay_dates_fingerprint
from staylens.functions.parsing import computed, parse_date, parse_money

KEPT_COLUMNS = ["source_system", "hotel_id", "reservation_id", "status", "arrival_date",
                "departure_date", "created_at", "updated_at", "updated_instant", "stay_dates", "n_items", "items_md5"]
NIGHT_COLUMNS = ["hotel_id", "reservation_id", "night", "status", "counts_for_occupancy",
                 "room_type_id", "total_net_revenue"]


#: What orders snapshots, first the latest instant: equal ones are broken by the
#: line-item fingerprint, then by status and stay dates, so that the winner
#: never depends on input order. NULLs come last.
SNAPSHOT_ORDER = [("updated_instant", "desc"), ("items_md5", "desc"), ("status", "asc"), ("departure_date", "desc"),
                  ("arrival_date", "desc"), ("created_at", "desc"), ("source_system", "asc")]


def snapshot_order() -> list[Column]:
    """`SNAPSHOT_ORDER` as sort columns."""
    # The 16-byte digest orders exactly like its hex text and halves the
    # sort key carried through the dedup shuffle.
    of = lambda c: F.unhex(c) if c == "items_md5" else F.col(c)
    return [of(c).desc_nulls_last() if way == "desc" else of(c).asc_nulls_last() for c, way in SNAPSHOT_ORDER]


def precedes(a: Column, b: Column) -> Column:
    """Whether snapshot ``a`` comes before ``b`` in `SNAPSHOT_ORDER` (both
    structs): the same order as a comparison of two rows, without a sort."""
    out = F.lit(False)
    for name, way in reversed(SNAPSHOT_ORDER):
        x, y = a[name], b[name]
        ahead = F.coalesce(x > y if way == "desc" else x < y, x.isNotNull() & y.isNull())
        out = F.when(x.eqNullSafe(y), out).otherwise(ahead)
    return out


def dedup_latest(unified: DataFrame) -> DataFrame:
    """Keep the latest valid snapshot per (hotel_id, reservation_id).

    Invalid events are removed first, so an invalid later snapshot never hides
    a valid earlier one. ``rank() = 1`` plans as a partial group limit before
    the shuffle, so a reservation with very many snapshots is reduced to those
    of one instant per map task before it is exchanged. Only these, mostly one,
    are told apart further; a fingerprint that is not there yet (`unified_feed`)
    is made for them alone.
    """
    return (latest_snapshots(unified, ["hotel_id", "reservation_id"])
            .select(*KEPT_COLUMNS, counts_for_occupancy().alias("counts_for_occupancy")))


def latest_snapshots(unified: DataFrame, keys: list[str]) -> DataFrame:
    """The first valid snapshot in `SNAPSHOT_ORDER` of each of ``keys``."""
    key = Window.partitionBy(*keys)
    newest = (unified.where("is_valid").withColumn("_rn", F.rank().over(key.orderBy(snapshot_order()[0]))).where(F.col("_rn") == 1)
              .withColumn("items_md5", F.coalesce("items_md5", stay_dates_fingerprint("stay_dates"))))
    ranked = newest.withColumn("_rn", F.row_number().over(key.orderBy(*snapshot_order())))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


#: Nights of a stay up to which one task generates them.
LONG_STAY = 366
#: Line items of one booking that are never dealt to several tasks.
FEW_ITEMS = 1000
KEYS = ["source_system", "hotel_id", "reservation_id"]


def is_flat() -> Column:
    """Reservations whose line items are rows of their own: no list, which one
    field of it shows, so that a reader needs no other."""
    return F.col("stay_dates.room_type_id").isNull()


@dataclass(frozen=True)
class Survey:
    """What decides how kept reservations are expanded: the flat line items
    they have in all, and whether there are long stays."""

    flat_items: int
    long_stays: bool


def survey(kept: DataFrame) -> Survey:
    """One aggregate over two dates and two narrow columns."""
    row = kept.agg(F.sum(F.when(is_flat(), F.col("n_items"))).alias("n"),
                   F.max(F.datediff("departure_date", "arrival_date")).alias("longest")).first()
    return Survey(row["n"] or 0, (row["longest"] or 0) > LONG_STAY)


def long_stay() -> Column:
    return F.datediff("departure_date", "arrival_date") > LONG_STAY


def with_headers(flat: DataFrame, kept: DataFrame, columns: list[str], flat_total: int | None = None) -> DataFrame:
    """Flat line items (source_system, hotel_id, reservation_id, sd) with the
    ``columns`` of their kept reservation; items of others are dropped.

    A booking with more than its share of the ``flat_total`` items (the total
    over the number of shuffle partitions) is dealt out in pieces of that size,
    by a row number of the input, and its header is copied to each. There are at most as many such
    bookings as partitions, which bounds what is broadcast."""
    headers = kept.where(is_flat()).select(*dict.fromkeys([*KEYS, *columns, "n_items"]))
    if flat_total is None:
        flat_total = survey(kept).flat_items
    share = max(FEW_ITEMS, -(-flat_total // int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    pieces = F.ceil(F.col("n_items") / F.lit(share)).cast("long")
    hot = headers.where(F.col("n_items") > share).select(*KEYS, pieces.alias("_pieces"))
    dealt = (flat.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(hot), KEYS, "left")
             .withColumn("_piece", F.pmod(F.col("_row"), F.coalesce(F.col("_pieces"), F.lit(1).cast("long")))).drop("_row", "_pieces"))
    copies = headers.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("n_items")
    return dealt.join(copies, [*KEYS, "_piece"]).drop("_piece")


def line_items(kept: DataFrame, flat: DataFrame | None = None, extra: list[str] | None = None,
               flat_total: int | None = None) -> DataFrame:
    """One row per line item of a kept reservation, with typed fields. ``flat``
    holds the items that are rows of their own; without it a reservation that
    has such items is an error, never a reservation without items."""
    carry = ["hotel_id", "reservation_id", "status", "counts_for_occupancy",
             "arrival_date", "departure_date"] + (extra or [])
    if flat is None:
        absent = F.raise_error(F.lit("the line items of this reservation are flat rows, which were not given"))
        nested = F.coalesce(F.col("stay_dates"), absent.cast(kept.schema["stay_dates"].dataType))
        return _typed(kept.select(*carry, F.explode(nested).alias("sd")), carry)
    rows = kept.select(*carry, F.explode("stay_dates").alias("sd"))
    return _typed(rows.unionByName(with_headers(flat, kept, carry, flat_total).select(*carry, "sd")), carry)


def _typed(exploded: DataFrame, carry: list[str]) -> DataFrame:
    return computed(exploded, carry, [
        F.col("sd.room_type_id").alias("room_type_id"),
        parse_date("sd.start_date").alias("sd_start"),
        parse_date("sd.end_date").alias("sd_end"),
        F.col("sd.room_gross").alias("room_gross_raw"),
        F.col("sd.room_net").alias("room_net_raw"),
        F.col("sd.fnb_gross").alias("fnb_gross_raw"),
        F.col("sd.fnb_net").alias("fnb_net_raw"),
        parse_money("sd.room_gross").alias("room_gross"),
        parse_money("sd.room_net").alias("room_net"),
        parse_money(F.nullif(F.col("sd.fnb_gross"), F.lit(""))).alias("fnb_gross"),
        parse_money(F.nullif(F.col("sd.fnb_net"), F.lit(""))).alias("fnb_net"),
    ])


def valid_line_item() -> Column:
    """Line-item contract: room type present; room amounts numeric; F&B blank
    or numeric; start <= end; the range inside [arrival, departure]."""
    def optional_ok(raw: str, parsed: str) -> Column:
        return F.col(raw).isNull() | (F.col(raw) == "") | F.col(parsed).isNotNull()

    return F.coalesce(
        F.col("room_type_id").isNotNull()
        & F.col("room_net").isNotNull() & F.col("room_gross").isNotNull()
        & optional_ok("fnb_net_raw", "fnb_net") & optional_ok("fnb_gross_raw", "fnb_gross")
        & F.col("sd_start").isNotNull() & F.col("sd_end").isNotNull()
        & (F.col("sd_start") <= F.col("sd_end"))
        & (F.col("sd_start") >= F.col("arrival_date"))
        & (F.col("sd_end") <= F.col("departure_date")),
        F.lit(False))


def validated_line_items(kept: DataFrame, flat: DataFrame | None = None, extra: list[str] | None = None,
                         flat_total: int | None = None) -> DataFrame:
    return line_items(kept, flat, extra, flat_total).where(valid_line_item())


def in_inventory(items: DataFrame, inventory: DataFrame) -> DataFrame:
    """Keep line items whose (hotel, room type) is in the inventory.

    A semi-join: no inventory column is needed and duplicate inventory rows
    cannot multiply line items. How the small side travels is left to the
    planner's statistics and AQE.
    """
    keys = inventory.select("hotel_id", "room_type_id").distinct()
    return items.join(keys, ["hotel_id", "room_type_id"], "left_semi")


def days_between(df: DataFrame, first: Column, last: Column, name: str, spread: bool = False) -> DataFrame:
    """``df`` with one row per day from ``first`` to ``last``, as ``name``;
    none if ``first`` is after ``last``.

    With ``spread`` the days are generated in two steps, months first, and the
    months are dealt out between the tasks: however long a range is, no task
    makes more than its share of it, and no array holds more than one entry a
    month."""
    df = df.where(first <= last)
    if not spread:
        return df.withColumn(name, F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))))
    months = F.sequence(F.trunc(first, "month"), last, F.expr("INTERVAL 1 MONTH"))
    dealt = (df.select("*", first.alias("_first"), last.alias("_last"), F.explode(months).alias("_month"))
             .withColumn("_spread", F.xxhash64(*df.columns, "_month"))
             .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_spread"))
    day = F.sequence(F.greatest("_first", "_month"), F.least("_last", F.last_day("_month")), F.expr("INTERVAL 1 DAY"))
    return dealt.withColumn(name, F.explode(day)).drop("_first", "_last", "_month", "_spread")


def expand_nights(items: DataFrame, extra: list[str] | None = None, spread: bool = False) -> DataFrame:
    """Each line item -> its occupiable nights.

    A line covers [start, end]; a guest occupies [arrival, departure - 1]. The
    clamp is applied before generating rows, so nights that would be dropped
    are never produced. Amounts are per night.
    """
    revenue = F.coalesce(F.col("room_net"), F.lit(0)) + F.coalesce(F.col("fnb_net"), F.lit(0))
    carry = ["hotel_id", "reservation_id", "status", "counts_for_occupancy",
             "room_type_id"] + (extra or [])
    clamped = items.select(*carry, revenue.alias("total_net_revenue"),
                           F.greatest(F.col("sd_start"), F.col("arrival_date")).alias("_from"),
                           F.least(F.col("sd_end"), F.date_sub(F.col("departure_date"), 1)).alias("_to"))
    return days_between(clamped, F.col("_from"), F.col("_to"), "night", spread).drop("_from", "_to")


def one_room_per_night(nights: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """A reservation is one room: one row per (hotel, reservation, night),
    the highest revenue winning, then the smaller room type."""
    w = Window.partitionBy("hotel_id", "reservation_id", "night").orderBy(
        F.col("total_net_revenue").desc_nulls_last(), F.col("room_type_id").asc_nulls_last())
    return (nights.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select(*NIGHT_COLUMNS, *(extra or [])))


def reservation_nights(kept: DataFrame, inventory: DataFrame, flat: DataFrame | None = None) -> DataFrame:
    """Kept reservations -> occupied room-nights (grain hotel, reservation,
    night), with line-item validation and the inventory filter. Which of the
    paths there are is decided by a `survey` of ``kept``, one small aggregate."""
    found = survey(kept)
    nested = kept if flat is None else kept.where(~is_flat())
    usual = nested.where(~long_stay()) if found.long_stays else nested
    out = one_room_per_night(expand_nights(in_inventory(validated_line_items(usual), inventory)))
    apart = []
    if flat is not None and found.flat_items:
        flat_only = kept.where(is_flat())
        apart.append(expand_nights(in_inventory(validated_line_items(flat_only, flat, flat_total=found.flat_items), inventory)))
    if found.long_stays:
        apart.append(expand_nights(in_inventory(validated_line_items(nested.where(long_stay())), inventory), spread=True))
    if apart:
        # a reservation is of one kind, so its nights are ranked on one path
        rows = apart[0] if len(apart) == 1 else apart[0].unionByName(apart[1])
        out = out.unionByName(one_room_per_night(rows))
    return out
