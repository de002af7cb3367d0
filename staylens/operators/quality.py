"""Data-quality marts: event watermarks, freshness, availability, an
independent per-source control path, reconciliation and the market blend."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.measures import hours_2dp, minutes_between, percent_2dp
from staylens.functions.parsing import computed
from staylens.operators.reservations import LONG_STAY, days_between

# Roll-up labels and the revenue tolerance of reconciliation.
ALL_HOTELS = "__all__"
TOTAL_ROW = "__total__"
REVENUE_TOLERANCE = "0.01"


def event_watermarks(kept: DataFrame) -> DataFrame:
    """Newest event time and reservation count per (source, hotel), plus a
    per-source roll-up row labelled ``__all__``; the roll-up is recognised by ``grouping()``, not by a
    NULL hotel id. The grouping sets run over the per-hotel result, so every
    kept row is read once and only the small result is expanded."""
    per_hotel = kept.groupBy("source_system", "hotel_id").agg(
        F.max("updated_at").alias("max_event_at"), F.count(F.lit(1)).alias("reservations"))
    g = per_hotel.groupingSets(
        [["source_system", "hotel_id"], ["source_system"]], "source_system", "hotel_id"
    ).agg(
        F.max("max_event_at").alias("max_event_at"),
        F.sum("reservations").alias("reservations"),
        F.grouping("hotel_id").alias("_rollup"),
    )
    return g.select(
        "source_system",
        F.when(F.col("_rollup") == 1, F.lit(ALL_HOTELS)).otherwise(F.col("hotel_id")).alias("hotel_id"),
        "max_event_at", "reservations",
    )


def data_freshness(watermarks: DataFrame, manifest: DataFrame, as_of: datetime) -> DataFrame:
    """Load and event lag in hours against a fixed ``as_of``; stale when the
    load lag exceeds the source's SLA. Sources without a manifest row drop
    out (inner join)."""
    # Built from its text so the wall clock never depends on a time zone.
    as_of_ts = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    joined = watermarks.join(manifest, "source_system", "inner")
    load_min = minutes_between(F.col("loaded_at"), as_of_ts)
    event_min = minutes_between(F.col("max_event_at"), as_of_ts)
    return joined.select(
        "source_system", "hotel_id", "reservations", "loaded_at", "max_event_at",
        as_of_ts.alias("as_of"),
        "freshness_sla_hours",
        hours_2dp(load_min).alias("load_lag_hours"),
        F.greatest(hours_2dp(event_min), F.lit(0.0)).alias("event_lag_hours"),
        (load_min > F.col("freshness_sla_hours").cast("long") * 60).alias("is_stale"),
    )


def data_availability(fact: DataFrame, capacity: DataFrame) -> DataFrame:
    """Every night of each hotel's active window (first to last fact night):
    expected rooms, occupied rooms, missing day flag, missing room-nights and
    coverage capped at 100. The spine is generated from one row per
    hotel, by months that are dealt out and then days, then joined back to the fact on (hotel, night)."""
    windows = fact.groupBy("hotel_id").agg(
        F.min("night").alias("first_night"), F.max("night").alias("last_night"))
    spine = days_between(windows, F.col("first_night"), F.col("last_night"), "night", spread=True).select("hotel_id", "night")
    facts = fact.select("hotel_id", "night", F.col("occupied_rooms").alias("_occ"),
                        F.lit(True).alias("_present"))
    joined = (spine.join(capacity, "hotel_id", "left")
              .join(facts, ["hotel_id", "night"], "left"))
    occ = F.coalesce(F.col("_occ"), F.lit(0).cast("long"))
    cap = F.col("total_rooms")
    return joined.select(
        "hotel_id", "night",
        cap.alias("expected_room_nights"),
        occ.alias("occupied_rooms"),
        F.col("_present").isNull().alias("is_missing_day"),
        F.greatest(cap - occ, F.lit(0).cast("long")).alias("missing_room_nights"),
        F.least(percent_2dp(occ, cap), F.lit(100.0)).alias("availability_pct"),
    )


#: The control path's own statement of what text is a date and an amount.
_CONTROL_DATE = r"trim({0}) RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([ T].*)?$'"
_CONTROL_AMOUNT = r"trim({0}) RLIKE '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def _control_date(c: str) -> str:
    return f"IF({_CONTROL_DATE.format(c)}, TRY_CAST(trim({c}) AS DATE), NULL)"


def _control_amount(c: str) -> str:
    return f"IF({_CONTROL_AMOUNT.format(c)}, TRY_CAST(trim({c}) AS DECIMAL(28,6)), NULL)"


_CONTROL_LINE = ("room_type_id IS NOT NULL AND room_gross_amount IS NOT NULL AND room_net_amount IS NOT NULL"
                 " AND (coalesce(fnb_gross, '') = '' OR fnb_gross_amount IS NOT NULL)"
                 " AND (coalesce(fnb_net, '') = '' OR fnb_net_amount IS NOT NULL)")
_CONTROL_REVENUE = "coalesce(room_net_amount, 0) + coalesce(fnb_net_amount, 0) AS rev"
_CONTROL_STAY = "first_day BETWEEN arrival_date AND last_day AND last_day <= departure_date"
_RESERVATION = ["source_system", "hotel_id", "reservation_id"]


def _control_typed(lines: DataFrame) -> DataFrame:
    """Lines with their days and amounts, without those that have none."""
    values = [f"{_control_date('start_date')} AS first_day", f"{_control_date('end_date')} AS last_day",
              *[f"{_control_amount(c)} AS {c}_amount" for c in ("room_gross", "room_net", "fnb_gross", "fnb_net")]]
    return computed(lines, lines.columns, [F.expr(v) for v in values]).where(_CONTROL_LINE)


def control_nights(kept: DataFrame, inventory: DataFrame, flat: DataFrame | None = None) -> DataFrame:
    """One row per occupied room-night (source, hotel, reservation, night), its
    revenue `rev` and whether it occupies a room: nights are generated over the
    whole line range and then clamped, the inventory is an inner join, and one
    room per reservation-night is an aggregate (max revenue), not a ranking.
    The room type that wins a tie changes no total, so the max is enough.

    The rules are restated on purpose: nothing is shared with the fact path, so
    a fault in either shows as a difference. Flat line items are first summed up
    to nights and joined with their reservation last, so a booking with very
    many items meets it as one row a night; long stays are generated by months
    and days, in two steps, as in the fact path."""
    rooms = inventory.select("hotel_id", "room_type_id").distinct()
    lines = _control_typed(kept.where("stay_dates IS NOT NULL").selectExpr(
        *_RESERVATION, "status", "arrival_date", "departure_date", "inline(stay_dates)")).where(_CONTROL_STAY)
    stocked = lines.join(rooms, ["hotel_id", "room_type_id"]).selectExpr(
        *_RESERVATION, "arrival_date", "departure_date", "CASE WHEN status = 'cancelled' THEN 0 ELSE 1 END AS occ", _CONTROL_REVENUE,
        "first_day", "last_day")

    def nights(ranges: DataFrame, spread: bool) -> DataFrame:
        days = days_between(ranges, F.col("first_day"), F.col("last_day"), "night", spread)
        return days.where("night >= arrival_date AND night < departure_date").groupBy(*_RESERVATION, "night").agg(
            F.max("rev").alias("rev"), F.max("occ").alias("occ"))

    longest = kept.agg(F.max(F.datediff("departure_date", "arrival_date"))).first()[0] or 0
    if longest <= LONG_STAY:
        out = nights(stocked, False)
    else:  # a reservation is on one side, so its nights are aggregated once
        long = F.datediff("departure_date", "arrival_date") > LONG_STAY
        out = nights(stocked.where(~long), False).unionByName(nights(stocked.where(long), True))
    if flat is None:
        return out
    per_night = (_control_typed(flat.selectExpr(*_RESERVATION, "sd.*")).join(rooms, ["hotel_id", "room_type_id"])
                 .where("first_day <= last_day")
                 .selectExpr(*_RESERVATION, "first_day", "last_day", _CONTROL_REVENUE, "explode(sequence(first_day, last_day, INTERVAL 1 DAY)) AS night")
                 .groupBy(*_RESERVATION, "first_day", "last_day", "night").agg(F.max("rev").alias("rev")))
    headers = kept.where("stay_dates.room_type_id IS NULL").selectExpr(*_RESERVATION, "arrival_date", "departure_date",
                                                          "CASE WHEN status = 'cancelled' THEN 0 ELSE 1 END AS occ")
    own = (per_night.join(headers, _RESERVATION).where(f"{_CONTROL_STAY} AND night >= arrival_date AND night < departure_date")
           .groupBy(*_RESERVATION, "night").agg(F.max("rev").alias("rev"), F.max("occ").alias("occ")))
    return out.unionByName(own)


def control_cells(kept: DataFrame, inventory: DataFrame, flat: DataFrame | None = None) -> DataFrame:
    """The control path summed up per source, hotel and night: occupied rooms,
    room-nights and unrounded revenue. Its totals are sums of these."""
    return control_nights(kept, inventory, flat).groupBy("source_system", "hotel_id", "night").agg(
        F.sum("occ").cast("long").alias("occupied_rooms"), F.count(F.lit(1)).alias("room_nights"),
        F.sum("rev").cast("decimal(38,6)").alias("net_revenue_exact"))


def control_daily(cells: DataFrame) -> DataFrame:
    """`control_cells` at the fact's grain: occupied rooms and unrounded
    revenue per hotel and night."""
    return cells.groupBy("hotel_id", "night").agg(
        F.sum("occupied_rooms").alias("occupied_rooms"), F.sum("net_revenue_exact").cast("decimal(38,6)").alias("net_revenue_exact"))


def source_control(cells: DataFrame) -> DataFrame:
    """Per-source occupied room-nights, net revenue (served and unrounded) and
    room-nights, from `control_cells`."""
    return cells.groupBy("source_system").agg(
        F.sum("occupied_rooms").alias("occupied_room_nights"),
        F.round(F.sum("net_revenue_exact"), 2).cast("double").alias("total_net_revenue"),
        F.sum("room_nights").alias("room_nights"),
        F.sum("net_revenue_exact").cast("decimal(38,6)").alias("net_revenue_exact"),
    )


def reconciliation(control: DataFrame, fact: DataFrame) -> DataFrame:
    """Per-source rows, then a ``__total__`` row holding summed source totals,
    fact totals, absolute differences and the verdict (occupied room-nights
    equal and revenue within 0.01). Both sides are exact sums of unrounded
    amounts, so the verdict does not depend on how many rounded cells there
    are; an empty input gives a failed (false) verdict, never NULL.

    Both totals come from one global aggregate over a tagged union of the two
    inputs, so no join of the two sides is needed."""
    exact = "decimal(38,6)"
    tagged = control.select(
        F.col("occupied_room_nights").alias("s_occ"),
        F.col("net_revenue_exact").alias("s_rev"),
        F.lit(None).cast("long").alias("f_occ"),
        F.lit(None).cast(exact).alias("f_rev"),
    ).unionByName(fact.select(
        F.lit(None).cast("long").alias("s_occ"),
        F.lit(None).cast(exact).alias("s_rev"),
        F.col("occupied_rooms").cast("long").alias("f_occ"),
        F.col("net_revenue_exact").alias("f_rev"),
    ))
    t = tagged.agg(*[F.sum(c).alias(c) for c in ("s_occ", "s_rev", "f_occ", "f_rev")])
    rev_diff = F.abs(F.col("s_rev") - F.col("f_rev"))
    total = t.select(
        F.lit(TOTAL_ROW).alias("source_system"),
        F.col("s_occ").alias("occupied_room_nights"),
        F.round("s_rev", 2).cast("double").alias("total_net_revenue"),
        F.col("f_occ").alias("fct_occupied_room_nights"),
        F.round("f_rev", 2).cast("double").alias("fct_total_net_revenue"),
        F.abs(F.col("s_occ") - F.col("f_occ")).cast("double").alias("occupied_room_nights_diff"),
        rev_diff.cast("double").alias("total_net_revenue_diff"),
        F.coalesce((F.col("s_occ") == F.col("f_occ"))
                   & (rev_diff <= F.lit(REVENUE_TOLERANCE).cast("decimal(4,2)")),
                   F.lit(False)).alias("reconciled"),
        F.col("s_rev").cast(exact).alias("net_revenue_exact"),
        F.col("f_rev").cast(exact).alias("fct_net_revenue_exact"),
    )
    per_source = control.select(
        "source_system", "occupied_room_nights", "total_net_revenue",
        F.lit(None).cast("long").alias("fct_occupied_room_nights"),
        F.lit(None).cast("double").alias("fct_total_net_revenue"),
        F.lit(None).cast("double").alias("occupied_room_nights_diff"),
        F.lit(None).cast("double").alias("total_net_revenue_diff"),
        F.lit(None).cast("boolean").alias("reconciled"),
        "net_revenue_exact",
        F.lit(None).cast(exact).alias("fct_net_revenue_exact"),
    )
    return per_source.unionByName(total)


def market_blend(fact: DataFrame, market: DataFrame) -> DataFrame:
    """Fact left-joined to the market index on (hotel, night); the property's
    ADR against the comp-set index (100 = at market) when both exist and the
    index is non-zero."""
    m = market.select("hotel_id", "night", "comp_rate_index", "local_event", "has_local_event")
    joined = fact.join(m, ["hotel_id", "night"], "left")
    index = F.col("comp_rate_index")
    return joined.select(
        "hotel_id", "night", "occupancy_percentage", "total_net_revenue", "adr",
        index.alias("comp_rate_index"),
        "local_event",
        F.coalesce(F.col("has_local_event"), F.lit(False)).alias("has_local_event"),
        F.when((F.col("adr") > 0) & index.isNotNull(), percent_2dp("adr", index))
         .alias("rate_vs_market_index"),
    )
