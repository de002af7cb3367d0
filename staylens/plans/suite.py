"""The data-quality test suite run after a build: one row per test with the
number of violating rows (0 = pass).

Schema tests (not_null, unique, accepted_values, relationships) are declared
per model column below; singular tests are invariants across models. Each
test is a distributed count over a (materialized) model; the counts are
unioned into one small result, computed in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.operators import checks
from staylens.plans.marts import Marts

SOURCES = ("native", "nordic", "cloud")
STATUSES = ("confirmed", "cancelled", "checked_in", "checked_out")
BOOLEANS = (True, False)

# Schema tests per model, as (model, test, column, argument).
SCHEMA_TESTS = [
    ("stg_pms_native", "accepted_values", "source_system", ("native",)),
    ("stg_pms_native", "not_null", "is_valid", None),
    ("stg_pms_nordic", "accepted_values", "source_system", ("nordic",)),
    ("stg_pms_nordic", "accepted_values", "status", STATUSES),
    ("stg_pms_cloud", "accepted_values", "source_system", ("cloud",)),
    ("stg_pms_cloud", "accepted_values", "status", STATUSES),
    ("stg_reservations", "not_null", "reservation_id", None),
    ("stg_reservations", "not_null", "hotel_id", None),
    ("stg_reservations", "not_null", "source_system", None),
    ("stg_reservations", "accepted_values", "source_system", SOURCES),
    ("stg_reservations", "not_null", "is_valid", None),
    ("stg_reservations", "accepted_values", "is_valid", BOOLEANS),
    ("stg_hotel_inventory", "not_null", "hotel_id", None),
    ("stg_hotel_inventory", "not_null", "room_type_id", None),
    ("stg_hotel_inventory", "not_null", "quantity", None),
    ("stg_source_load_manifest", "not_null", "source_system", None),
    ("stg_source_load_manifest", "unique", "source_system", None),
    ("stg_source_load_manifest", "accepted_values", "source_system", SOURCES),
    ("stg_source_load_manifest", "not_null", "loaded_at", None),
    ("stg_source_load_manifest", "not_null", "freshness_sla_hours", None),
    ("stg_market_rate_index", "not_null", "hotel_id", None),
    ("stg_market_rate_index", "not_null", "night", None),
    ("stg_market_rate_index", "not_null", "comp_rate_index", None),
    ("stg_market_rate_index", "not_null", "has_local_event", None),
    ("stg_market_rate_index", "accepted_values", "has_local_event", BOOLEANS),
    ("int_reservations_deduped", "not_null", "reservation_id", None),
    ("int_reservations_deduped", "not_null", "hotel_id", None),
    ("int_reservations_deduped", "not_null", "source_system", None),
    ("int_reservations_deduped", "accepted_values", "source_system", SOURCES),
    ("int_reservations_deduped", "not_null", "status", None),
    ("int_reservations_deduped", "accepted_values", "status", STATUSES),
    ("int_reservations_deduped", "not_null", "counts_for_occupancy", None),
    ("int_reservation_nights", "not_null", "night", None),
    ("int_reservation_nights", "not_null", "hotel_id", None),
    ("int_reservation_nights", "accepted_values", "status", STATUSES),
    ("int_reservation_nights", "not_null", "room_type_id", None),
    ("int_reservation_nights", "relationships", "room_type_id", ("stg_hotel_inventory", "room_type_id")),
    ("int_hotel_capacity", "not_null", "hotel_id", None),
    ("int_hotel_capacity", "unique", "hotel_id", None),
    ("int_hotel_capacity", "not_null", "total_rooms", None),
    ("int_source_event_watermarks", "not_null", "source_system", None),
    ("int_source_event_watermarks", "accepted_values", "source_system", SOURCES),
    ("int_source_event_watermarks", "not_null", "hotel_id", None),
    ("int_source_event_watermarks", "not_null", "max_event_at", None),
    ("int_source_kpi_control", "not_null", "source_system", None),
    ("int_source_kpi_control", "unique", "source_system", None),
    ("int_source_kpi_control", "accepted_values", "source_system", SOURCES),
    ("int_source_kpi_control", "not_null", "occupied_room_nights", None),
    ("int_source_kpi_control", "not_null", "total_net_revenue", None),
    ("fct_daily_kpis", "not_null", "hotel_id", None),
    ("fct_daily_kpis", "not_null", "night", None),
    ("data_freshness", "not_null", "source_system", None),
    ("data_freshness", "accepted_values", "source_system", SOURCES),
    ("data_freshness", "not_null", "hotel_id", None),
    ("data_freshness", "not_null", "load_lag_hours", None),
    ("data_freshness", "not_null", "event_lag_hours", None),
    ("data_freshness", "not_null", "freshness_sla_hours", None),
    ("data_freshness", "not_null", "is_stale", None),
    ("data_freshness", "accepted_values", "is_stale", BOOLEANS),
    ("data_availability", "not_null", "hotel_id", None),
    ("data_availability", "not_null", "night", None),
    ("data_availability", "not_null", "expected_room_nights", None),
    ("data_availability", "not_null", "availability_pct", None),
    ("data_availability", "not_null", "is_missing_day", None),
    ("data_availability", "accepted_values", "is_missing_day", BOOLEANS),
    ("reconciliation_report", "not_null", "source_system", None),
    ("reconciliation_report", "unique", "source_system", None),
    ("reconciliation_report", "not_null", "occupied_room_nights", None),
    ("reconciliation_report", "not_null", "total_net_revenue", None),
    ("mart_kpi_with_market", "not_null", "hotel_id", None),
    ("mart_kpi_with_market", "not_null", "night", None),
    ("mart_kpi_with_market", "not_null", "has_local_event", None),
    ("mart_kpi_with_market", "accepted_values", "has_local_event", BOOLEANS),
    ("kpi_report", "not_null", "NIGHT_OF_STAY", None),
]

# Singular tests, as (test, model).
SINGULAR_TESTS = [
    ("adr_zero_when_no_occupied_rooms", "fct_daily_kpis"),
    ("availability_pct_bounded", "data_availability"),
    ("data_availability_unique_grain", "data_availability"),
    ("data_freshness_unique_grain", "data_freshness"),
    ("dedup_keeps_latest_snapshot", "int_reservations_deduped"),
    ("fct_daily_kpis_unique_grain", "fct_daily_kpis"),
    ("freshness_sla_detects_stale", "data_freshness"),
    ("mart_kpi_with_market_unique_grain", "mart_kpi_with_market"),
    ("occupancy_non_negative", "fct_daily_kpis"),
    ("reconciliation_passes", "reconciliation_report"),
    ("reservation_grain_unique", "int_reservations_deduped"),
    ("source_totals_sum_to_fact", "reconciliation_report"),
    ("total_net_revenue_non_negative", "fct_daily_kpis"),
]


def models(m: Marts, report: DataFrame | None = None) -> dict[str, DataFrame]:
    """Model name -> DataFrame of a built mart set (and of a served report)."""
    u = m.unified
    out = {f"stg_pms_{s}": u.where(F.col("source_system") == s) for s in SOURCES}
    out.update({
        "stg_reservations": u,
        "stg_hotel_inventory": m.inventory,
        "int_reservations_deduped": m.kept,
        "int_reservation_nights": m.nights,
        "int_hotel_capacity": m.capacity,
        "int_source_event_watermarks": m.watermarks,
        "int_source_kpi_control": m.control,
        "fct_daily_kpis": m.fact,
        "data_availability": m.availability,
        "reconciliation_report": m.reconciliation,
    })
    if report is not None:
        out["kpi_report"] = report
    if m.manifest_raw is not None:
        out["stg_source_load_manifest"] = m.manifest
        if m.as_of is not None:
            out["data_freshness"] = m.freshness
    if m.market_raw is not None:
        out["stg_market_rate_index"] = m.market
        out["mart_kpi_with_market"] = m.market_blend
    return out


def _schema_violations(model: dict[str, DataFrame], name: str, test: str, column: str, arg) -> DataFrame:
    df = model[name]
    if test == "not_null":
        return checks.not_null(df, column, keep=[column])
    if test == "unique":
        return checks.unique(df, [column])
    if test == "accepted_values":
        return checks.accepted_values(df, column, arg, keep=[column])
    if test == "relationships":
        parent, parent_column = arg
        return checks.relationships(df, column, model[parent], parent_column, keep=[column])
    raise ValueError(test)


def _singular_violations(m: Marts, model: dict[str, DataFrame], test: str) -> DataFrame:
    fact_rules = {"adr_zero_when_no_occupied_rooms": "adr_without_rooms",
                  "occupancy_non_negative": "occupancy_negative",
                  "total_net_revenue_non_negative": "revenue_negative"}
    grains = {"data_availability_unique_grain": ("data_availability", ["hotel_id", "night"]),
              "data_freshness_unique_grain": ("data_freshness", ["source_system", "hotel_id"]),
              "fct_daily_kpis_unique_grain": ("fct_daily_kpis", ["hotel_id", "night"]),
              "mart_kpi_with_market_unique_grain": ("mart_kpi_with_market", ["hotel_id", "night"]),
              "reservation_grain_unique": ("int_reservations_deduped", ["hotel_id", "reservation_id"])}
    if test in fact_rules:
        rule = checks.fact_rules()[fact_rules[test]]
        return m.fact.where(F.coalesce(rule, F.lit(False)))
    if test in grains:
        name, keys = grains[test]
        return checks.unique(model[name], keys)
    if test == "availability_pct_bounded":
        return checks.availability_bounds(m.availability)
    if test == "dedup_keeps_latest_snapshot":
        return checks.dedup_keeps_latest(m.kept, m.unified)
    if test == "freshness_sla_detects_stale":
        return checks.freshness_sla(m.freshness)
    if test == "reconciliation_passes":
        return checks.reconciliation_gate(m.reconciliation)
    if test == "source_totals_sum_to_fact":
        return checks.source_totals_match_fact(m.reconciliation)
    raise ValueError(test)


def _count(df: DataFrame, model: str, test: str, column: str | None) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(model).alias("model"), F.lit(test).alias("test"),
        F.lit(column).cast("string").alias("column_name"), "violations")


ROW_TESTS = ("not_null", "accepted_values")


def _row_test_counts(df: DataFrame, name: str, tests: list[tuple[str, str, object]]) -> DataFrame:
    """All row-level tests of one model from a single scan: one conditional
    count per test, unpivoted to one row per test."""
    def failing(test: str, column: str, arg):
        if test == "not_null":
            return F.col(column).isNull()
        return F.col(column).isNotNull() & ~F.col(column).isin(*list(arg))

    counts = df.agg(*[F.count_if(failing(t, c, a)).alias(f"_v{i}") for i, (t, c, a) in enumerate(tests)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), F.lit(t).alias("test"),
                 F.lit(c).cast("string").alias("column_name"), F.col(f"_v{i}").cast("long").alias("violations"))
        for i, (t, c, _) in enumerate(tests)])))


def run_suite(m: Marts, report: DataFrame | None = None) -> DataFrame:
    """Every applicable test of a built mart set with its violation count.

    Row-level tests (not_null, accepted_values) of a model share one scan;
    unique, relationships and singular tests each have their own plan."""
    model = models(m, report)
    by_model: dict[str, list] = {}
    for name, test, column, arg in SCHEMA_TESTS:
        if name in model and test in ROW_TESTS:
            by_model.setdefault(name, []).append((test, column, arg))
    parts = [_row_test_counts(model[name], name, tests) for name, tests in by_model.items()]
    parts += [_count(_schema_violations(model, name, test, column, arg), name, test, column)
              for name, test, column, arg in SCHEMA_TESTS
              if name in model and test not in ROW_TESTS
              and (test != "relationships" or arg[0] in model)]
    parts += [_count(_singular_violations(m, model, test), name, test, None)
              for test, name in SINGULAR_TESTS if name in model]
    # Every part has the same four columns: combine them as a balanced tree
    # of positional unions, which keeps plan analysis linear.
    while len(parts) > 1:
        parts = [parts[i].union(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def failures(suite: DataFrame) -> DataFrame:
    return suite.where(F.col("violations") > 0)
