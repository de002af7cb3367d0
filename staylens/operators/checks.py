"""Reusable data-quality checks. Each returns the violating rows: an empty
result means the check passes. All are distributed (filters, aggregates,
anti/semi joins); none collects."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def not_null(df: DataFrame, column: str, keep: Sequence[str] | None = None) -> DataFrame:
    out = df.where(F.col(column).isNull())
    return out.select(*keep) if keep else out


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``n``. A single
    column is a key that may be absent: its NULLs are not compared."""
    if len(columns) == 1:
        df = df.where(F.col(columns[0]).isNotNull())
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def accepted_values(df: DataFrame, column: str, values: Iterable, keep: Sequence[str] | None = None) -> DataFrame:
    """Non-NULL values outside the accepted list."""
    out = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*list(values)))
    return out.select(*keep) if keep else out


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    out = child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")
    return out.select(*keep) if keep else out


def _violations(df: DataFrame, rules: dict[str, F.Column], keys: Sequence[str]) -> DataFrame:
    out = None
    for name, predicate in rules.items():
        part = df.where(F.coalesce(predicate, F.lit(False))).select(*keys, F.lit(name).alias("violation"))
        out = part if out is None else out.unionByName(part)
    return out


def fact_rules() -> dict[str, F.Column]:
    """Fact invariants, each as the predicate of a violating row."""
    return {
        "occupancy_negative": F.col("occupancy_percentage") < 0,
        "revenue_negative": F.col("total_net_revenue") < 0,
        "adr_without_rooms": (F.col("occupied_rooms") == 0) & (F.col("adr") != 0),
    }


def fact_invariants(fact: DataFrame) -> DataFrame:
    """Fact rows breaking: occupancy >= 0, revenue >= 0, ADR = 0 when no room
    is occupied."""
    return _violations(fact, fact_rules(), ["hotel_id", "night"])


def availability_bounds(availability: DataFrame) -> DataFrame:
    """Availability outside [0, 100], or a hotel without positive capacity
    (whose coverage would otherwise read as 100)."""
    return availability.where(
        (F.col("availability_pct") < 0) | (F.col("availability_pct") > 100)
        | F.coalesce(F.col("expected_room_nights") <= 0, F.lit(False))
        | F.col("expected_room_nights").isNull()
    ).select("hotel_id", "night", "expected_room_nights", "occupied_rooms", "availability_pct")


def freshness_sla(freshness: DataFrame) -> DataFrame:
    """Rows whose stale flag disagrees with the load lag against the SLA."""
    return freshness.where(
        F.col("is_stale") != (F.col("load_lag_hours") > F.col("freshness_sla_hours"))
    ).select("source_system", "hotel_id", "load_lag_hours", "freshness_sla_hours", "is_stale")


def dedup_keeps_latest(kept: DataFrame, unified: DataFrame, time: str = "updated_instant") -> DataFrame:
    """Kept snapshots whose time is not the latest valid time of their key."""
    latest = (unified.where("is_valid").groupBy("hotel_id", "reservation_id")
              .agg(F.max(time).alias("latest_time")))
    return (kept.join(latest, ["hotel_id", "reservation_id"], "inner")
            .where(F.col(time) != F.col("latest_time"))
            .select("hotel_id", "reservation_id"))


def reconciliation_gate(report: DataFrame) -> DataFrame:
    """The total row when it does not reconcile; an undecided (NULL)
    verdict counts as a failure."""
    return report.where((F.col("source_system") == "__total__")
                        & ~F.coalesce(F.col("reconciled"), F.lit(False))).select(
        "source_system", "occupied_room_nights_diff", "total_net_revenue_diff", "reconciled")


def source_totals_match_fact(report: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Summed per-source rows against the fact totals of the total row, on the
    unrounded amounts.

    One conditional aggregate over the report gives both sides in one row."""
    is_total = F.col("source_system") == "__total__"
    sides = report.agg(
        F.sum(F.when(~is_total, F.col("occupied_room_nights"))).alias("occupied_room_nights"),
        F.sum(F.when(~is_total, F.col("net_revenue_exact"))).alias("total_net_revenue"),
        F.max(F.when(is_total, F.col("fct_occupied_room_nights"))).alias("fct_occupied_room_nights"),
        F.max(F.when(is_total, F.col("fct_net_revenue_exact"))).alias("fct_total_net_revenue"),
    )
    return sides.where(
        (F.col("occupied_room_nights") != F.col("fct_occupied_room_nights"))
        | (F.abs(F.col("total_net_revenue") - F.col("fct_total_net_revenue"))
           > F.lit(tolerance).cast("decimal(4,2)")))


#: Sides of a difference: the row on both sides with unlike values, on one of
#: them only, and the numbers of rows.
BOTH, EXPECTED, ACTUAL, ROWS = "both", "expected", "actual", "rows"


def table_diff(expected: DataFrame, actual: DataFrame, keys: Sequence[str],
               columns: Sequence[str] | None = None) -> DataFrame:
    """Difference of two tables as multisets of rows, matched on ``keys``
    (repeated and NULL keys included); empty if they are equal.

    Rows that both sides hold equally often cancel out. What is left of a key
    is numbered on each side in the order of its values and paired by number
    (``occurrence``). One output row per

    * column whose values differ in a pair (``side`` "both"),
    * column of a row that one side holds only, with its value there ("expected"
      or "actual"), so that a NULL value and an absent row differ,

    with ``copies``, how often, and one row "rows" with the two row counts if
    they differ. Values are text.

    Equal rows are counted map-side before anything is exchanged, so a key or
    row that is repeated very often is one row a task. Both inputs are read
    once; the counts come from the same exchange as the differences.
    """
    keys, columns = list(keys), list(columns or [c for c in expected.columns if c not in keys])
    sides = [df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)],
                       F.lit(e).alias("_e"), F.lit(1 - e).alias("_a")) for df, e in ((expected, 1), (actual, 0))]
    k, v = [f"_k{i}" for i in range(len(keys))], [f"_v{i}" for i in range(len(columns))]
    rows = sides[0].unionByName(sides[1]).groupBy(*k, *v).agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))
    left = rows.where("_e <> _a").select(*k, *v, (F.col("_e") > F.col("_a")).alias("_mine"), F.abs(F.col("_e") - F.col("_a")).alias("_n"))
    place = Window.partitionBy(*k, "_mine").orderBy(*[F.col(c).asc_nulls_last() for c in v])
    row = F.struct("_n", *v)
    pairs = (left.withColumn("occurrence", F.row_number().over(place)).groupBy(*k, "occurrence")
             .agg(F.first(F.when(F.col("_mine"), row), ignorenulls=True).alias("_e"), F.first(F.when(~F.col("_mine"), row), ignorenulls=True).alias("_a")))
    n_e, n_a = (F.coalesce(F.col(f"{s}._n"), F.lit(0).cast("long")) for s in ("_e", "_a"))

    def cells(side: str, copies, e, a, differs) -> list:
        return [F.struct(F.lit(side).alias("side"), copies.alias("copies"), F.lit(c).alias("column"), e(i).alias("expected"), a(i).alias("actual"),
                         ((copies > 0) & differs(i)).alias("differs")) for i, c in enumerate(columns)]

    value = lambda s: lambda i: F.col(f"{s}._v{i}").cast("string")
    none, always = (lambda i: F.lit(None).cast("string")), (lambda i: F.lit(True))
    found = F.array(*cells(BOTH, F.least(n_e, n_a), value("_e"), value("_a"), lambda i: ~F.col(f"_e._v{i}").eqNullSafe(F.col(f"_a._v{i}"))),
                    *cells(EXPECTED, n_e - n_a, value("_e"), none, always), *cells(ACTUAL, n_a - n_e, none, value("_a"), always))
    named = [F.col(a).alias(b) for a, b in zip(k, keys)]
    out = pairs.select(*named, "occurrence", F.inline(found)).where("differs").drop("differs")
    counts = rows.agg(F.coalesce(F.sum("_e"), F.lit(0)).alias("_e"), F.coalesce(F.sum("_a"), F.lit(0)).alias("_a")).where("_e <> _a")
    return out.unionByName(counts.select(
        *[F.lit(None).cast(expected.schema[c].dataType).alias(c) for c in keys], F.lit(1).alias("occurrence"), F.lit(ROWS).alias("side"),
        F.abs(F.col("_e") - F.col("_a")).alias("copies"), F.lit(None).cast("string").alias("column"),
        F.col("_e").cast("string").alias("expected"), F.col("_a").cast("string").alias("actual")))
