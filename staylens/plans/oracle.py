"""DuckDB SQL for every catalogue query: an independent statement of the
same rules, used by the driver's correctness check.

The SQL rebuilds the raw feeds from ``lineitem``/``orders`` and then applies the
contract rules in plain SQL (windows for ranking, list functions for nested
items). Every rule and constant is written out here; only the request
parameters come from the engine, so a wrong rule there differs from this one.
Shared steps are CTEs; each query is ``WITH <the CTEs it needs> <final SELECT>``.
"""

from __future__ import annotations

from staylens.sources import testdata

# Which text is a date, a time, an amount.
ISO_DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
ISO_TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
OFFSET_TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}(:?\d{2})?$"
DMY_DATE_SHAPE = r"^\d{1,2}\.\d{1,2}\.\d{4}$"
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Canonical text of a line item, contract statuses, line fields.
FIELD_SEPARATOR, NULL_TOKEN = ",", "\\N"
CONTRACT_STATUSES = ("confirmed", "cancelled", "checked_in", "checked_out")
LINE_ITEM_FIELDS = ("room_type_id", "start_date", "end_date", "room_gross", "room_net", "fnb_gross", "fnb_net")


# --- guarded casts ------------------------------------------------------------
def _d(x: str) -> str:
    return f"(CASE WHEN regexp_matches(trim({x}), '{ISO_DATE_SHAPE}') THEN TRY_CAST(trim({x}) AS DATE) END)"


def _ts(x: str) -> str:
    return (f"(CASE WHEN regexp_matches(trim({x}), '{ISO_TIMESTAMP_SHAPE}') "
            f"THEN TRY_CAST(trim({x}) AS TIMESTAMP) END)")


def _ots(x: str) -> str:
    return (f"(CASE WHEN regexp_matches(trim({x}), '{OFFSET_TIMESTAMP_SHAPE}') "
            f"THEN TRY_CAST(replace(substr(trim({x}), 1, 19), 'T', ' ') AS TIMESTAMP) END)")


def _dmy(x: str) -> str:
    return (f"(CASE WHEN regexp_matches(trim({x}), '{DMY_DATE_SHAPE}') "
            f"THEN CAST(try_strptime(trim({x}), '%d.%m.%Y') AS DATE) END)")


def _m(x: str) -> str:
    return (f"(CASE WHEN regexp_matches(trim({x}), '{NUMBER_SHAPE}') "
            f"THEN TRY_CAST(trim({x}) AS DECIMAL(28,6)) END)")


def _t4(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,4)) AS VARCHAR)"


def _item_text(v: str) -> str:
    fields = ", ".join(f"coalesce({v}.{f}, '{NULL_TOKEN}')" for f in LINE_ITEM_FIELDS)
    return f"concat_ws('{FIELD_SEPARATOR}', {fields})"


def _fingerprint(col: str) -> str:
    """md5 of the sums of the four 32-bit parts of the items' md5 and their number."""
    sums = [f"coalesce(list_sum(list_transform({col}, lambda x: CAST('0x' || substr(md5({_item_text('x')}), {1 + 8 * i}, 8) AS HUGEINT))), 0)::VARCHAR"
            for i in range(4)]
    return f"(CASE WHEN {col} IS NOT NULL THEN md5(concat_ws(':', {', '.join(sums)}, len({col})::VARCHAR)) END)"


_STATUSES = ", ".join(f"'{s}'" for s in CONTRACT_STATUSES)
_ISO = "'%Y-%m-%d'"
_DIVISOR_UNITS = 11000  # gross over net of board prices, 1.10, in ten-thousandths


def _pct(n: str, d: str) -> str:
    """Exact half-up round(100 * n / d, 2) for non-negative integers."""
    return f"(CASE WHEN {d} <> 0 THEN (({n}) * 20000 + ({d})) // (2 * ({d})) / 100.0 END)"


CTE: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _cte(name: str, deps: list[str], sql: str) -> None:
    CTE[name] = sql
    DEPS[name] = deps


_cte("x_ev", [], """
SELECT o.o_custkey % 5 AS hn, CAST(l.l_orderkey AS VARCHAR) AS rid, l.l_partkey, l.l_suppkey,
       l.l_linenumber AS ln, l.l_returnflag AS rf, l.l_linestatus AS ls, l.l_shipdate, o.o_orderdate,
       CAST(o.o_orderdate AS DATE) AS arr,
       CAST(o.o_orderdate AS DATE) + CAST(CAST(l.l_quantity AS INTEGER) % 5 AS INTEGER) AS dep,
       CAST(l.l_extendedprice AS DECIMAL(14,2)) AS p,
       CAST(l.l_discount AS DECIMAL(4,2)) AS d
FROM lineitem AS l JOIN orders AS o ON l.l_orderkey = o.o_orderkey""")

_cte("x_nat_raw", ["x_ev"], f"""
SELECT 'H' || CAST(hn AS VARCHAR) AS hotel_id, rid AS reservation_id,
       CASE WHEN rf = 'R' THEN ' Cancelled ' WHEN rf = 'A' THEN 'checked_out' WHEN ln = 7 THEN 'bogus'
            WHEN ls = 'F' THEN 'checked_in' ELSE 'confirmed' END AS status,
       strftime(arr, {_ISO}) AS arrival_date, strftime(dep, {_ISO}) AS departure_date,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%g') AS updated_at,
       [{{'room_type_id': 'R' || CAST(l_partkey % 6 AS VARCHAR),
          'start_date': strftime(arr, {_ISO}), 'end_date': strftime(dep, {_ISO}),
          'room_gross': CAST(p AS VARCHAR), 'room_net': {_t4('p * (1 - d)')},
          'fnb_gross': CASE WHEN d = 0 THEN '' ELSE {_t4('p * (d + 0.01)')} END,
          'fnb_net': CASE WHEN d = 0 THEN '' ELSE {_t4('p * d')} END}},
        {{'room_type_id': 'R' || CAST(l_suppkey % 6 AS VARCHAR),
          'start_date': strftime(CASE WHEN ln = 2 THEN arr - 1 ELSE arr END, {_ISO}),
          'end_date': CASE WHEN ln = 5 THEN 'not-a-date' ELSE strftime(arr, {_ISO}) END,
          'room_gross': {_t4('p * 1.1')},
          'room_net': CASE WHEN ln = 3 THEN 'n/a' ELSE {_t4('p * (1.05 - d)')} END,
          'fnb_gross': CASE WHEN ln = 4 THEN NULL ELSE '' END,
          'fnb_net': CASE WHEN ln = 4 THEN NULL ELSE '' END}}] AS stay_dates
FROM x_ev WHERE hn <= 1""")

_cte("x_nat", ["x_nat_raw"], f"""
SELECT 'native' AS source_system, hotel_id, reservation_id, lower(trim(status)) AS status,
       {_d('arrival_date')} AS arrival_date, {_d('departure_date')} AS departure_date,
       {_ts('created_at')} AS created_at, {_ts('updated_at')} AS updated_at,
       {_ts('updated_at')} AS updated_instant, stay_dates
FROM x_nat_raw""")

_cte("x_cld_raw", ["x_ev"], f"""
SELECT 'H' || CAST(hn AS VARCHAR) AS hotel_id, rid AS reservation_id,
       CASE WHEN ln = 6 THEN 'CheckedOut' WHEN rf = 'R' THEN 'cancelled' WHEN rf = 'A' THEN 'checkedOut'
            WHEN ls = 'F' THEN 'checkedIn' WHEN ln = 1 THEN ' Confirmed ' ELSE 'confirmed' END AS rs,
       strftime(arr, {_ISO}) AS arrival, strftime(dep, {_ISO}) AS departure,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS created_txt,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN ln = 5 THEN 'Z' WHEN ln = 4 THEN '-0500' ELSE '-05:00' END AS modified_txt,
       [{{'room_type_id': 'R' || CAST(l_partkey % 6 AS VARCHAR),
          'start_date': strftime(arr, {_ISO}), 'end_date': strftime(arr, {_ISO}),
          'room_gross': CAST(p AS VARCHAR), 'room_net': {_t4('p * (1 - d)')},
          'fnb_gross': CASE WHEN d >= 0.05 THEN {_t4('p * (d + 0.01)')} END,
          'fnb_net': CASE WHEN d >= 0.05 THEN {_t4('p * d')} END}},
        {{'room_type_id': 'R' || CAST(l_suppkey % 6 AS VARCHAR),
          'start_date': strftime(arr + 1, {_ISO}), 'end_date': strftime(arr + 1, {_ISO}),
          'room_gross': {_t4('p * 0.5')}, 'room_net': {_t4('p * (0.5 - d)')},
          'fnb_gross': CAST(NULL AS VARCHAR), 'fnb_net': CAST(NULL AS VARCHAR)}}] AS stay_dates
FROM x_ev WHERE hn >= 3""")

_cte("x_cld", ["x_cld_raw"], f"""
SELECT 'cloud' AS source_system, hotel_id, reservation_id,
       CASE rs WHEN 'checkedOut' THEN 'checked_out' WHEN 'checkedIn' THEN 'checked_in'
               WHEN 'confirmed' THEN 'confirmed' WHEN 'cancelled' THEN 'cancelled'
               ELSE lower(trim(rs)) END AS status,
       {_d('arrival')} AS arrival_date, {_d('departure')} AS departure_date,
       {_ots('created_txt')} AS created_at, {_ots('modified_txt')} AS updated_at,
       {_ots('modified_txt')} - CAST(CASE WHEN substr(modified_txt, 20, 1) = '-' THEN -1 ELSE 1 END
         * (TRY_CAST(substr(modified_txt, 21, 2) AS INTEGER) * 60
            + coalesce(TRY_CAST(replace(substr(modified_txt, 23, 3), ':', '') AS INTEGER), 0)) AS INTEGER)
         * INTERVAL 1 MINUTE AS updated_instant, stay_dates
FROM x_cld_raw""")

_cte("x_nor_raw", ["x_ev"], f"""
SELECT 'H2' AS property_code, rid AS booking_ref,
       CASE WHEN rf = 'R' THEN 'CXL' WHEN rf = 'A' AND ln = 2 THEN ' out ' WHEN rf = 'A' THEN 'OUT'
            WHEN ls = 'F' THEN 'OK' ELSE 'NOSHOW' END AS stay_status,
       strftime(arr, '%d.%m.%Y') AS checkin, strftime(arr + 7, '%d.%m.%Y') AS checkout,
       CASE WHEN ln = 4 THEN strftime(arr + (ln - 1), '%-d.%-m.%Y')
            ELSE strftime(arr + (ln - 1), '%d.%m.%Y') END AS stay_night,
       'R' || CAST(l_partkey % 6 AS VARCHAR) AS room_code,
       CAST(p AS VARCHAR) AS room_gross_eur,
       CAST(CAST(p * 0.1 AS DECIMAL(18,3)) AS VARCHAR) AS room_vat_eur,
       CASE WHEN d = 0 THEN NULL ELSE {_t4('p * 0.12')} END AS board_gross_eur
FROM x_ev WHERE hn = 2""")

_board_units = f"CAST({_m('board_gross_eur')} * 1000000 AS HUGEINT)"
_cte("x_nor_n", ["x_nor_raw"], f"""
SELECT property_code AS hotel_id, booking_ref AS reservation_id,
       CASE lower(trim(stay_status)) WHEN 'ok' THEN 'checked_in' WHEN 'out' THEN 'checked_out'
            WHEN 'cxl' THEN 'cancelled' WHEN 'noshow' THEN 'confirmed'
            ELSE lower(trim(stay_status)) END AS status,
       {_dmy('checkin')} AS arrival_date, {_dmy('checkout')} AS departure_date,
       {_dmy('stay_night')} AS stay_night, room_code AS room_type_id,
       {_m('room_gross_eur')} AS room_gross,
       {_m('room_gross_eur')} - {_m('room_vat_eur')} AS room_net,
       {_m('board_gross_eur')} AS fnb_gross,
       CAST(sign({_board_units}) * ((2 * abs({_board_units}) + {_DIVISOR_UNITS})
            // {2 * _DIVISOR_UNITS}) AS DECIMAL(18,0)) * 0.01 AS fnb_net
FROM x_nor_raw""")

_nor_item = f"""{{'room_type_id': room_type_id, 'start_date': strftime(stay_night, {_ISO}),
  'end_date': strftime(stay_night, {_ISO}), 'room_gross': CAST(room_gross AS VARCHAR),
  'room_net': CAST(room_net AS VARCHAR), 'fnb_gross': CAST(fnb_gross AS VARCHAR),
  'fnb_net': CAST(fnb_net AS VARCHAR)}}"""
_cte("x_nor", ["x_nor_n"], f"""
SELECT 'nordic' AS source_system, hotel_id, reservation_id, min(status) AS status,
       min(arrival_date) AS arrival_date, max(departure_date) AS departure_date,
       CAST(min(arrival_date) AS TIMESTAMP) AS created_at, CAST(min(arrival_date) AS TIMESTAMP) AS updated_at,
       CAST(min(arrival_date) AS TIMESTAMP) AS updated_instant,
       list_transform(list_sort(list({{'k': {_item_text('it')}, 'item': it}})), lambda e: e.item) AS stay_dates
FROM (SELECT *, {_nor_item} AS it FROM x_nor_n)
GROUP BY hotel_id, reservation_id""")

_VALID = f"""COALESCE(hotel_id IS NOT NULL AND reservation_id IS NOT NULL AND status IN ({_STATUSES})
  AND arrival_date IS NOT NULL AND departure_date IS NOT NULL AND departure_date > arrival_date
  AND created_at IS NOT NULL AND updated_at IS NOT NULL AND stay_dates IS NOT NULL
  AND len(stay_dates) > 0, FALSE)"""
_cte("x_uni", ["x_nat", "x_nor", "x_cld"], f"""
SELECT source_system, hotel_id, reservation_id, status, arrival_date, departure_date, created_at,
       updated_at, updated_instant, stay_dates, {_VALID} AS is_valid
FROM (SELECT * FROM x_nat UNION ALL BY NAME SELECT * FROM x_nor UNION ALL BY NAME SELECT * FROM x_cld)""")

_cte("x_kept", ["x_uni"], f"""
SELECT source_system, hotel_id, reservation_id, status, arrival_date, departure_date, created_at,
       updated_at, updated_instant, stay_dates, status <> 'cancelled' AS counts_for_occupancy
FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id, reservation_id ORDER BY
        updated_instant DESC NULLS LAST, {_fingerprint('stay_dates')} DESC NULLS LAST,
        status ASC NULLS LAST, departure_date DESC NULLS LAST, arrival_date DESC NULLS LAST,
        created_at DESC NULLS LAST, source_system ASC NULLS LAST) AS rn
      FROM x_uni WHERE is_valid)
WHERE rn = 1""")

_cte("x_items", ["x_kept"], f"""
SELECT source_system, hotel_id, reservation_id, status, counts_for_occupancy, arrival_date,
       departure_date, sd.room_type_id AS room_type_id,
       {_d('sd.start_date')} AS sd_start, {_d('sd.end_date')} AS sd_end,
       sd.room_gross AS room_gross_raw, sd.room_net AS room_net_raw,
       sd.fnb_gross AS fnb_gross_raw, sd.fnb_net AS fnb_net_raw,
       {_m('sd.room_gross')} AS room_gross, {_m('sd.room_net')} AS room_net,
       {_m("nullif(sd.fnb_gross, '')")} AS fnb_gross, {_m("nullif(sd.fnb_net, '')")} AS fnb_net
FROM (SELECT *, unnest(stay_dates) AS sd FROM x_kept)""")

_ITEM_OK = """COALESCE(room_type_id IS NOT NULL AND room_net IS NOT NULL AND room_gross IS NOT NULL
  AND (fnb_net_raw IS NULL OR fnb_net_raw = '' OR fnb_net IS NOT NULL)
  AND (fnb_gross_raw IS NULL OR fnb_gross_raw = '' OR fnb_gross IS NOT NULL)
  AND sd_start IS NOT NULL AND sd_end IS NOT NULL AND sd_start <= sd_end
  AND sd_start >= arrival_date AND sd_end <= departure_date, FALSE)"""
_cte("x_vitems", ["x_items"], f"SELECT * FROM x_items WHERE {_ITEM_OK}")

_cte("x_inv_raw", [], """
SELECT hotel_id, room_type_id, CAST(CASE WHEN room_type_id = 'R5' THEN -n ELSE n END AS VARCHAR) AS quantity
FROM (SELECT 'H' || CAST(s_suppkey % 5 AS VARCHAR) AS hotel_id,
             'R' || CAST(s_nationkey % 6 AS VARCHAR) AS room_type_id, count(*) AS n
      FROM supplier GROUP BY 1, 2)""")

_cte("x_inv", ["x_inv_raw"], """
SELECT hotel_id, room_type_id, quantity
FROM (SELECT CAST(hotel_id AS VARCHAR) AS hotel_id, CAST(room_type_id AS VARCHAR) AS room_type_id,
             TRY_CAST(trim(quantity) AS INTEGER) AS quantity FROM x_inv_raw)
WHERE hotel_id IS NOT NULL AND room_type_id IS NOT NULL AND quantity IS NOT NULL AND quantity >= 0""")

_cte("x_cap", ["x_inv"], """
SELECT hotel_id, CAST(sum(quantity) AS BIGINT) AS total_rooms FROM x_inv GROUP BY hotel_id""")

_cte("x_stocked", ["x_vitems", "x_inv"], """
SELECT * FROM x_vitems AS v
WHERE EXISTS (SELECT 1 FROM x_inv AS i WHERE i.hotel_id = v.hotel_id AND i.room_type_id = v.room_type_id)""")

_cte("x_nights", ["x_stocked"], """
SELECT hotel_id, reservation_id, status, counts_for_occupancy, room_type_id, total_net_revenue,
       CAST(first_night + CAST(k AS INTEGER) AS DATE) AS night
FROM (SELECT *, unnest(generate_series(0, date_diff('day', first_night, last_night))) AS k
      FROM (SELECT hotel_id, reservation_id, status, counts_for_occupancy, room_type_id,
                   coalesce(room_net, 0) + coalesce(fnb_net, 0) AS total_net_revenue,
                   greatest(sd_start, arrival_date) AS first_night,
                   least(sd_end, departure_date - 1) AS last_night
            FROM x_stocked)
      WHERE first_night <= last_night)""")

_cte("x_rnights", ["x_nights"], """
SELECT hotel_id, reservation_id, night, status, counts_for_occupancy, room_type_id, total_net_revenue
FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id, reservation_id, night
             ORDER BY total_net_revenue DESC NULLS LAST, room_type_id ASC NULLS LAST) AS rn
      FROM x_nights)
WHERE rn = 1""")

_rev_units = "CAST(a.revenue * 1000000 AS HUGEINT)"
_cte("x_fact", ["x_rnights", "x_cap"], f"""
SELECT a.hotel_id, a.night, a.occupied_rooms, c.total_rooms,
       {_pct('a.occupied_rooms', 'c.total_rooms')} AS occupancy_percentage,
       CAST(round(a.revenue, 2) AS DOUBLE) AS total_net_revenue,
       CASE WHEN a.occupied_rooms = 0 THEN 0
            ELSE CAST(sign({_rev_units}) * ((2 * abs({_rev_units}) + a.occupied_rooms * 1000000)
                 // (2 * a.occupied_rooms * 1000000)) AS BIGINT) END AS adr,
       a.revenue AS net_revenue_exact
FROM (SELECT hotel_id, night,
             CAST(count(*) FILTER (WHERE counts_for_occupancy) AS BIGINT) AS occupied_rooms,
             sum(total_net_revenue) AS revenue
      FROM x_rnights GROUP BY hotel_id, night) AS a
LEFT JOIN x_cap AS c ON a.hotel_id = c.hotel_id""")


def _report_sql(hotel: str) -> str:
    return f"""
SELECT strftime(s.night, {_ISO}) AS "NIGHT_OF_STAY",
       CAST(coalesce(f.occupancy_percentage, 0) AS DECIMAL(9,2)) AS "OCCUPANCY_PERCENTAGE",
       CAST(coalesce(f.total_net_revenue, 0) AS DECIMAL(14,2)) AS "TOTAL_NET_REVENUE",
       CAST(coalesce(f.adr, 0) AS BIGINT) AS "ADR"
FROM (SELECT CAST(DATE '{testdata.REPORT_FROM}' + CAST(k AS INTEGER) AS DATE) AS night
      FROM (SELECT unnest(generate_series(0, date_diff('day', DATE '{testdata.REPORT_FROM}',
                                                          DATE '{testdata.REPORT_TO}'))) AS k)) AS s
LEFT JOIN (SELECT * FROM x_fact WHERE hotel_id = '{hotel}') AS f ON s.night = f.night"""


_cte("x_report", ["x_fact"], _report_sql(testdata.REPORT_HOTEL))

_cte("x_wm", ["x_kept"], """
SELECT source_system, hotel_id, max(updated_at) AS max_event_at, count(*) AS reservations
FROM x_kept GROUP BY source_system, hotel_id
UNION ALL
SELECT source_system, '__all__' AS hotel_id, max(updated_at) AS max_event_at, count(*) AS reservations
FROM x_kept GROUP BY source_system""")

_cte("x_man", [], f"""
SELECT CASE WHEN hn <= 1 THEN 'native' WHEN hn = 2 THEN 'nordic' ELSE 'cloud' END AS source_system,
       date_trunc('second', max(o_orderdate)) AS loaded_at, CAST({testdata.SLA_HOURS} AS INTEGER) AS freshness_sla_hours
FROM (SELECT o_custkey % 5 AS hn, o_orderdate FROM orders) GROUP BY 1""")

_AS_OF = f"TIMESTAMP '{testdata.AS_OF:%Y-%m-%d %H:%M:%S}'"
_cte("x_fresh", ["x_wm", "x_man"], f"""
SELECT w.source_system, w.hotel_id, w.reservations, m.loaded_at, w.max_event_at, {_AS_OF} AS as_of,
       m.freshness_sla_hours,
       round(date_diff('minute', m.loaded_at, {_AS_OF}) / 60.0, 2) AS load_lag_hours,
       greatest(round(date_diff('minute', w.max_event_at, {_AS_OF}) / 60.0, 2), 0.0) AS event_lag_hours,
       date_diff('minute', m.loaded_at, {_AS_OF}) / 60.0 > m.freshness_sla_hours AS is_stale
FROM x_wm AS w JOIN x_man AS m ON w.source_system = m.source_system""")



def _avail_sql(capacity: str) -> str:
    return f"""
SELECT s.hotel_id, s.night, c.total_rooms AS expected_room_nights,
       coalesce(f.occupied_rooms, 0) AS occupied_rooms,
       f.night IS NULL AS is_missing_day,
       CASE WHEN c.total_rooms IS NULL THEN 0 ELSE greatest(c.total_rooms - coalesce(f.occupied_rooms, 0), 0) END AS missing_room_nights,
       CASE WHEN c.total_rooms IS NULL THEN 100.0
            ELSE least({_pct('coalesce(f.occupied_rooms, 0)', 'c.total_rooms')}, 100.0) END AS availability_pct
FROM (SELECT hotel_id, CAST(first_night + CAST(k AS INTEGER) AS DATE) AS night
      FROM (SELECT hotel_id, first_night,
                   unnest(generate_series(0, date_diff('day', first_night, last_night))) AS k
            FROM (SELECT hotel_id, min(night) AS first_night, max(night) AS last_night
                  FROM x_fact GROUP BY hotel_id))) AS s
LEFT JOIN {capacity} AS c ON s.hotel_id = c.hotel_id
LEFT JOIN x_fact AS f ON s.hotel_id = f.hotel_id AND s.night = f.night"""


_cte("x_avail", ["x_fact", "x_cap"], _avail_sql("x_cap"))
_cte("x_avail_noh0", ["x_fact", "x_cap"], _avail_sql("(SELECT * FROM x_cap WHERE hotel_id <> 'H0')"))

_cte("x_ctl_nights", ["x_vitems", "x_inv"], """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY hotel_id, reservation_id, night ORDER BY rev DESC, room_type_id) AS rn
  FROM (SELECT *, CAST(sd_start + CAST(k AS INTEGER) AS DATE) AS night
        FROM (SELECT v.source_system, v.hotel_id, v.reservation_id, v.counts_for_occupancy,
                     v.room_type_id, v.arrival_date, v.departure_date, v.sd_start,
                     coalesce(v.room_net, 0) + coalesce(v.fnb_net, 0) AS rev,
                     unnest(generate_series(0, date_diff('day', v.sd_start, v.sd_end))) AS k
              FROM x_vitems AS v
              JOIN x_inv AS i ON v.hotel_id = i.hotel_id AND v.room_type_id = i.room_type_id))
  WHERE night >= arrival_date AND night < departure_date)
WHERE rn = 1""")

_cte("x_ctl", ["x_ctl_nights"], """
SELECT source_system,
       CAST(sum(CASE WHEN counts_for_occupancy THEN 1 ELSE 0 END) AS BIGINT) AS occupied_room_nights,
       CAST(round(sum(rev), 2) AS DOUBLE) AS total_net_revenue,
       count(*) AS room_nights, sum(rev) AS net_revenue_exact
FROM x_ctl_nights GROUP BY source_system""")

_cte("x_ctl_daily", ["x_ctl_nights"], """
SELECT hotel_id, night, CAST(sum(CASE WHEN counts_for_occupancy THEN 1 ELSE 0 END) AS BIGINT) AS occupied_rooms,
       sum(rev) AS net_revenue
FROM x_ctl_nights GROUP BY hotel_id, night""")


def _recon_sql(control: str) -> str:
    return f"""
SELECT source_system, occupied_room_nights, total_net_revenue,
       CAST(NULL AS BIGINT) AS fct_occupied_room_nights, CAST(NULL AS DOUBLE) AS fct_total_net_revenue,
       CAST(NULL AS DOUBLE) AS occupied_room_nights_diff, CAST(NULL AS DOUBLE) AS total_net_revenue_diff,
       CAST(NULL AS BOOLEAN) AS reconciled, net_revenue_exact, CAST(NULL AS DECIMAL(38,6)) AS fct_net_revenue_exact
FROM {control}
UNION ALL
SELECT '__total__', CAST(s_occ AS BIGINT), CAST(round(s_rev, 2) AS DOUBLE), CAST(f_occ AS BIGINT),
       CAST(round(f_rev, 2) AS DOUBLE), CAST(abs(s_occ - f_occ) AS DOUBLE), CAST(abs(s_rev - f_rev) AS DOUBLE),
       coalesce(s_occ = f_occ AND abs(s_rev - f_rev) <= 0.01, FALSE), s_rev, f_rev
FROM (SELECT (SELECT sum(occupied_room_nights) FROM {control}) AS s_occ,
             (SELECT sum(net_revenue_exact) FROM {control}) AS s_rev,
             (SELECT sum(occupied_rooms) FROM x_fact) AS f_occ,
             (SELECT sum(net_revenue_exact) FROM x_fact) AS f_rev)"""


_cte("x_recon", ["x_ctl", "x_fact"], _recon_sql("x_ctl"))
_cte("x_recon_nocloud", ["x_ctl", "x_fact"], _recon_sql("(SELECT * FROM x_ctl WHERE source_system <> 'cloud')"))

_cte("x_mkt", [], f"""
SELECT hotel_id, night, comp_rate_index, local_event, local_event IS NOT NULL AS has_local_event
FROM (SELECT hotel_id, {_d('night_txt')} AS night, TRY_CAST(trim(idx_txt) AS INTEGER) AS comp_rate_index,
             nullif(trim(event_txt), '') AS local_event
      FROM (SELECT 'H' || CAST(o_custkey % 5 AS VARCHAR) AS hotel_id,
                   strftime(CAST(o_orderdate AS DATE), {_ISO}) AS night_txt,
                   CAST(count(*) + 90 AS VARCHAR) AS idx_txt,
                   CASE WHEN max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) = 1
                        THEN ' city_event ' ELSE '' END AS event_txt
            FROM orders GROUP BY 1, 2))
WHERE hotel_id IS NOT NULL AND night IS NOT NULL AND comp_rate_index IS NOT NULL""")

_cte("x_blend", ["x_fact", "x_mkt"], f"""
SELECT f.hotel_id, f.night, f.occupancy_percentage, f.total_net_revenue, f.adr, m.comp_rate_index,
       m.local_event, coalesce(m.has_local_event, FALSE) AS has_local_event,
       CASE WHEN f.adr > 0 AND m.comp_rate_index IS NOT NULL
            THEN {_pct('f.adr', 'm.comp_rate_index')} END AS rate_vs_market_index
FROM x_fact AS f LEFT JOIN x_mkt AS m ON f.hotel_id = m.hotel_id AND f.night = m.night""")


def _flat(src: str, fingerprint: bool = True, extra: str = "") -> str:
    fp = f", {_fingerprint('stay_dates')} AS items_md5" if fingerprint else ""
    return (f"SELECT source_system, hotel_id, reservation_id, status, arrival_date, departure_date, "
            f"created_at, updated_at, CAST(len(stay_dates) AS INTEGER) AS n_items{fp}{extra} FROM {src}")


def _validity(src: str) -> str:
    return f", {_VALID.replace(chr(10), ' ')} AS is_valid"


def _money(c: str) -> str:
    return f"CAST({c} AS DOUBLE) AS {c}"


_DIFF_SIDES = """
WITH e AS (SELECT hotel_id, night, occupied_rooms, CAST(net_revenue_exact AS DECIMAL(38,6)) AS net_revenue FROM x_fact),
a AS (SELECT hotel_id, night, occupied_rooms + CASE WHEN hotel_id = 'H1' THEN 1 ELSE 0 END AS occupied_rooms,
             CAST(net_revenue AS DECIMAL(38,6)) AS net_revenue
      FROM x_ctl_daily WHERE day(night) <> 1)"""
_diff_sql = _DIFF_SIDES + "\nUNION ALL\n".join(
    f"""
SELECT hotel_id, night, CAST(1 AS INTEGER) AS occurrence,
       CASE WHEN a.here IS NULL THEN 'expected' WHEN e.here IS NULL THEN 'actual' ELSE 'both' END AS side,
       CAST(1 AS BIGINT) AS copies, '{c}' AS "column", CAST(e.{c} AS VARCHAR) AS expected, CAST(a.{c} AS VARCHAR) AS actual
FROM (SELECT *, 1 AS here FROM e) AS e FULL OUTER JOIN (SELECT *, 1 AS here FROM a) AS a USING (hotel_id, night)
WHERE e.{c} IS DISTINCT FROM a.{c} OR e.here IS NULL OR a.here IS NULL"""
    for c in ("occupied_rooms", "net_revenue")) + """
UNION ALL
SELECT NULL, NULL, 1, 'rows', abs(ne - na), NULL, CAST(ne AS VARCHAR), CAST(na AS VARCHAR)
FROM (SELECT (SELECT count(*) FROM e) AS ne, (SELECT count(*) FROM a) AS na) WHERE ne <> na"""

FINAL: dict[str, tuple[list[str], str]] = {
    "adapter_native": (["x_nat"], _flat("x_nat", extra=_validity("x_nat"))),
    "adapter_nordic_status": (["x_nor_n"], """
SELECT hotel_id, reservation_id, status, arrival_date, departure_date, stay_night, room_type_id FROM x_nor_n"""),
    "adapter_nordic_vat": (["x_nor_n"], f"""
SELECT hotel_id, reservation_id, stay_night, room_type_id, {_money('room_gross')}, {_money('room_net')},
       {_money('fnb_gross')}, {_money('fnb_net')} FROM x_nor_n"""),
    "adapter_nordic_regroup": (["x_nor"], _flat("x_nor", extra=_validity("x_nor"))),
    "enveloped_feed": (["x_nat"], _flat("x_nat", extra=_validity("x_nat"))),
    "adapter_cloud": (["x_cld"], _flat("x_cld", extra=_validity("x_cld"))),
    "validity_flags": (["x_uni"], """
SELECT source_system, status, is_valid, count(*) AS n_events FROM x_uni GROUP BY source_system, status, is_valid"""),
    "clean_inventory": (["x_inv"], "SELECT hotel_id, room_type_id, quantity FROM x_inv"),
    "clean_manifest": (["x_man"], "SELECT source_system, loaded_at, freshness_sla_hours FROM x_man"),
    "clean_market": (["x_mkt"], "SELECT hotel_id, night, comp_rate_index, local_event, has_local_event FROM x_mkt"),
    "unified_feed": (["x_uni"], _flat("x_uni", extra=", is_valid")),
    "dedup_latest": (["x_kept"], _flat("x_kept", extra=", counts_for_occupancy")),
    "incremental_kept": (["x_kept"], _flat("x_kept", extra=", counts_for_occupancy")),
    "line_item_validation": (["x_items"], f"""
SELECT hotel_id, reservation_id, room_type_id, sd_start, sd_end, {_money('room_net')}, {_money('fnb_net')},
       {_ITEM_OK} AS is_valid_item FROM x_items"""),
    "inventory_filter": (["x_stocked"], """
SELECT hotel_id, reservation_id, room_type_id, sd_start, sd_end,
       CAST(coalesce(room_net, 0) + coalesce(fnb_net, 0) AS DOUBLE) AS total_net_revenue FROM x_stocked"""),
    "night_explosion": (["x_nights"], """
SELECT hotel_id, reservation_id, night, status, room_type_id,
       CAST(total_net_revenue AS DOUBLE) AS total_net_revenue FROM x_nights"""),
    "one_room_night": (["x_rnights"], """
SELECT hotel_id, reservation_id, night, status, counts_for_occupancy, room_type_id,
       CAST(total_net_revenue AS DOUBLE) AS total_net_revenue FROM x_rnights"""),
    "hotel_capacity": (["x_cap"], "SELECT hotel_id, total_rooms FROM x_cap"),
    "fct_daily_kpis": (["x_fact"], "SELECT * EXCLUDE (net_revenue_exact) FROM x_fact"),
    "incremental_fact": (["x_fact"], "SELECT * EXCLUDE (net_revenue_exact) FROM x_fact"),
    "kpi_report": (["x_report"], 'SELECT * FROM x_report ORDER BY "NIGHT_OF_STAY" DESC'),
    "event_watermarks": (["x_wm"], "SELECT * FROM x_wm"),
    "data_freshness": (["x_fresh"], "SELECT * FROM x_fresh"),
    "availability_spine": (["x_avail"], "SELECT hotel_id, night, is_missing_day FROM x_avail"),
    "data_availability": (["x_avail"], "SELECT * FROM x_avail"),
    "source_control": (["x_ctl"], "SELECT * EXCLUDE (net_revenue_exact) FROM x_ctl"),
    "reconciliation": (["x_recon"], "SELECT * EXCLUDE (net_revenue_exact, fct_net_revenue_exact) FROM x_recon"),
    "market_blend": (["x_blend"], "SELECT * FROM x_blend"),
    "check_not_null": (["x_uni"], """
SELECT source_system, hotel_id, reservation_id FROM x_uni WHERE updated_at IS NULL"""),
    "check_unique_grain": (["x_uni"], """
SELECT hotel_id, reservation_id, count(*) AS n FROM x_uni GROUP BY hotel_id, reservation_id HAVING count(*) > 1"""),
    "check_accepted_values": (["x_uni"], f"""
SELECT source_system, hotel_id, reservation_id, status FROM x_uni
WHERE status IS NOT NULL AND status NOT IN ({_STATUSES})"""),
    "check_relationships": (["x_vitems", "x_inv"], """
SELECT hotel_id, reservation_id, room_type_id FROM x_vitems AS v
WHERE room_type_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM x_inv AS i WHERE i.room_type_id = v.room_type_id)"""),
    "check_fact_invariants": (["x_fact"], """
SELECT hotel_id, night, unnest(v) AS violation
FROM (SELECT hotel_id, night, list_filter(
        [CASE WHEN occupied_rooms = 0 THEN 'occupancy_negative' END,
         CASE WHEN day(night) = 1 AND total_net_revenue > 0 OR day(night) <> 1 AND total_net_revenue < 0 THEN 'revenue_negative' END,
         CASE WHEN occupied_rooms = 1 AND adr <> 0 THEN 'adr_without_rooms' END], lambda x: x IS NOT NULL) AS v FROM x_fact)"""),
    "check_dedup_latest": (["x_uni"], """
SELECT hotel_id, reservation_id FROM x_uni WHERE is_valid
GROUP BY hotel_id, reservation_id HAVING min(updated_instant) <> max(updated_instant)"""),
    "check_reconciliation_gate": (["x_recon_nocloud"], """
SELECT source_system, occupied_room_nights_diff, total_net_revenue_diff, reconciled FROM x_recon_nocloud
WHERE source_system = '__total__' AND NOT coalesce(reconciled, FALSE)"""),
    "check_availability_bounds": (["x_avail_noh0"], """
SELECT hotel_id, night, expected_room_nights, occupied_rooms, availability_pct FROM x_avail_noh0
WHERE availability_pct < 0 OR availability_pct > 100 OR expected_room_nights <= 0 OR expected_room_nights IS NULL"""),
    "check_freshness_sla": (["x_fresh"], """
SELECT source_system, hotel_id, load_lag_hours, freshness_sla_hours, NOT is_stale AS is_stale FROM x_fresh
WHERE source_system = 'native'"""),
    "check_source_totals": (["x_ctl", "x_fact"], """
SELECT * FROM (
  SELECT (SELECT CAST(sum(occupied_room_nights) AS BIGINT) FROM x_ctl WHERE source_system <> 'cloud') AS occupied_room_nights,
         (SELECT sum(net_revenue_exact) FROM x_ctl WHERE source_system <> 'cloud') AS total_net_revenue,
         (SELECT CAST(sum(occupied_rooms) AS BIGINT) FROM x_fact) AS fct_occupied_room_nights,
         (SELECT sum(net_revenue_exact) FROM x_fact) AS fct_total_net_revenue)
WHERE occupied_room_nights <> fct_occupied_room_nights OR abs(total_net_revenue - fct_total_net_revenue) > 0.01"""),
    "table_diff": (["x_fact", "x_ctl_daily"], f"SELECT * FROM ({_diff_sql})"),
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in DEPS[n]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    return ordered


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, (needs, final) in FINAL.items():
        ctes = ",\n".join(f"{n} AS ({CTE[n]}\n)" for n in _closure(needs))
        out[key] = f"WITH {ctes}\n{final.strip()}"
    return out


# --- the test suite ------------------------------------------------------------
_MODEL_CTE = {
    "stg_pms_native": ("x_uni", "source_system = 'native'"),
    "stg_pms_nordic": ("x_uni", "source_system = 'nordic'"),
    "stg_pms_cloud": ("x_uni", "source_system = 'cloud'"),
    "stg_reservations": ("x_uni", None),
    "stg_hotel_inventory": ("x_inv", None),
    "stg_source_load_manifest": ("x_man", None),
    "stg_market_rate_index": ("x_mkt", None),
    "int_reservations_deduped": ("x_kept", None),
    "int_reservation_nights": ("x_rnights", None),
    "int_hotel_capacity": ("x_cap", None),
    "int_source_event_watermarks": ("x_wm", None),
    "int_source_kpi_control": ("x_ctl", None),
    "fct_daily_kpis": ("x_fact", None),
    "data_freshness": ("x_fresh", None),
    "data_availability": ("x_avail", None),
    "reconciliation_report": ("x_recon", None),
    "mart_kpi_with_market": ("x_blend", None),
    "kpi_report": ("x_report", None),
}


def _model_sql(model: str) -> str:
    cte, where = _MODEL_CTE[model]
    return f"(SELECT * FROM {cte} WHERE {where})" if where else cte


def _lit(v) -> str:
    return ("TRUE" if v else "FALSE") if isinstance(v, bool) else f"'{v}'"


def _schema_test_sql(model: str, test: str, column: str, arg) -> str:
    m = _model_sql(model)
    if test == "not_null":
        return f'SELECT count(*) FROM {m} WHERE "{column}" IS NULL'
    if test == "unique":
        return f"SELECT count(*) FROM (SELECT {column} FROM {m} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    if test == "accepted_values":
        values = ", ".join(_lit(v) for v in arg)
        return f"SELECT count(*) FROM {m} WHERE {column} IS NOT NULL AND {column} NOT IN ({values})"
    parent, parent_column = arg
    return (f"SELECT count(*) FROM {m} AS c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_model_sql(parent)} AS p WHERE p.{parent_column} = c.{column})")


_GRAIN_SQL = {
    "data_availability_unique_grain": ("x_avail", "hotel_id, night"),
    "data_freshness_unique_grain": ("x_fresh", "source_system, hotel_id"),
    "fct_daily_kpis_unique_grain": ("x_fact", "hotel_id, night"),
    "mart_kpi_with_market_unique_grain": ("x_blend", "hotel_id, night"),
    "reservation_grain_unique": ("x_kept", "hotel_id, reservation_id"),
}
_FACT_RULE_SQL = {
    "adr_zero_when_no_occupied_rooms": "occupied_rooms = 0 AND adr <> 0",
    "occupancy_non_negative": "occupancy_percentage < 0",
    "total_net_revenue_non_negative": "total_net_revenue < 0",
}
_SINGULAR_SQL = {
    "availability_pct_bounded": "SELECT count(*) FROM x_avail WHERE availability_pct < 0 OR availability_pct > 100 "
                                "OR expected_room_nights <= 0 OR expected_room_nights IS NULL",
    "dedup_keeps_latest_snapshot": "SELECT count(*) FROM x_kept AS k WHERE updated_instant <> (SELECT max(u.updated_instant) "
                                   "FROM x_uni AS u WHERE u.is_valid AND u.hotel_id = k.hotel_id AND u.reservation_id = k.reservation_id)",
    "freshness_sla_detects_stale": "SELECT count(*) FROM x_fresh WHERE is_stale <> (load_lag_hours > freshness_sla_hours)",
    "reconciliation_passes": "SELECT count(*) FROM x_recon WHERE source_system = '__total__' AND NOT coalesce(reconciled, FALSE)",
    "source_totals_sum_to_fact": "SELECT count(*) FROM (SELECT sum(occupied_room_nights) AS o, sum(net_revenue_exact) AS r FROM x_ctl) "
                                 "WHERE o <> (SELECT sum(occupied_rooms) FROM x_fact) "
                                 "OR abs(r - (SELECT sum(net_revenue_exact) FROM x_fact)) > 0.01",
}


def _singular_test_sql(test: str) -> str:
    if test in _FACT_RULE_SQL:
        return f"SELECT count(*) FROM x_fact WHERE {_FACT_RULE_SQL[test]}"
    if test in _GRAIN_SQL:
        cte, keys = _GRAIN_SQL[test]
        return f"SELECT count(*) FROM (SELECT {keys} FROM {cte} GROUP BY {keys} HAVING count(*) > 1)"
    return _SINGULAR_SQL[test]


def _suite_final() -> tuple[list[str], str]:
    from staylens.plans.suite import SCHEMA_TESTS, SINGULAR_TESTS
    parts = [f"SELECT '{model}' AS model, '{test}' AS test, '{column}' AS column_name, "
             f"({_schema_test_sql(model, test, column, arg)}) AS violations"
             for model, test, column, arg in SCHEMA_TESTS]
    parts += [f"SELECT '{model}' AS model, '{test}' AS test, CAST(NULL AS VARCHAR) AS column_name, "
              f"({_singular_test_sql(test)}) AS violations"
              for test, model in SINGULAR_TESTS]
    needs = sorted({cte for cte, _ in _MODEL_CTE.values()} | {"x_report"})
    return needs, "\nUNION ALL\n".join(parts)


FINAL["check_suite"] = _suite_final()
