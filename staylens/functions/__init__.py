"""Column-level building blocks: guarded text casts, exact money and KPI
arithmetic, the snapshot fingerprint and the reservation validity rule.

Everything here returns a ``pyspark.sql.Column`` built from Spark's own
expressions, so it stays inside whole-stage codegen; nothing is a Python UDF.
"""

from staylens.functions.parsing import (  # noqa: F401
    parse_date, parse_date_dmy, parse_money, parse_offset_timestamp, parse_timestamp,
    blank_to_null,
)
from staylens.functions.measures import (  # noqa: F401
    adr, minutes_between, money_to_double, percent_2dp, round_money,
)
from staylens.functions.contract import (  # noqa: F401
    counts_for_occupancy, is_valid_reservation, stay_dates_fingerprint,
)
