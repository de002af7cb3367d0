"""Contract-level rules shared by every adapter and every consumer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.schemas import CONTRACT_STATUSES, LINE_ITEM_FIELDS

# Canonical text of a line item, whose fields are joined by ","
# (a NULL field is written as the two characters \N), and of a fingerprint's sums.
FIELD_SEPARATOR = ","
SUM_SEPARATOR = ":"
NULL_TOKEN = "\\N"
HASH_PARTS = 4


def is_valid_reservation() -> Column:
    """Reservation-level validity of a contract row (never NULL).

    Ids present; status one of the four contract values; both dates parsed and
    departure strictly after arrival; both timestamps parsed; at least one
    line item.
    """
    rule = (
        F.col("hotel_id").isNotNull()
        & F.col("reservation_id").isNotNull()
        & F.col("status").isin(*CONTRACT_STATUSES)
        & F.col("arrival_date").isNotNull()
        & F.col("departure_date").isNotNull()
        & (F.col("departure_date") > F.col("arrival_date"))
        & F.col("created_at").isNotNull()
        & F.col("updated_at").isNotNull()
        & (F.col("n_items") > 0)
    )
    return F.coalesce(rule, F.lit(False))


def digest_parts(digest: Column) -> list[Column]:
    """The md5 of a line item's text as four 32-bit numbers."""
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(HASH_PARTS)]


def fingerprint_of_sums(sums: list[Column], n: Column) -> Column:
    """Fingerprint of a multiset of line items (snapshot tie-break): md5 of the
    sums of their `digest_parts` and their count. Sums commute, so items never
    have to meet in order or in one list; partial sums of any grouping do."""
    return F.md5(F.concat_ws(SUM_SEPARATOR, *[s.cast("string") for s in sums], n.cast("string")))


def stay_dates_fingerprint(c="stay_dates") -> Column:
    """The fingerprint of a nested line-item list; NULL for a NULL list.

    Engine-neutral: an item's text is spelled out field by field rather than
    taken from an engine's own rendering of nested values.
    """
    items = F.col(c) if isinstance(c, str) else c
    zero = F.lit(0).cast("long")
    return F.aggregate(
        F.transform(items, lambda x: F.md5(item_text(x))), F.array(*[zero] * HASH_PARTS),
        lambda acc, digest: F.array(*[acc[i] + part for i, part in enumerate(digest_parts(digest))]),
        lambda acc: fingerprint_of_sums([acc[i] for i in range(HASH_PARTS)], F.size(items)))


def item_text(item: Column) -> Column:
    """Canonical text of one line item (fields in contract order)."""
    return F.concat_ws(FIELD_SEPARATOR, *[
        F.coalesce(item[name], F.lit(NULL_TOKEN)) for name in LINE_ITEM_FIELDS])


def counts_for_occupancy() -> Column:
    """Every status except cancelled occupies a room (revenue counts all)."""
    return F.col("status") != F.lit("cancelled")
