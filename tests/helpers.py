"""Test inputs in the raw feed shapes.

A booking is written as a short spec: who, when, and a list of lines
``(room, first night, last night, net[, food net])``. Gross amounts follow from
the net ones, so a test states only what it is about. Days are offsets in
March 2031 of the test lodge ``K7``.
"""

from __future__ import annotations

from staylens.schemas import INVENTORY_RAW

LODGE = "K7"


def day(d: int) -> str:
    return f"2031-03-{d:02d}"


def line(room, first, last, net, food=None) -> dict:
    """One native stay line; ``first`` and ``last`` are days, or texts as is."""
    text = lambda d: day(d) if isinstance(d, int) else d
    gross = lambda v: f"{float(v) * 1.25:.4f}" if str(v).replace(".", "").isdigit() else str(v)
    return {
        "room_type_id": room, "room_type_name": f"{room} room",
        "start_date": text(first), "end_date": text(last),
        "room_revenue_net_amount": str(net), "room_revenue_gross_amount": gross(net),
        "fnb_net_amount": "" if food is None else str(food),
        "fnb_gross_amount": "" if food is None else gross(food),
    }


def booking(ref, lines, stay=(10, 12), state="confirmed", sent="2031-02-20 11:15:00", lodge=LODGE) -> dict:
    """One native event: booking ``ref`` as it was ``sent``."""
    return {
        "reservation_id": str(ref), "hotel_id": lodge, "status": state,
        "arrival_date": day(stay[0]), "departure_date": day(stay[1]),
        "created_at": "2031-01-05 17:40:00", "updated_at": sent,
        "stay_dates": [line(*spec) for spec in lines],
    }


def inventory(spark, rows):
    """Inventory rows as text, of a size the planner knows (as of a file)."""
    values = ", ".join(f"('{h}', '{r}', '{q}')" for h, r, q in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(INVENTORY_RAW.names)})")


ROOMS = [(LODGE, "QN", 3), (LODGE, "TW", 5)]


def lodge_events() -> list[dict]:
    """A week of lodge K7 (8 rooms): a stay that was extended, one that was
    called off, one with meals in two rooms' rates, one in a room type that is
    not sold, and one with a status nobody knows."""
    return [
        booking("ext", [("QN", 10, 11, "81.40")], (10, 12), sent="2031-02-20 11:15:00"),
        booking("ext", [("QN", 10, 12, "81.40")], (10, 13), "checked_in", sent="2031-03-01 08:00:00"),
        booking("off", [("TW", 11, 11, "64")], (11, 12), "cancelled"),
        booking("food", [("TW", 12, 12, "70.25", "12.50"), ("QN", 12, 12, "60", "5")], (12, 13), "checked_out"),
        booking("unsold", [("ATTIC", 10, 10, "500")], (10, 11)),
        booking("odd", [("QN", 10, 10, "33")], (10, 11), "waitlisted"),
    ]


#: What the report of 10 to 13 March must show, newest first: 13 March is
#: nobody's night; on the 12th `ext` and `food` stay (81.40 and 82.75); on the
#: 11th `ext` stays and the called-off `off` still brings 64.
LODGE_REPORT = [
    ("2031-03-13", "0.00", "0.00", 0),
    ("2031-03-12", "25.00", "164.15", 82),
    ("2031-03-11", "12.50", "145.40", 145),
    ("2031-03-10", "12.50", "81.40", 81),
]
