import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import SCHEMA, prose  # noqa: E402


@pytest.fixture(scope="session")
def messy_rows():
    """Documents with every awkward case: nulls in each column, empty and
    blank texts, one very long text, equal rows, copies, near copies, a passage
    shared by a third of all rows."""
    rng = random.Random(5)
    shared = prose(rng, 60)
    rows = []
    for i in range(60):
        body = prose(rng, rng.randint(5, 150))
        if i % 3 == 0:
            body = f"{body} {shared}\n{prose(rng, 9)}"
        rows.append((i, body, "ab" if i % 2 else "cd", f"s{i % 4}", len(body)))
    long_text = prose(rng, 6000)
    rows += [(100, rows[1][1], "ab", "s1", 1), (101, rows[1][1], "ab", "s0", 1), (102, rows[4][1] + " extra", None, "s0", 2),
             (103, None, "ab", "s1", None), (104, "", "cd", None, 0), (105, " \t\n", "ab", "s2", 3), (106, "!!! 123 ...", "ab", "s0", 11),
             (107, long_text, "ab", "s0", 9), (None, prose(rng, 80), None, None, None), (108, "one two", "cd", "s3", 7),
             (109, "one two", "cd", "s3", 7)]
    rows.append(rows[10])
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
