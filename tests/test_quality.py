import datetime as dt

import pytest

from cadenza import quality_specs
from cadenza.operators import quality
from cadenza.operators.quality import ColumnTest


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", 5, "x"), (1, "a", None, "it's"), (2, "a", 50, None), (2, "b", -1, "z")],
        "athlete_id BIGINT, id STRING, n INT, kind STRING",
    )


def failures(df, *tests):
    found = quality.report({"t": df}, list(tests)).collect()
    return {(r.test_name, r.column_name): (r.failures, r.status) for r in found}


def test_kinds(rows):
    got = failures(
        rows,
        ColumnTest("t", "n", "not_null"),
        ColumnTest("t", "id", "unique"),
        ColumnTest("t", "kind", "accepted_values", ("x", "it's")),
        ColumnTest("t", "n", "accepted_range", (0, 40)),
        ColumnTest("t", "n", "expression", ">= 0", None, "error"),
    )
    assert got[("not_null", "n")] == (1, "warn")
    assert got[("unique", "id")] == (1, "warn")
    assert got[("accepted_values", "kind")] == (1, "warn")
    assert got[("accepted_range", "n")] == (2, "warn")
    assert got[("expression", "n")] == (1, "error")


def test_where_and_open_range(rows):
    got = failures(
        rows,
        ColumnTest("t", "kind", "not_null", None, "n > 100"),
        ColumnTest("t", "n", "accepted_range", (0, None)),
    )
    assert got[("not_null", "kind")] == (0, "pass")
    assert got[("accepted_range", "n")] == (1, "warn")


def test_all_declared_tests_are_there():
    assert len(quality_specs.TESTS) == 259


def test_freshness(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-03-01 10:00:00' AS inserted_at")
    ages = {2: "pass", 3: "pass", 4: "warn", 9: "error"}
    for days, status in ages.items():
        as_of = dt.date(2025, 3, 1) + dt.timedelta(days=days)
        row = quality.freshness(df, "t", as_of, 3, 8).first()
        assert (row.age_days, row.status) == (days, status)
