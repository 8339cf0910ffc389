"""Data tests: all tests of a table in one pass.

A test yields the number of failing rows (repeated keys for ``unique``), and a status:
``pass``, or its severity ``warn`` / ``error``. Reports never raise.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ATHLETE = "athlete_id"


@dataclass(frozen=True)
class ColumnTest:
    """One declared test of a column. ``arg`` depends on ``kind``:

    ``accepted_values`` the values, ``accepted_range`` (min, max) with ``None`` for open,
    ``expression`` what follows the column name, e.g. ``">= 0"``.
    """

    table: str
    column: str
    kind: str
    arg: tuple | str | None = None
    where: str | None = None
    severity: str = "warn"

    def failing(self) -> str:
        """SQL condition of a row that fails; a null passes all but ``not_null``."""
        x = f"`{self.column}`"
        if self.kind == "not_null":
            bad = f"{x} IS NULL"
        elif self.kind == "accepted_values":
            bad = f"{x} NOT IN ({', '.join(map(_literal, self.arg))})"
        elif self.kind == "accepted_range":
            low, high = self.arg
            sides = [f"{x} < {low}"] if low is not None else []
            sides += [f"{x} > {high}"] if high is not None else []
            bad = " OR ".join(sides) or "FALSE"
        elif self.kind == "expression":
            bad = f"NOT ({x} {self.arg})"
        else:
            raise ValueError(self.kind)
        return f"({bad}) AND ({self.where})" if self.where else bad

    def result(self, failures: str) -> str:
        """SQL record of the outcome."""
        labels = {
            "table_name": self.table,
            "column_name": self.column,
            "test_name": self.kind,
            "where_clause": self.where or "",
            "severity": self.severity,
        }
        fields = [f"{_literal(v)} AS {n}" for n, v in labels.items()]
        return f"struct({', '.join(fields)}, {failures} AS failures)"


def _literal(value) -> str:
    return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


#: Row tests whose outcome fits into one whole number, one bit each.
_BITS = 62


def run_tests(df: DataFrame, tests: list[ColumnTest]) -> DataFrame:
    """All tests of a table in one scan and one shuffle, one row per test.

    A row becomes one entry with a bit for each row test that it fails, and one entry per ``unique`` test with its key
    (athlete and column; none for a null). Equal entries are counted, partially before the shuffle: what is
    shuffled is the keys and the few patterns of failures that occur.
    """
    by_row = [t for t in tests if t.kind != "unique"]
    unique = [t for t in tests if t.kind == "unique"]
    groups = [by_row[i : i + _BITS] for i in range(0, len(by_row), _BITS)]
    entries = []
    for g, group in enumerate(groups):
        bits = " + ".join(f"IF({t.failing()}, {1 << i}L, 0L)" for i, t in enumerate(group))
        entries.append(f"struct({-1 - g} AS test, CAST(NULL AS BIGINT) AS athlete, CAST(NULL AS STRING) AS key, {bits} AS bits)")
    for u, t in enumerate(unique):
        known = f"IF(`{t.column}` IS NULL, NULL, {u})"
        entries.append(f"struct({known} AS test, {ATHLETE} AS athlete, CAST(`{t.column}` AS STRING) AS key, 0L AS bits)")
    counted = df.selectExpr(f"inline(array({', '.join(entries)}))").filter("test IS NOT NULL AND (test >= 0 OR bits <> 0)")
    counted = counted.groupBy("test", "athlete", "key", "bits").agg(F.count("*").alias("n"))
    sums = [
        f"coalesce(sum(IF(test = {-1 - g} AND (bits & {1 << i}L) <> 0, n, 0L)), 0L)"
        for g, group in enumerate(groups)
        for i in range(len(group))
    ]
    sums += [f"count_if(test = {u} AND n > 1)" for u in range(len(unique))]
    found = counted.selectExpr(*[f"{x} AS t{i}" for i, x in enumerate(sums)])
    results = ", ".join(t.result(f"t{i}") for i, t in enumerate([*by_row, *unique]))
    return found.selectExpr(f"inline(array({results}))")


def report(tables: dict[str, DataFrame], tests: list[ColumnTest]) -> DataFrame:
    """One row per test over all tables."""
    mine = {name: [t for t in tests if t.table == name] for name in tables}
    found = reduce(DataFrame.unionByName, [run_tests(df, mine[name]) for name, df in tables.items() if mine[name]])
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.col("severity"))
    return found.withColumn("status", status)


def freshness(
    df: DataFrame,
    table: str,
    as_of: dt.date,
    warn_days: int | None,
    error_days: int | None = None,
    column: str = "inserted_at",
) -> DataFrame:
    """Age of the newest load against warn and error limits in days."""
    newest = df.agg(F.max(column).alias("newest_load"))
    age = F.date_diff(F.lit(as_of).cast("date"), F.to_date("newest_load"))
    status = F.lit("pass")
    if warn_days is not None:
        status = F.when(F.col("age_days") > warn_days, F.lit("warn")).otherwise(status)
    if error_days is not None:
        status = F.when(F.col("age_days") > error_days, F.lit("error")).otherwise(status)
    return newest.select(F.lit(table).alias("table_name"), "newest_load", age.alias("age_days")).withColumn(
        "status", status
    )
