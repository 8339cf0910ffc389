"""Every query against the same result in SQL on another engine.

A spread of queries runs by default; ``TEST_ALL_QUERIES=1`` runs all of them.
"""

import glob
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from cadenza import catalog, constants
from cadenza.functions import activity
from oracles import ORACLES, base, queries, values

SOME = """
    src_goals_csv norm_activities norm_calendar norm_weather norm_daily_health norm_forecast
    clean_activities flatten_nested conform_schema load_append backfill_weather
    load_replace_by_key delete_by_key ingest_incremental ingest_health ingest_calendar sink_views sink_csv table_newest
    stg_activities stg_health stg_calendar int_unified join_week_spine join_range_30d
    join_upcoming_goals join_recent_weather join_day_workouts join_pre_race_health
    agg_training_context agg_activity_overview agg_weekday_profile agg_readiness_distribution
    win_days_since_pr win_score_ma7_30d mart_training mart_health mart_race
    qry_upcoming_top4 qry_latest_and_previous qry_recovery_today qry_half_over_half
    qry_temp_pace_trend qry_race_kpis qry_race_history qry_pr_cards qry_goal_gaps
    qry_week_overall ck_best_worst_recovery ck_best_races coaching_context alerts prompt_text
    prompt_with_weather qry_period_all qry_period_custom qry_coverage
    wx_summary wx_summary_all wx_prompt_block dq_report dq_freshness fn_dates fn_format_metrics
""".split()
NAMES = sorted(catalog.QUERIES) if os.environ.get("TEST_ALL_QUERIES") else SOME

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_of_the_library_has_its_sql():
    assert set(catalog.QUERIES) == set(ORACLES)
    assert {*driver.oracle_sql()} <= {*driver.queries()}


def test_expected_values_are_stated_apart():
    for module in (base, queries):
        assert module.K is values
        assert not any(x is constants for x in vars(module).values())


BANDS = {
    "PACE_ZONES": (activity.pace_zone, lambda: base.ladder("x", values.PACE_ZONES, "<", "no_data")),
    "HR_ZONES": (activity.hr_zone, lambda: base.ladder("x", values.HR_ZONES, "<", "no_hr_data")),
    "TERRAINS": (activity.terrain, lambda: base.ladder("x", values.TERRAINS, "<", "unknown")),
    "DISTANCE_BANDS": (activity.distance_category, lambda: base.distance_class("x")),
}


@pytest.mark.parametrize("name", BANDS)
def test_a_changed_band_shows(spark, monkeypatch, name):
    own, expected = BANDS[name]
    bounds = [b for _, *limits in getattr(values, name) for b in limits if b is not None]
    points = sorted({float(b) + d for b in [0, *bounds] for d in (-0.25, -0.01, 0, 0.01, 0.25)})
    frame = spark.createDataFrame([(None,), *[(x,) for x in points]], "x double")
    rows = ", ".join(f"({x!r}::DOUBLE)" for x in points)
    theirs = dict(duckdb.sql(f"SELECT x, {expected()} FROM (VALUES (NULL), {rows}) t(x)").fetchall())

    def ours():
        return {r.x: r.y for r in frame.select("x", own(F.col("x")).alias("y")).collect()}

    assert ours() == theirs
    label, *limits = getattr(constants, name)[0]
    monkeypatch.setattr(constants, name, [(label, *[b + 0.2 for b in limits]), *getattr(constants, name)[1:]])
    assert ours() != theirs


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_same_result(spark, engine, sf_dir, name):
    df = driver.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = engine.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs_types = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == theirs_types
    ours = Counter(repr(tuple(r[c] for c in columns)) for r in df.collect())
    index = [names.index(c) for c in columns]
    theirs = Counter(repr(tuple(r[i] for i in index)) for r in cursor.fetchall())
    assert ours == theirs
