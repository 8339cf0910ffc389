"""What the physical plans must and must not hold."""

import pytest

from cadenza import catalog

WINDOWED = [
    "mart_training",
    "mart_health",
    "mart_race",
    "win_days_since_pr",
    "qry_recent_activities",
    "qry_half_over_half",
    "coaching_context",
    "wx_summary",
    "agg_readiness_distribution",
]


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(spark, sf_dir, name):
    return catalog.run(name, spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", WINDOWED)
def test_no_window_runs_in_one_task(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "Window" in text
    assert "SinglePartition" not in text


@pytest.mark.parametrize("name", [*WINDOWED, "int_unified", "join_range_30d", "alerts"])
def test_no_pairs_join(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_validity_test_reaches_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "agg_week_counts")
    assert "GreaterThan(distance_km,0.0)" in text
    assert "GreaterThanOrEqual(duration_minutes,5.0)" in text
    assert "EqualTo(activity_type,running)" in text


def test_races_are_found_in_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "mart_race")
    scans = [line for line in text.split("\n") if "FileScan" in line and "activity_id" in line or "is_race" in line and "FileScan" in line]
    assert sum("EqualTo(is_race,true)" not in line for line in scans) <= 1
    assert any("EqualTo(is_race,true)" in line for line in scans)


def test_scan_reads_only_what_the_mart_needs(spark, sf_dir):
    text = plan(spark, sf_dir, "mart_training")
    schema = text[text.index("ReadSchema") :].split("\n")[0]
    assert "weather_temp_c" not in schema and "device_name" not in schema


def test_health_mart_shuffles_once(spark, sf_dir):
    assert plan(spark, sf_dir, "mart_health").count("Exchange hashpartitioning") == 1


def test_top_n_is_cut_before_the_shuffle(spark, sf_dir):
    text = plan(spark, sf_dir, "qry_recent_activities")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_activities_join_health_by_day(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, sf_dir, "int_unified")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert joins and all("activity_date" in line for line in joins)


def test_newest_weeks_are_cut_before_they_are_summed(spark, sf_dir):
    lines = plan(spark, sf_dir, "agg_week_health").split("\n")  # the plan reads upwards
    sums = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    cuts = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    assert sums and cuts and max(sums) < min(cuts)


def test_only_shown_weeks_of_health_are_summed(spark, sf_dir):
    lines = plan(spark, sf_dir, "join_week_training_health").split("\n")
    sums = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    semis = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    assert sums and len(semis) >= 2 and max(sums) < max(semis)
