"""What large tables shuffle, sort and write on their way."""

import datetime as dt

import pytest

from cadenza import catalog, quality_specs, schemas
from cadenza.catalog import Tables
from cadenza.operators import layout
from cadenza.plans import build, health, staging, training
from cadenza.session import new_path
from cadenza.sources import landed, star
from cadenza.streaming import ingest

LOADED = dt.datetime(2025, 3, 20, 6)


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def days():
    start = dt.date(2024, 12, 20)
    return [
        {
            "athlete_id": athlete,
            "date": start + dt.timedelta(days=2 * i),
            "steps": 100 * i + 1,
            "sleep_seconds": None if i % 5 == 0 else 20000 + 300 * i,
            "resting_heart_rate": 50 + i % 7,
        }
        for athlete in (None, 1, 2, 3, 11, 12)
        for i in range(20)
    ]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.collect())


def stored_plan(monkeypatch, write, source):
    """Plan of the rows that a write hands to the table."""
    plans = []
    add = build.MartTable._add

    def seen(table, df, order, *args, **how):
        plans.append(plan(df.sortWithinPartitions(table.BUCKET, *order)))
        add(table, df, order, *args, **how)

    monkeypatch.setattr(build.MartTable, "_add", seen)
    write(source, new_path(source.sparkSession, "mart"))
    return plans[0]


def test_windows_of_the_health_mart_share_one_sort(table, days):
    mart = health.mart_health(staging.stage_health(table("daily_health", days)))
    assert plan(mart).count("Sort [") == 1


def test_the_health_mart_is_stored_with_one_shuffle_of_raw_days(monkeypatch, table, days):
    text = stored_plan(monkeypatch, build.write_health, table("daily_health", days))
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1
    below = text[text.index("Exchange") :]
    assert "rangepartitioning" in below and "sleep_quality" not in below


def test_the_weekly_mart_is_not_shuffled_again_to_be_stored(monkeypatch, table, run_row):
    runs = [run_row(athlete_id=a, activity_id=f"{a}{i}") for a in (None, 1, 2) for i in range(3)]
    staged = staging.stage_activities(table("activities", runs))
    text = stored_plan(monkeypatch, build.write_training, staged)
    assert text.count("Exchange rangepartitioning") == 1 and text.count("Exchange") == 2
    assert text.count("Sort [") == 1


def test_dealt_marts_hold_the_same_rows(spark, table, days, run_row):
    raw, path = table("daily_health", days), new_path(spark, "mart")
    build.write_health(raw, path)
    straight = health.mart_health(staging.stage_health(raw))
    stored = build.read_mart(spark, path)
    assert stored.columns == straight.columns and rows(stored) == rows(straight)
    assert rows(build.read_mart(spark, path, [2, 11])) == rows(straight.filter("athlete_id IN (2, 11)"))

    runs = [
        run_row(athlete_id=a, activity_id=f"{a}-{i}", activity_date=f"2025-0{1 + i % 3}-0{1 + i % 9} 07:30:00")
        for a in (None, 1, 2, 11)
        for i in range(30)
    ]
    staged, path = staging.stage_activities(table("activities", runs)), new_path(spark, "mart")
    build.write_training(staged, path)
    assert rows(build.read_mart(spark, path)) == rows(training.mart_training(staged))


def test_tasks_of_the_dealt_marts_grow_with_their_rows(spark, monkeypatch, table, days, run_row):
    raw = table("daily_health", days)
    straight = rows(health.mart_health(staging.stage_health(raw)))
    runs = [run_row(athlete_id=a, activity_id=f"{a}-{i}") for a in (None, 1, 2, 11) for i in range(30)]
    staged = staging.stage_activities(table("activities", runs))
    assert layout.enough_tasks(raw) == ()  # as many as the session says
    monkeypatch.setattr(layout, "ROWS_A_TASK", 10)
    for write, source in ((build.write_health, raw), (build.write_training, staged)):
        with monkeypatch.context() as m:
            text = stored_plan(m, write, source)
        assert f", {source.count() // 10}), REPARTITION_BY_NUM" in text
    path = new_path(spark, "mart")
    build.write_health(raw, path)
    assert rows(build.read_mart(spark, path)) == straight


def test_tasks_that_sum_health_days_grow_with_the_lines(spark, monkeypatch):
    path = new_path(spark, "star")
    day = "TIMESTAMP_NTZ '2000-01-01' AS o_orderdate"
    orders = ["id AS o_orderkey", "id % 90 AS o_custkey", day, "'x' AS o_orderpriority"]
    spark.range(60).selectExpr(*orders).write.parquet(f"{path}/orders.parquet")
    shipped = "date_add(DATE '2000-01-01', CAST(id % 7 AS INT))"
    lines = spark.range(200).selectExpr("id % 61 AS l_orderkey", f"{shipped} AS l_shipdate", "id % 5 + 1e0 AS l_quantity")
    lines.write.parquet(f"{path}/lineitem.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = Tables(spark, path)._health_days()
        monkeypatch.setattr(layout, "ROWS_A_TASK", 10)
        many = Tables(spark, path)._health_days()
        text = plan(many)
        assert text.count(", 20)") == text.count("Exchange hashpartitioning") == 3
        assert rows(many) == rows(few) and many.count() > 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def star_dir(spark):
    """Orders and lines with repeated and missing keys, of some athletes and days."""
    path = new_path(spark, "star")
    day = "TIMESTAMP_NTZ '2000-01-01' AS o_orderdate"
    customer = "IF(id % 29 = 0, NULL, id * 7 % 400) AS o_custkey"
    spark.range(300).selectExpr("id % 280 AS o_orderkey", customer, day, "'x' AS o_orderpriority").write.parquet(f"{path}/orders.parquet")
    shipped = "date_add(DATE '2001-04-20', CAST(id * 3 % 100 AS INT)) AS l_shipdate"
    lines = spark.range(2000).selectExpr("IF(id % 31 = 0, NULL, id % 290) AS l_orderkey", shipped, "id % 5 + 1e0 AS l_quantity")
    lines.write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.mark.parametrize(
    "name, left",
    [
        ("qry_health_kpis", "partial_avg"),
        ("ctx_hrv_trend", "WindowGroupLimit"),
        ("agg_readiness_distribution", "partial_avg"),
        ("ck_battery_label", "WindowGroupLimit"),
    ],
)
def test_a_query_of_the_health_mart_says_the_same_in_many_tasks(spark, monkeypatch, star_dir, name, left):
    """Its mart is made of one shuffle of raw days, to as many tasks as they need, and the query shuffles little of it."""
    few = rows(catalog.run(name, spark, star_dir))
    monkeypatch.setattr(star, "_written", {})
    monkeypatch.setattr(layout, "ROWS_A_TASK", 100)
    found = []
    text = stored_plan(monkeypatch, lambda *_: found.append(catalog.run(name, spark, star_dir)), spark.range(1))
    tasks = -(-Tables(spark, star_dir).daily_health.count() // 100)
    assert tasks > 4 and text.count("Exchange") == 1 and f", {tasks}), REPARTITION_BY_NUM" in text
    read = plan(found[0])  # reads upwards: the last exchange in it comes first
    assert left in read[read.rindex("Exchange hashpartitioning") :]
    assert rows(found[0]) == few and len(few) > 5


def record(athlete, day, fetch, stats=None, hrv=None, sleep=None):
    return {"athlete_id": athlete, "date": dt.date.fromisoformat(day), "fetch": fetch, "stats": stats, "hrv": hrv, "sleep": sleep}


RECORDS = [
    record(1, "2025-03-05", 1, {"totalSteps": 10}, {"lastNightAvg": 50.0, "status": "LOW"}),
    record(1, "2025-03-06", 1, {"totalSteps": 20}, sleep={"dailySleepDTO": {"sleepTimeSeconds": 700}}),
    record(2, "2025-03-06", 1, hrv={"lastNightAvg": 40.0}),
]


def test_a_record_with_all_payloads_needs_no_join(spark):
    records = spark.createDataFrame(RECORDS, ingest.HEALTH_RECORD)

    def part(name):
        return records.filter(f"{name} IS NOT NULL").select("athlete_id", "date", f"{name}.*")

    found = landed.normalise_health_records(records)
    assert "Join" not in plan(found) and "Exchange" not in plan(found)
    joined = landed.normalise_daily_health(part("stats"), part("hrv"), part("sleep"))
    assert found.schema == joined.schema and rows(found) == rows(joined) and len(rows(found)) == 2


def test_health_records_are_reduced_only_if_a_day_comes_twice(spark, monkeypatch):
    reduced = []
    latest = ingest.latest_per_key
    monkeypatch.setattr(ingest, "latest_per_key", lambda *a: reduced.append(a[1:]) or latest(*a))
    again = record(1, "2025-03-05", 2, {"totalSteps": 11})
    for batch, steps, times in ((RECORDS, {10, 20}, 0), ([*RECORDS, again], {11, 20}, 1)):
        stored = ingest.raw_table(spark, new_path(spark, "days"), "daily_health")
        ingest.load_health(stored, spark.createDataFrame(batch, ingest.HEALTH_RECORD), LOADED)
        assert {r.steps for r in stored.read().collect()} == steps and len(reduced) == times


def test_the_first_load_is_held_against_nothing(spark, table, days, monkeypatch):
    stored = ingest.raw_table(spark, new_path(spark, "days"), "daily_health")
    batch = table("daily_health", [d for d in days if d["athlete_id"]]).drop("inserted_at", "updated_at")
    with monkeypatch.context() as m:
        m.setattr(stored, "known_keys", lambda *a: pytest.fail("an empty table has no keys"))
        stored.insert_new(batch, LOADED)
    stored.insert_new(batch, LOADED)
    assert stored.read().count() == batch.count()


def test_forecast_days_are_dealt_out_before_they_are_ordered(spark):
    daily = {"time": ["2025-03-05"], "temperature_2m_min": [1.0], "temperature_2m_max": [5.0],
             "precipitation_sum": [0.0], "windspeed_10m_max": [3.0], "weathercode": [0]}
    payload = spark.createDataFrame([{"athlete_id": 1, "city": "A", "daily": daily}], schemas.FORECAST_PAYLOAD)
    found = landed.normalise_forecast(payload)
    text = plan(found)  # reads upwards: the last exchange in it comes first
    assert text.count("Exchange hashpartitioning") == 2
    assert "Aggregate" not in text[text.rindex("Exchange hashpartitioning") :]
    assert found.count() == 1


def test_health_days_are_summed_once(spark, sf_dir):
    assert "Join" not in plan(Tables(spark, sf_dir).keyed_health)


def test_data_tests_build_only_tables_that_they_name(spark, sf_dir):
    t = Tables(spark, sf_dir)
    chosen = [x for x in quality_specs.TESTS if x.kind == "expression"]
    assert set(t.tested(chosen)) == {"stg_health", "int_unified", "stg_activities"}
    assert not any(name.startswith("gold") for name in vars(t))
    assert set(t.tested(quality_specs.TESTS)) == set(Tables.TESTED)


def test_payloads_are_read_once(spark, sf_dir):
    """No filter of the joins reads the JSON again to find a missing key."""
    text = plan(catalog.run("norm_daily_health", spark, sf_dir))
    assert "from_json" in text and not any("from_json" in line for line in text.split("\n") if "Filter" in line)
