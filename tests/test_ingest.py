import datetime as dt
import json

import pytest

from cadenza import schemas
from cadenza.session import new_path
from cadenza.sources import landed
from cadenza.streaming import ingest

LOADED = dt.datetime(2025, 3, 8, 6)


@pytest.fixture
def land(tmp_path):
    def write(name, records):
        folder = tmp_path / "landing"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join(json.dumps(r) for r in records))
        return str(folder)

    return write


def activity(ident, fetch=1, **change):
    record = {
        "athlete_id": 1,
        "activityId": ident,
        "activityName": "Lunch run",
        "startTimeLocal": "2025-03-05 12:00:00",
        "activityType": {"typeKey": "running"},
        "distance": 10004.0,
        "duration": 3000.0,
        "fetch": fetch,
    }
    return {**record, **change}


def test_activities_arrive_once_and_weather_later(spark, land):
    table_path, progress = new_path(spark, "t"), new_path(spark, "p")

    def run(landing):
        ingest.ingest_incremental(spark, "activities", landing, table_path, progress, LOADED)
        return {r.activity_id: r for r in ingest.raw_table(spark, table_path, "activities").read().collect()}

    got = run(land("1.json", [activity(1), activity(2, activityType=None, distance=0)]))
    assert got["1"].distance_km == 10.0
    assert got["1"].weather_temp_c is None and got["1"].avg_pace_min_km == 5.0
    assert got["2"].activity_type == "unknown" and got["2"].avg_pace_min_km is None

    weather = json.dumps({"temp": 50, "windSpeed": 18, "weatherTypeDTO": {"desc": "Partly Cloudy"}})
    landing = land(
        "2.json",
        [
            activity(1, fetch=2, activityName="Renamed", weather_json=weather),
            activity(3, fetch=2, activityName="stale"),
            activity(3, fetch=3, activityName="latest"),
        ],
    )
    got = run(landing)
    assert len(got) == 3
    assert got["1"].activity_name == "Lunch run"
    assert got["1"].weather_temp_c == 10.0 and got["1"].weather_wind_speed_ms == 5.0
    assert got["1"].weather_condition == "PARTLY_CLOUDY"
    assert got["3"].activity_name == "latest"
    assert run(landing) == got


def test_health_days_are_insert_only(spark, land):
    table_path, progress = new_path(spark, "t"), new_path(spark, "p")

    def run(landing):
        ingest.ingest_incremental(spark, "daily_health", landing, table_path, progress, LOADED)
        table = ingest.raw_table(spark, table_path, "daily_health")
        return {str(r.date): r for r in table.read().collect()}

    def day(date, steps, **more):
        return {"athlete_id": 1, "date": date, "fetch": 1, "stats": {"totalSteps": steps}, **more}

    night = {"dailySleepDTO": {"sleepTimeSeconds": 27000}}
    got = run(land("1.json", [day("2025-03-04", 4000, sleep=night), day("2025-03-05", 5000)]))
    assert got["2025-03-04"].sleep_seconds == 27000 and got["2025-03-05"].sleep_seconds is None
    got = run(land("2.json", [day("2025-03-05", 9999), day("2025-03-06", 6000)]))
    assert {k: r.steps for k, r in got.items()} == {
        "2025-03-04": 4000,
        "2025-03-05": 5000,
        "2025-03-06": 6000,
    }


def test_calendar_events_are_replaced(spark, land):
    table_path, progress = new_path(spark, "t"), new_path(spark, "p")

    def run(landing):
        ingest.ingest_incremental(spark, "calendar_events", landing, table_path, progress, LOADED)
        table = ingest.raw_table(spark, table_path, "calendar_events")
        return {r.event_uuid: r for r in table.read().collect()}

    def month(name, *items):
        return {"athlete_id": 1, "month": name, "fetch": 1, "calendarItems": list(items)}

    def item(uuid, title, **more):
        race = {"isRace": True, "shareableEventUuid": uuid, "title": title, "date": "2025-03-30"}
        return {**race, **more}

    target = {"value": 21097.5, "unit": "meter", "unitType": "distance"}
    got = run(
        land(
            "1.json",
            [
                month(
                    "2025-03",
                    item("a", "City Half", completionTarget=target),
                    item("w", "Tempo", isRace=False),
                    item("", "By id", id="b"),
                ),
                month("2025-04", item("a", "second listing")),
            ],
        )
    )
    assert set(got) == {"a", "b"}
    assert got["a"].title == "City Half" and got["a"].race_distance_category == "Half Marathon"
    assert got["b"].distance_km is None and got["b"].subscribed is False
    got = run(land("2.json", [month("2025-03", item("a", "City Half 2025"))]))
    assert got["a"].title == "City Half 2025" and set(got) == {"a", "b"}


def test_items_without_any_id_are_all_kept(spark):
    payload = spark.createDataFrame(
        [(1, "2025-03", [(True, "x"), (True, "y")])],
        "athlete_id BIGINT, month STRING, items ARRAY<STRUCT<isRace: BOOLEAN, title: STRING>>",
    )
    full = payload.selectExpr(
        "athlete_id",
        "month",
        "from_json(to_json(items), 'ARRAY<STRUCT<isRace: BOOLEAN, shareableEventUuid: STRING,"
        " id: STRING, title: STRING, date: STRING, location: STRING, completionTarget:"
        " STRUCT<value: DOUBLE, unit: STRING, unitType: STRING>, eventTimeLocal:"
        " STRUCT<startTimeHhMm: STRING, timeZoneId: STRING>, subscribed: BOOLEAN, url: STRING>>')"
        " AS calendarItems",
    )
    assert {r.title for r in landed.normalise_calendar(full).collect()} == {"x", "y"}


def test_weather_shapes(spark):
    shapes = {
        "array": '[{"temp": 57, "condition": " light  rain "}, {"temp": 90}]',
        "object": '{"temp": 57, "weatherType": "Fog"}',
        "empty": "[]",
        "none": None,
    }
    df = spark.createDataFrame(
        [(1, k, v) for k, v in shapes.items()],
        "athlete_id BIGINT, activity_id STRING, weather_json STRING",
    )
    got = {r.activity_id: r for r in landed.normalise_weather(df).collect()}
    assert got["array"].weather_temp_c == 13.9 and got["array"].weather_condition == "LIGHT__RAIN"
    assert got["object"].weather_condition == "FOG"
    assert got["empty"].weather_temp_c is None and got["none"].weather_condition is None


def test_unusable_records_are_put_aside(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    table_path, progress = new_path(spark, "t"), new_path(spark, "p")

    def run(name, lines):
        (folder / name).write_text("\n".join(lines))
        return ingest.ingest_incremental(spark, "activities", str(folder), table_path, progress, LOADED)

    assert run("1.json", [json.dumps(activity(1)), '{"athlete_id": 1, "activ']) == 1
    assert run("2.json", ["no json", json.dumps(activity(None)), json.dumps(activity(2))]) == 2
    stored = ingest.raw_table(spark, table_path, "activities").read()
    assert sorted(r.activity_id for r in stored.collect()) == ["1", "2"]
    aside = [r.record for r in spark.read.parquet(f"{table_path}-quarantine").collect()]
    assert len(aside) == 3 and "no json" in aside
    assert run("3.json", [json.dumps(activity(3))]) == 0


def test_a_day_forecast_twice_is_one_row(spark):
    def fetched(n, low):
        daily = {"time": ["2025-03-08"], "temperature_2m_min": [low], "temperature_2m_max": [9.0]}
        return (1, "Lyon", daily | {"precipitation_sum": [0.0], "windspeed_10m_max": [1.0], "weathercode": [0]}, n)

    payload = spark.createDataFrame([fetched(2, 4.0), fetched(1, 2.0)], f"{schemas.FORECAST_PAYLOAD}, fetch INT")
    rows = landed.normalise_forecast(payload).collect()
    assert [r.temp_min_c for r in rows] == [4.0]
