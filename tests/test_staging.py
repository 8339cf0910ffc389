import datetime as dt

import pytest

from cadenza.plans import dashboard, staging, unified


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.fixture(scope="module")
def enriched(table, run_row):
    def make(**change):
        return one(staging.enrich_activities(table("activities", [run_row(**change)])))

    return make


def test_pace_of_a_device_fault_is_recomputed(enriched):
    assert enriched(avg_pace_min_km=145.0).avg_pace_min_km == 5.0


def test_missing_pace_stays_missing_in_staging_only(table, run_row, enriched):
    row = enriched(avg_pace_min_km=None)
    assert row.avg_pace_min_km is None and row.pace_zone == "no_data"
    raw = table("activities", [run_row(avg_pace_min_km=None, weather_temp_c=12.0)])
    assert one(dashboard.weather_activities(raw)).avg_pace_min_km == 5.0


@pytest.mark.parametrize(
    "change", [{"distance_km": 0.0}, {"distance_km": None}, {"duration_minutes": 4.99}]
)
def test_invalid_activities_are_dropped(table, run_row, change):
    assert staging.stage_activities(table("activities", [run_row(**change)])).count() == 0


def test_five_minutes_are_enough(table, run_row):
    raw = table("activities", [run_row(duration_minutes=5.0)])
    assert staging.stage_activities(raw).count() == 1


def test_distance_bands(table, run_row):
    expected = {
        4.8: "5K",
        5.2: "5K",
        5.21: None,
        10.3: "10K",
        20.9: "Half Marathon",
        42.0: "Marathon",
        43.0: "Marathon",
        43.01: "Ultra",
    }
    rows = [run_row(activity_id=str(km), distance_km=km) for km in expected]
    got = staging.enrich_activities(table("activities", rows)).collect()
    assert {r.distance_km: r.race_distance_category for r in got} == expected


def test_race_words_match_inside_words(enriched):
    assert enriched(activity_name="Terrace jog").is_race
    assert enriched(activity_name="TRAIL loop").is_race
    assert enriched(activity_name=None, event_type="RACE").is_race
    assert not enriched(activity_name="Morning Run", event_type="training").is_race


def test_effort_with_missing_values(enriched):
    assert enriched(avg_heart_rate=140, avg_pace_min_km=None).effort_level == "moderate"
    assert enriched(avg_heart_rate=155, avg_pace_min_km=None).effort_level == "hard"
    assert enriched(avg_heart_rate=None).effort_level == "unknown"
    assert enriched(avg_heart_rate=120, avg_pace_min_km=7.0).effort_level == "easy"
    assert enriched(avg_heart_rate=140, avg_pace_min_km=6.0).effort_level == "moderate"


def test_training_load_factors(enriched):
    assert enriched(avg_heart_rate=None, duration_minutes=60.0).training_load == 60.0
    for hr, load in {129: 60.0, 130: 90.0, 149: 90.0, 150: 120.0, 169: 120.0, 170: 150.0}.items():
        assert enriched(avg_heart_rate=hr, duration_minutes=60.0).training_load == load


def test_time_of_day(enriched):
    expected = {4: "night", 5: "morning", 11: "morning", 12: "afternoon"}
    expected |= {17: "afternoon", 18: "evening", 21: "evening", 22: "night"}
    for hour, label in expected.items():
        assert enriched(start_time_local=f"2025-03-05 {hour:02d}:10:00").time_of_day == label


def test_weekday_counts_from_sunday(enriched):
    sunday = enriched(start_time_local="2025-03-09 08:00:00")
    assert sunday.day_of_week == 0 and sunday.is_weekend


def day(**change):
    row = {"athlete_id": 1, "date": "2025-03-05", "steps": 8000, "sleep_seconds": 27000}
    return {**row, **change}


@pytest.fixture(scope="module")
def health_day(table):
    def make(**change):
        return one(staging.enrich_health(table("daily_health", [day(**change)])))

    return make


def test_day_without_any_reading_is_dropped(table):
    raw = table("daily_health", [day(steps=0, sleep_seconds=None)])
    assert staging.stage_health(raw).count() == 0


def test_sleep_efficiency_needs_sleep(health_day):
    assert health_day(sleep_seconds=None, awake_seconds=600).sleep_efficiency_pct is None
    assert health_day(sleep_seconds=27000, awake_seconds=3000).sleep_efficiency_pct == 90.0


def test_score_of_a_day_with_steps_only(health_day):
    row = health_day(steps=1, sleep_seconds=None)
    assert row.recovery_score == 31.0 and row.sleep_quality == "no_data"


def test_score_of_a_perfect_day(health_day):
    row = health_day(
        sleep_seconds=28800, stress_avg=25, body_battery_high=75, resting_heart_rate=44
    )
    assert row.recovery_score == 100.0


def test_inclusive_category_bounds(health_day):
    row = health_day(stress_avg=50, body_battery_high=25, hrv_avg=40.0, sleep_seconds=25200)
    assert (row.stress_category, row.body_battery_status) == ("moderate", "low")
    assert (row.hrv_category, row.sleep_quality) == ("good", "excellent")


def test_calendar_countdown(table):
    as_of = dt.date(2025, 3, 5)
    rows = [
        {"athlete_id": 1, "event_uuid": "today", "event_date": "2025-03-05"},
        {"athlete_id": 1, "event_uuid": "past", "event_date": "2024-12-31"},
    ]
    got = {r.event_uuid: r for r in staging.stage_calendar(table("calendar_events", rows), as_of).collect()}
    assert got["today"].is_upcoming and got["today"].days_until_race == 0
    assert got["today"].race_season == "Spring"
    assert not got["past"].is_upcoming and got["past"].race_season == "Winter"


@pytest.fixture(scope="module")
def unify(table, run_row):
    def make(activity, health):
        raw = table("activities", [run_row(**activity)])
        days = table("daily_health", [day(**health)])
        return one(unified.unify(staging.stage_activities(raw), staging.stage_health(days)))

    return make


def test_no_health_that_day(unify):
    row = unify({}, {"date": "2025-03-04"})
    assert row.is_missing_health_context and row.recovery_score is None
    assert row.training_readiness == row.workout_context == "no_data"
    assert not row.ran_while_tired


def test_hard_run_on_a_bad_day_is_overreaching(unify):
    row = unify(
        {"avg_heart_rate": 165},
        {"sleep_seconds": 15000, "stress_avg": 90, "body_battery_high": 10, "resting_heart_rate": 80},
    )
    assert row.recovery_score == 0.0 and row.training_readiness == "low"
    assert row.workout_context == "overreaching" and row.ran_while_tired


def test_unknown_effort_is_normal_when_health_is_known(unify):
    row = unify({"avg_heart_rate": None}, {})
    assert row.workout_context == "normal" and row.training_load == 50.0
