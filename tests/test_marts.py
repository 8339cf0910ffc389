import datetime as dt

import pytest

from cadenza.plans import health, race, staging, training


@pytest.fixture(scope="module")
def weeks(table, run_row):
    def make(rows):
        raw = table("activities", [run_row(activity_id=str(i), **r) for i, r in enumerate(rows)])
        mart = training.mart_training(staging.stage_activities(raw))
        return {str(r.week_start_date): r for r in mart.collect()}

    return make


def on(day, **change):
    clock = f"{day} 07:30:00"
    return {"activity_date": clock, "start_time_local": clock, **change}


def test_week_label_pairs_iso_week_with_the_monday_year(weeks):
    row = weeks([on("2026-01-01")])["2025-12-29"]
    assert row.week_label == "Week 1, 2025" and (row.year, row.week_number) == (2025, 1)


def test_first_week_has_no_past(weeks):
    row = weeks([on("2025-03-05")])["2025-03-03"]
    assert row.distance_vs_prev_week_pct is None
    assert row.rolling_4wk_avg_distance_km == 10.0
    assert row.distance_trend_4wk == row.training_load_trend_4wk == "Stable"


def test_week_of_walks_has_no_row(weeks):
    assert weeks([on("2025-03-05", activity_type="walking")]) == {}


def test_run_without_pace_weighs_on_the_mean_pace(weeks):
    row = weeks(
        [on("2025-03-05"), on("2025-03-06", avg_pace_min_km=None, distance_km=10.0)]
    )["2025-03-03"]
    assert row.avg_pace_min_per_km == 2.5


def test_frames_count_weeks_with_runs(weeks):
    days = ["2025-01-06", "2025-01-13", "2025-02-10", "2025-03-03", "2025-03-10"]
    got = weeks([on(d, distance_km=10.0 * (i + 1)) for i, d in enumerate(days)])
    assert got["2025-03-10"].rolling_4wk_avg_distance_km == 35.0
    assert got["2025-03-10"].rolling_8wk_avg_distance_km == 30.0
    assert got["2025-02-10"].distance_vs_prev_week_pct == 50.0
    assert got["2025-03-10"].distance_trend_4wk == "Increasing"


def test_fifth_zone_share_is_zero_but_counted_apart(weeks):
    row = weeks([on("2025-03-05", avg_heart_rate=180)])["2025-03-03"]
    assert row.pct_zone5_max == 0.0 and row.pct_zone5_actual == 100.0


@pytest.fixture(scope="module")
def days(table):
    def make(rows):
        raw = table("daily_health", [{"athlete_id": 1, "steps": 5000, **r} for r in rows])
        return {str(r.date): r for r in health.mart_health(staging.stage_health(raw)).collect()}

    return make


def test_lag_of_seven_counts_rows(days):
    dates = [f"2025-03-{d:02d}" for d in (1, 2, 3, 5, 8, 9, 20, 25)]
    got = days([{"date": d, "sleep_seconds": 3600 * (i + 1)} for i, d in enumerate(dates)])
    assert got["2025-03-25"].sleep_change_vs_prev_week == 7.0
    assert got["2025-03-25"].sleep_change_vs_prev_day == 1.0
    assert got["2025-03-20"].sleep_change_vs_prev_week is None
    assert got["2025-03-25"].sleep_7day_avg == 5.0


def test_scores_against_the_own_mean(days):
    got = days(
        [
            {"date": "2025-03-03", "sleep_seconds": 28800, "resting_heart_rate": 50},
            {"date": "2025-03-04", "sleep_seconds": 28800, "resting_heart_rate": 60},
        ]
    )
    first, second = got["2025-03-03"], got["2025-03-04"]
    # 40 sleep + 20 heart + 10 no stress + 10 battery net 0
    assert first.recovery_score == 80.0 and first.training_readiness == "optimal"
    # mean 55: 60 is within 10 %, not within 5 %
    assert second.recovery_score == 70.0 and second.training_readiness == "good"
    assert second.sleep_debt_hours == 0.0 and second.week_total_steps == 10000


def test_weekday_names(days):
    got = days([{"date": "2025-03-09", "sleep_seconds": 3600}])
    assert got["2025-03-09"].day_of_week == "Sunday"
    assert got["2025-03-09"].week_start_date == dt.date(2025, 3, 3)
    assert got["2025-03-09"].month_start_date == dt.date(2025, 3, 1)


@pytest.fixture(scope="module")
def races(table, run_row):
    def make(rows, goals=()):
        raw = table("activities", [run_row(activity_id=str(i), **r) for i, r in enumerate(rows)])
        goal = table("race_goals", list(goals) or [{"athlete_id": 99, "race_date": "2000-01-01"}])
        mart = race.mart_race(staging.stage_activities(raw), goal)
        return {r.race_id: r for r in mart.collect()}

    return make


def test_race_without_training_still_counts_one_run(races):
    row = races([on("2025-03-05", event_type="race")])["0"]
    assert (row.training_runs_30d, row.total_training_distance_30d) == (1, None)
    assert row.race_readiness_score == 5 and row.pacing_assessment == "No training data"
    assert row.recovery_status == "First race" and row.performance_rating == "PR"


def test_thirty_days_before_count_the_race_day_does_not(races):
    got = races(
        [
            on("2025-03-31", event_type="race"),
            on("2025-03-01", distance_km=11.0, activity_type="cycling"),
            on("2025-02-28", distance_km=13.0),
            on("2025-03-31", distance_km=17.0),
        ]
    )["0"]
    assert got.total_training_distance_30d == 11.0 and got.training_runs_30d == 1


def test_race_outside_the_bands_has_no_record(races):
    row = races([on("2025-03-05", event_type="race", distance_km=15.0)])["0"]
    assert row.race_distance_category is None and not row.is_personal_record
    assert row.pct_off_pr is None and row.performance_rating == "Off Day"


@pytest.mark.parametrize(
    "seconds, label",
    [
        (2580, "Goal achieved ✅"),
        (2628, "Just missed (<2%)"),
        (2634, "Close (2–5%)"),
        (2706, "Close (2–5%)"),
        (2712, "Missed goal (>5%)"),
    ],
)
def test_goal_outcomes(races, seconds, label):
    goal = {
        "athlete_id": 1,
        "race_date": "2025-03-05",
        "race_name": "Park 10K",
        "goal_time_seconds": 2580,
    }
    row = races([on("2025-03-05", event_type="race", duration_minutes=seconds / 60)], [goal])["0"]
    assert row.goal_achievement == label and row.goal_race_name == "Park 10K"


def test_no_goal(races):
    row = races([on("2025-03-05", event_type="race")])["0"]
    assert row.goal_achievement == "No goal set" and row.seconds_vs_goal is None


def test_finish_time(races):
    got = races(
        [
            on("2025-03-05", event_type="race", duration_minutes=59.5),
            on("2025-03-06", event_type="race", duration_minutes=125.25),
        ]
    )
    assert got["0"].finish_time_formatted == "0:59:30"
    assert got["1"].finish_time_formatted == "2:05:15"


def test_recovery_status_by_days_since_the_last_race(races):
    gaps = {6: "Quick turnaround", 7: "Standard recovery", 14: "Standard recovery", 15: "Well rested"}
    for days_, label in gaps.items():
        later = str(dt.date(2025, 3, 1) + dt.timedelta(days=days_))
        row = races([on("2025-03-01", event_type="race"), on(later, event_type="race")])["1"]
        assert (row.days_since_last_race, row.recovery_status) == (days_, label)
