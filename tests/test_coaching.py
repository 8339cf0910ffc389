import datetime as dt

import pytest

from cadenza.plans import coaching
from cadenza.plans import weather as wx

DEFAULT = {
    "athlete_id": 1,
    "goal_distance": "10K",
    "goal_time_minutes": 45.0,
    "goal_pace_min_per_km": 4.5,
    "weeks_to_race": 8,
    "avg_weekly_km": 40.0,
    "avg_weekly_load": 300.0,
    "load_trend_pct": 5.5,
    "acwr": 1.0,
    "avg_pace_min_per_km": 5.5,
    "pct_easy": 70.0,
    "pct_hard": 30.0,
    "avg_sleep_hours": 7.2,
    "avg_hrv": 55.0,
    "hrv_trend_pct": 0.0,
    "avg_resting_hr": 50.0,
    "avg_stress": 30.0,
    "avg_recovery_score": 70.0,
    "avg_readiness": None,
    "last_race_distance": "10K",
    "last_race_pace_min_per_km": 5.0,
    "pr_5k_pace": None,
    "pr_10k_pace": 4.9,
    "pr_half_pace": None,
    "pr_marathon_pace": None,
}
_TEXT = ("goal_distance", "last_race_distance")
_WHOLE = {"athlete_id": "BIGINT", "weeks_to_race": "INT"}
DDL = ", ".join(f"{n} {_WHOLE.get(n, 'STRING' if n in _TEXT else 'DOUBLE')}" for n in DEFAULT)


@pytest.fixture(scope="module")
def context(spark):
    def make(**change):
        return spark.createDataFrame([tuple({**DEFAULT, **change}.values())], DDL)

    return make


def raised(df):
    return [(r.level, r.emoji) for r in coaching.alerts(df).collect()]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({"acwr": 1.3}, []),
        ({"acwr": 1.31}, [("yellow", "🟡")]),
        ({"acwr": 1.5}, [("yellow", "🟡")]),
        ({"acwr": 1.51}, [("red", "🔴")]),
        ({"hrv_trend_pct": -10.0}, []),
        ({"hrv_trend_pct": -10.1}, [("yellow", "🟡")]),
        ({"hrv_trend_pct": -20.0}, [("yellow", "🟡")]),
        ({"hrv_trend_pct": -20.1}, [("red", "🔴")]),
        ({"hrv_trend_pct": None}, []),
        ({"avg_sleep_hours": 6.5}, []),
        ({"avg_sleep_hours": 6.4}, [("yellow", "🟡")]),
        ({"avg_sleep_hours": 4.9}, [("red", "🔴")]),
        ({"avg_recovery_score": 39.0}, [("red", "🔴")]),
        ({"avg_recovery_score": None}, []),
        ({"goal_pace_min_per_km": 3.6}, [("yellow", "🎯")]),
        ({"goal_pace_min_per_km": 3.7}, []),
        ({"pr_10k_pace": None, "goal_pace_min_per_km": 3.7}, [("yellow", "🎯")]),
    ],
)
def test_thresholds(context, change, expected):
    assert raised(context(**change)) == expected


def test_red_alerts_come_first(context):
    df = context(acwr=1.4, hrv_trend_pct=-30.0, avg_recovery_score=10.0, goal_pace_min_per_km=3.0)
    assert raised(df) == [("red", "🔴"), ("red", "🔴"), ("yellow", "🟡"), ("yellow", "🎯")]


def test_alert_text(context):
    message = coaching.alert(context(acwr=1.62), "load").first().message
    assert message.startswith("Training load spike: ACWR is 1.62 (>1.5 = high injury risk).")
    assert "Acute load is 162% of your chronic baseline." in message


def test_prompt_names_missing_values(context):
    text = coaching.prompt_text(context(avg_hrv=None, hrv_trend_pct=None)).first().prompt
    lines = text.split("\n")
    assert lines[0] == "ATHLETE DATA — last 4 weeks"
    assert "- HRV: N/A (trend vs 4-week avg: N/A)" in lines
    assert "- Load trend: +6% vs previous 4 weeks" in lines
    assert "- Training readiness: N/A" in lines
    assert "- PRs: 5K N/A | 10K 4:54 | Half N/A | Marathon N/A" in lines
    assert "- Target time: 0h45" in lines
    assert lines[-1] == "- Time to race: 8 weeks"


def test_prompt_takes_a_weather_block(context, spark):
    weather = spark.createDataFrame([(1, "RAIN")], "athlete_id BIGINT, weather_text STRING")
    text = coaching.prompt_text(context(), weather).first().prompt
    assert text.endswith("- Time to race: 8 weeks\n\n\nRAIN")


def test_weeks_left_are_never_negative(spark):
    goals = spark.createDataFrame(
        [(1, "Marathon", 240.0, dt.date(2025, 1, 1)), (2, "Ultra", 240.0, dt.date(2025, 3, 25))],
        "athlete_id BIGINT, goal_distance STRING, goal_time_minutes DOUBLE, race_date DATE",
    )
    got = {r.athlete_id: r for r in coaching.goal_context(goals, dt.date(2025, 3, 5)).collect()}
    assert got[1].weeks_to_race == 0 and got[1].goal_pace_min_per_km == 5.69
    assert got[2].weeks_to_race == 2 and got[2].goal_pace_min_per_km == 11.38


@pytest.mark.parametrize("n, known", [(4, False), (5, True)])
def test_weather_summary_needs_five_runs(table, run_row, n, known):
    rows = [run_row(activity_id=str(i), weather_temp_c=10.0) for i in range(n)]
    got = wx.weather_summary(wx.weather_runs(table("activities", rows))).first()
    assert (got.summary is not None) == known
    if known:
        assert got.summary.split("\n")[:3] == [
            "Historical weather impact (based on 5 runs with weather data):",
            "Temperature vs pace:",
            "  Cool (5–15°C): avg pace 5:00/km (5 runs)",
        ]


def test_only_the_newest_runs_count(table, run_row):
    rows = [
        run_row(activity_id=str(i), weather_temp_c=10.0, activity_date=f"2025-03-0{i + 1} 07:00:00")
        for i in range(4)
    ]
    raw = table("activities", rows)
    assert {r.activity_id for r in wx.weather_runs(raw, latest=2).collect()} == {"2", "3"}
    assert wx.weather_runs(raw, latest=None).count() == 4


def test_an_athlete_without_a_goal_has_context_alerts_and_prompt(spark):
    from cadenza.plans.coaching import alerts, coaching_context, prompt_text

    training = spark.createDataFrame(
        [(1, dt.date(2025, 3, 3), 10.0, 900.0, 5.0, 40.0, 20.0), (1, dt.date(2025, 2, 24), 10.0, 100.0, 5.0, 40.0, 20.0)],
        "athlete_id long, week_start_date date, total_distance_km double, total_training_load double,"
        " avg_pace_min_per_km double, pct_zone1_easy double, pct_zone2_moderate double",
    )
    health = spark.createDataFrame(
        [(2, dt.date(2025, 3, 8), 4.0, 50.0, 50, 30, 20, "low")],
        "athlete_id long, date date, total_sleep_hours double, hrv_numeric double, resting_heart_rate int,"
        " average_stress_level int, recovery_score int, training_readiness string",
    )
    race = spark.createDataFrame(
        [], "athlete_id long, race_number int, race_distance_category string, pace_min_per_km double"
    )
    goals = spark.createDataFrame(
        [], "athlete_id long, goal_distance string, goal_time_minutes double, race_date date"
    )
    context = coaching_context(training, health, race, goals, dt.date(2025, 3, 9))
    assert sorted(r.athlete_id for r in context.collect()) == [1, 2]
    assert {(r.athlete_id, r.level) for r in alerts(context).collect()} >= {(1, "red"), (2, "red")}
    prompts = {r.athlete_id: r.prompt for r in prompt_text(context).collect()}
    assert prompts.keys() == {1, 2} and all("N/A" in p for p in prompts.values())
