"""Ordered reads over one very busy athlete against a plain loop."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators.windows import newest
from cadenza.plans import race, staging, training

SEED_ROWS = 400


@pytest.fixture(scope="module")
def busy(table):
    """A third of all activities belong to athlete 0, many on the same days."""
    rng = random.Random(7)
    rows = []
    for i in range(SEED_ROWS):
        athlete = 0 if i % 3 == 0 else rng.randrange(1, 20)
        day = dt.datetime(2025, 1, 1, 8) + dt.timedelta(days=rng.randrange(60))
        rows.append(
            {
                "athlete_id": athlete,
                "activity_id": f"{i:04d}",
                "activity_date": str(day),
                "start_time_local": str(day),
                "activity_type": "running",
                "event_type": "race" if rng.random() < 0.5 else None,
                "distance_km": rng.choice([5.0, 10.0, 15.0, 21.1]),
                "duration_minutes": float(rng.randrange(20, 120)),
                "avg_pace_min_km": rng.choice([None, 4.5, 5.0, 5.25, 6.5]),
            }
        )
    return table("activities", rows)


def test_race_history_matches_a_loop(busy, table):
    staged = staging.stage_activities(busy)
    goals = table("race_goals", [{"athlete_id": 99, "race_date": "2000-01-01"}])
    got = {r.race_id: r for r in race.mart_race(staged, goals).collect()}
    rows = sorted(staged.collect(), key=lambda r: (r.activity_date, r.activity_id))
    assert len(got) == sum(r.is_race for r in rows)

    seen: dict[int, list] = {}
    for r in rows:
        if not r.is_race:
            continue
        past = seen.setdefault(r.athlete_id, [])
        out = got[r.activity_id]
        assert out.race_number == len(past) + 1
        gap = (r.activity_date - past[-1].activity_date).days if past else None
        assert out.days_since_last_race == gap

        same = [p for p in past if p.race_distance_category == r.race_distance_category]
        paces = [p.avg_pace_min_km for p in (*same[-2:], r) if p.avg_pace_min_km is not None]
        mean = sum(paces) / len(paces) if paces else None
        assert out.pace_ma_3_races == (pytest.approx(mean, abs=0.006) if paces else None)
        if same and r.avg_pace_min_km is not None and same[-1].avg_pace_min_km is not None:
            change = r.avg_pace_min_km - same[-1].avg_pace_min_km
            assert out.pace_change_vs_last_race == pytest.approx(change, abs=0.006)
        else:
            assert out.pace_change_vs_last_race is None

        window = [
            t
            for t in rows
            if t.athlete_id == r.athlete_id
            and not t.is_race
            and 1 <= (r.activity_date - t.activity_date).days <= 30
        ]
        assert out.training_runs_30d == max(1, len(window))
        km = sum(t.distance_km for t in window) if window else None
        assert out.total_training_distance_30d == (pytest.approx(km, abs=0.06) if window else None)

        equals = [
            p.duration_minutes
            for p in rows
            if p.is_race
            and p.athlete_id == r.athlete_id
            and p.race_distance_category == r.race_distance_category
        ]
        graded = r.race_distance_category is not None
        assert out.is_personal_record == (graded and r.duration_minutes == min(equals))
        past.append(r)


def test_days_since_record_matches_a_loop(busy):
    staged = staging.stage_activities(busy)
    races = race.races(staged)
    known = race.with_distance_history(races, race.distance_days(races))
    rows = race.days_since_record(known).collect()
    first: dict[tuple, dt.date] = {}
    for r in rows:
        key = (r.athlete_id, r.race_distance_category, r.is_personal_record)
        first[key] = min(first.get(key, r.race_date), r.race_date)
    for r in rows:
        key = (r.athlete_id, r.race_distance_category, r.is_personal_record)
        assert r.days_since_pr == (r.race_date - first[key]).days


def test_newest_in_parts_matches_a_sort(busy):
    order = (F.col("activity_date").desc(), F.col("activity_id").desc())
    slim = busy.select("athlete_id", "activity_id", "activity_date")
    spread = newest(slim, 5, *order, spread_by="activity_id")
    rows = sorted(slim.collect(), key=lambda r: (r.activity_date, r.activity_id), reverse=True)
    expected = set()
    for athlete in {r.athlete_id for r in rows}:
        expected |= {r.activity_id for r in [r for r in rows if r.athlete_id == athlete][:5]}
    assert {r.activity_id for r in spread.collect()} == expected


def test_marts_do_not_depend_on_the_number_of_tasks(busy, table):
    staged = staging.stage_activities(busy)
    goals = table("race_goals", [{"athlete_id": 0, "race_date": "2025-01-09", "goal_time_seconds": 3000}])

    def rows(df):
        return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.collect())

    assert rows(race.mart_race(staged, goals, (3,))) == rows(race.mart_race(staged, goals))
    weeks = training.dealt_mart(staged, lambda w: w.withColumn("b", F.lit(0)).repartitionByRange(3, "b", "athlete_id"), ("b",), (5,))
    assert rows(weeks.drop("b")) == rows(training.mart_training(staged))


def test_days_of_a_busy_athlete_are_dealt_out_in_many_tasks(busy):
    plan = race.day_context(staging.stage_activities(busy), (7,))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in plan
