"""All athletes at once give what each athlete gives alone."""

import pytest
from pyspark.sql import functions as F

from cadenza import catalog
from cadenza.plans import coaching, health, race, staging, training
from cadenza.sources.star import AS_OF


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return catalog.Tables(spark, sf_dir)


def jobs(t, one=None):
    def of(df):
        return df if one is None else df.filter(F.col("athlete_id") == one)

    activities = staging.stage_activities(of(t.activities))
    days = staging.stage_health(of(t.daily_health))
    weekly, daily = training.mart_training(activities), health.mart_health(days)
    races = race.mart_race(activities, of(t.race_goals))
    goals = coaching.newest_goal(of(t.analysis_log))
    return {
        "weekly": weekly,
        "daily": daily,
        "races": races,
        "context": coaching.coaching_context(weekly, daily, races, goals, AS_OF),
    }


@pytest.mark.parametrize("name", ["weekly", "daily", "races", "context"])
def test_union_of_single_athletes(tables, name):
    def rows(df):
        return sorted(
            str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.collect()
        )

    athletes = [r[0] for r in tables.activities.select("athlete_id").distinct().collect()]
    alone = []
    for athlete in athletes[:2]:
        alone += rows(jobs(tables, athlete)[name])
    together = jobs(tables)[name].filter(F.col("athlete_id").isin(athletes[:2]))
    assert rows(together) == sorted(alone)
