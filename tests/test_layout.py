import pytest

from cadenza import schemas
from cadenza.catalog import Tables
from cadenza.plans import build, race, unified
from cadenza.session import new_path


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return {n: getattr(t, n) for n in schemas.TABLES}


@pytest.fixture(scope="module")
def silver(spark, raw):
    stored = build.store_silver(raw, 4, "layout_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield stored
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in stored:
        spark.sql(f"DROP TABLE layout_{name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_health_joins_without_a_shuffle(silver):
    joined = unified.unify(silver["stg_activities"], silver["stg_health"])
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)


def test_days_are_summed_without_a_shuffle(silver):
    assert "Exchange" not in plan(race.day_totals(silver["stg_activities"]))


def test_marts_do_not_depend_on_the_layout(spark, raw, silver):
    straight = build.build(raw, new_path(spark, "marts"))
    stored = build.build(raw, new_path(spark, "marts"), silver)
    for name in straight:
        a, b = (build.read_mart(spark, p[name]) for p in (straight, stored))
        rows = [
            sorted(
                str(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
                for r in df.collect()
            )
            for df in (a, b)
        ]
        assert rows[0] == rows[1] and rows[0]


def test_tasks_stay_below_those_for_which_a_shuffle_sorts():
    from cadenza.operators import layout

    assert layout._tasks(400_000, 12, 200) == ()
    assert layout._tasks(36_000_000, 12, 200) == (72,)
    assert layout._tasks(216_000_000, 12, 200) == layout._tasks(171_000_000, 12, 200) == (200,)
    assert layout._tasks(3_000_000_000, 12, 200) == (2000,)
