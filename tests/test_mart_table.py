"""Marts in athlete buckets, whole or not at all, rebuilt only where something changed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.plans import build
from cadenza.session import new_path
from cadenza.streaming import ingest

FIRST, LATER = dt.datetime(2025, 3, 1, 6), dt.datetime(2025, 3, 8, 6)
ATHLETES = range(1, 41)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(a, w, float(a * w)) for a in ATHLETES for w in range(5)], "athlete_id long, week int, km double")


@pytest.fixture
def mart(spark, rows):
    made = build.MartTable(spark, new_path(spark, "mart"))
    made.write(rows)
    return made


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_reader_of_one_athlete_opens_one_file(mart, rows):
    assert values(mart.read()) == values(rows)
    one = mart.read(athletes=[7])
    assert len(one.inputFiles()) == 1 < len(mart.read().inputFiles())
    assert values(one) == values(rows.filter("athlete_id = 7"))
    assert mart.read(athletes=[999]).count() == 0
    assert values(mart.read(athletes=[3, 4])) == values(rows.filter("athlete_id IN (3, 4)"))


def test_only_the_buckets_of_changed_athletes_are_stored_anew(mart, rows, spark):
    before = mart.version()
    ids = spark.createDataFrame([(3,), (99,)], "athlete_id long")
    fresh = spark.createDataFrame([(3, 0, -1.0), (99, 0, 5.0)], rows.schema)
    mart.rebuild(fresh, ids)
    assert values(mart.read()) == values(rows.filter("athlete_id <> 3").unionByName(fresh))
    after = mart.version()
    same = [b for b in before.parts if after.parts[b] == before.parts[b]]
    assert len(same) >= len(before.parts) - 2 and after.number == before.number + 1
    mart.rebuild(fresh.limit(0), ids)
    assert values(mart.read()) == values(rows.filter("athlete_id <> 3"))
    assert values(mart.read(version=before.number)) == values(rows)


def test_a_rebuild_cut_short_leaves_the_mart(mart, rows, monkeypatch):
    def cut(version):
        raise RuntimeError("killed")

    monkeypatch.setattr(mart.log, "commit", cut)
    with pytest.raises(RuntimeError, match="killed"):
        mart.write(rows.limit(3))
    assert values(mart.read()) == values(rows)


def activities_of(table, run_row):
    out = []
    for a in range(1, 9):
        for m in range(1, 7):
            race = {"event_type": "race"} if m % 3 == 0 else {}
            out.append(run_row(athlete_id=a, activity_id=f"{a}-{m}", activity_date=f"2025-0{m}-1{a % 9} 07:00:00", distance_km=10.0 + a, **race))
    return table("activities", out).drop("inserted_at", "updated_at")


def test_changed_athletes_of_each_kind_of_load(spark, table, run_row):
    store = ingest.raw_table(spark, new_path(spark, "activities"), "activities")
    store.replace(activities_of(table, run_row), FIRST)

    def changed(load):
        since = store.version().number
        load()
        return sorted(r[0] for r in store.changed(since, ["athlete_id"]).collect())

    def batch(*of, **change):
        return table("activities", [run_row(**r, **change) for r in of]).drop("inserted_at", "updated_at")

    new = [{"athlete_id": 2, "activity_id": "x", "activity_date": "2025-06-20 07:00:00"}]
    assert changed(lambda: store.insert_new(batch(*new), LATER)) == [2]
    old = [{"athlete_id": a, "activity_id": f"{a}-1", "activity_date": f"2025-01-1{a} 07:00:00"} for a in (3, 4)]
    assert changed(lambda: store.insert_new(batch(*old), LATER)) == []
    assert changed(lambda: store.backfill_weather(batch(*old, weather_temp_c=3.0), LATER)) == [3, 4]
    assert changed(lambda: store.delete(batch(*old[:1]))) == [3]
    assert changed(lambda: store.compact(0)) == []


def test_marts_after_a_load_equal_a_full_rebuild(spark, table, run_row):
    store = ingest.raw_table(spark, new_path(spark, "activities"), "activities")
    store.replace(activities_of(table, run_row), FIRST)
    others = {n: spark.createDataFrame([], schemas.TABLES[n]) for n in schemas.TABLES if n != "activities"}
    others["daily_health"] = table("daily_health", [{"athlete_id": a, "date": "2025-03-01", "steps": 100 * a} for a in range(1, 9)])
    out, whole = new_path(spark, "marts"), new_path(spark, "marts")
    build.build({**others, "activities": store.read()}, out)

    since = store.version().number
    day = [run_row(athlete_id=5, activity_id="new", activity_date="2025-03-20 07:00:00", distance_km=15.0, duration_minutes=50.0, event_type="race")]
    store.insert_new(table("activities", day).drop("inserted_at", "updated_at"), LATER)
    files = {n: build.MartTable(spark, f"{out}/{n}").version().parts for n in ("mart_training", "mart_race", "mart_health")}
    raw = {**others, "activities": store.read()}
    goals = others["race_goals"].select("athlete_id")
    build.update(raw, out, activities=store.changed(since, ["athlete_id"]), goals=goals)
    build.build(raw, whole)
    for name, before in files.items():
        got, want = (build.read_mart(spark, f"{p}/{name}") for p in (out, whole))
        assert got.columns == want.columns and values(got) == values(want)
        after = build.MartTable(spark, f"{out}/{name}").version().parts
        changed = [b for b in after if after[b] != before.get(b)]
        assert len(changed) == (0 if name == "mart_health" else 1)
        if changed:
            kept = build.read_mart(spark, f"{out}/{name}", athletes=[5])
            assert kept.filter(F.col("athlete_id") == 5).count() > 0


def test_a_rebuild_of_dealt_rows_keeps_the_other_athletes(mart, rows, spark):
    ids = spark.createDataFrame([(3,), (4,), (99,)], "athlete_id long")
    fresh = spark.createDataFrame([(4, 0, -1.0), (99, 0, 5.0)], rows.schema)
    mart.rebuild(mart.deal(fresh, (3,)), ids, dealt=True)
    kept = rows.filter("athlete_id NOT IN (3, 4)")
    assert mart.read().columns == rows.columns
    assert values(mart.read()) == values(kept.unionByName(fresh))
    mart.rebuild(mart.deal(fresh.limit(0)), ids, dealt=True)
    assert values(mart.read()) == values(kept)
    assert values(mart.read(athletes=[5])) == values(rows.filter("athlete_id = 5"))


def test_changed_athletes_are_found_once_and_held_against_without_a_shuffle(spark, table, run_row, monkeypatch):
    """The athletes of an update come from a file, and only narrow or dealt rows are shuffled."""
    seen = {}
    monkeypatch.setattr(
        build.MartTable, "rebuild", lambda self, rows, athletes, dealt=False: seen.update({self.path: (rows, athletes, dealt)})
    )
    raw = {n: spark.createDataFrame([], schemas.TABLES[n]) for n in schemas.TABLES}
    store = ingest.raw_table(spark, new_path(spark, "activities"), "activities")
    store.replace(activities_of(table, run_row), FIRST)
    changed = store.changed(0, ["athlete_id"])
    build.update({**raw, "activities": store.read()}, "/marts", activities=changed)
    assert set(seen) == {"/marts/mart_training", "/marts/mart_race"}
    for rows, athletes, _ in seen.values():
        assert athletes.inputFiles() and sorted(r[0] for r in athletes.collect()) == list(range(1, 9))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "LeftSemi, BuildRight" in plan
    training, _, dealt = seen["/marts/mart_training"]
    plan = training._jdf.queryExecution().executedPlan().toString()
    # runs to their weeks, weeks to their bucket, and the athletes; the wide rows are not dealt out again
    assert dealt and plan.count("REPARTITION_BY_COL") == 2 and "REBALANCE" not in plan
    assert "ENSURE_REQUIREMENTS" not in plan.replace("BroadcastExchange", "")


def test_the_rebuilt_marts_tables_are_read_where_they_come_from(spark, sf_dir, monkeypatch):
    """Of the raw tables only the goals, which are read twice, are written before the job."""
    from cadenza import catalog
    from cadenza.sources import star

    written = []
    once = star.StarTables._once
    monkeypatch.setattr(star.StarTables, "_once", lambda self, name, *how: written.append(name) or once(self, name, *how))
    got = catalog.run("sink_mart_changes", spark, sf_dir)
    assert set(written) == {"race_goals", "health-days"}
    assert values(got) == values(catalog.run("sink_mart_race", spark, sf_dir))


def test_projected_tables_are_the_stored_ones(spark, sf_dir):
    from cadenza.catalog import Tables

    t = Tables(spark, sf_dir)
    for name, schema in schemas.TABLES.items():
        made = t.projected(name)
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in schema]
        assert values(made) == values(getattr(t, name))
