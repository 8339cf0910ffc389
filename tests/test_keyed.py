import datetime as dt

import pytest

from cadenza import schemas
from cadenza.operators.keyed import DuplicateKeys, MonthTable
from cadenza.session import new_path

FIRST, LATER = dt.datetime(2025, 3, 1, 6), dt.datetime(2025, 3, 8, 6)


@pytest.fixture
def activities(spark):
    return MonthTable(
        spark,
        new_path(spark, "test-activities"),
        schemas.ACTIVITIES,
        schemas.KEYS["activities"],
        "activity_date",
    )


@pytest.fixture
def events(spark):
    return MonthTable(
        spark,
        new_path(spark, "test-events"),
        schemas.CALENDAR_EVENTS,
        schemas.KEYS["calendar_events"],
        "event_date",
    )


def batch(table, rows, name="activities"):
    return table(name, rows).drop("inserted_at", "updated_at")


def by_id(store, key="activity_id"):
    return {r[key]: r for r in store.read().collect()}


def test_replace_drops_what_was_there(activities, table, run_row):
    activities.replace(batch(table, [run_row(activity_id="old")]), FIRST)
    activities.replace(
        batch(table, [run_row(activity_id="new", activity_date="2025-04-01 07:00:00")]), LATER
    )
    got = by_id(activities)
    assert set(got) == {"new"} and got["new"].inserted_at == LATER


def test_repeated_key_is_refused(activities, table, run_row):
    with pytest.raises(DuplicateKeys):
        activities.replace(batch(table, [run_row(), run_row(activity_name="again")]), FIRST)


def test_append_of_a_stored_key_is_refused(activities, table, run_row):
    activities.replace(batch(table, [run_row(activity_id="1")]), FIRST)
    activities.append(batch(table, [run_row(activity_id="2")]), LATER)
    with pytest.raises(DuplicateKeys):
        activities.append(batch(table, [run_row(activity_id="1")]), LATER)
    assert set(by_id(activities)) == {"1", "2"}


def test_insert_new_keeps_stored_rows(activities, table, run_row):
    activities.replace(batch(table, [run_row(activity_id="1", activity_name="kept")]), FIRST)
    activities.insert_new(
        batch(table, [run_row(activity_id="1", activity_name="lost"), run_row(activity_id="2")]),
        LATER,
    )
    got = by_id(activities)
    assert got["1"].activity_name == "kept" and got["1"].inserted_at == FIRST
    assert got["2"].inserted_at == LATER


def test_same_id_of_two_athletes_is_two_rows(activities, table, run_row):
    activities.replace(batch(table, [run_row(activity_id="1", athlete_id=1)]), FIRST)
    activities.insert_new(batch(table, [run_row(activity_id="1", athlete_id=2)]), LATER)
    assert activities.read().count() == 2


def test_backfill_fills_only_missing_weather(activities, table, run_row):
    stored = [
        run_row(activity_id="dry", weather_humidity_pct=40),
        run_row(activity_id="known", weather_temp_c=9.0),
        run_row(activity_id="other", activity_date="2025-01-02 07:00:00"),
    ]
    activities.replace(batch(table, stored), FIRST)
    incoming = [
        run_row(activity_id="dry", activity_name="x", weather_temp_c=21.0),
        run_row(activity_id="known", weather_temp_c=1.0),
        run_row(activity_id="other"),
    ]
    activities.backfill_weather(batch(table, incoming), LATER)
    got = by_id(activities)
    assert got["dry"].weather_temp_c == 21.0 and got["dry"].weather_humidity_pct == 40
    assert got["dry"].activity_name == "Morning Run"
    assert (got["dry"].inserted_at, got["dry"].updated_at) == (FIRST, LATER)
    assert got["known"].weather_temp_c == 9.0 and got["known"].updated_at == FIRST
    assert got["other"].weather_temp_c is None and got["other"].updated_at == FIRST


def test_a_batch_with_a_repeated_or_null_key_is_refused(activities, table, run_row):
    activities.replace(batch(table, [run_row(activity_id="dry")]), FIRST)
    twice = batch(table, [run_row(activity_id="dry", weather_temp_c=t) for t in (1.0, 2.0)])
    nameless = batch(table, [run_row(activity_id=None, weather_temp_c=1.0)])
    for load in (activities.insert_new, activities.backfill_weather):
        for wrong in (twice, nameless):
            with pytest.raises(DuplicateKeys):
                load(wrong, LATER)
    assert activities.read().count() == 1


def event(uuid, day, title="first"):
    return {"athlete_id": 1, "event_uuid": uuid, "event_date": day, "title": title}


def test_replace_by_key_follows_a_row_to_another_month(events, table):
    stored = [event("a", "2025-03-01"), event("b", "2025-04-01"), event("c", "2025-05-01")]
    events.replace(batch(table, stored, "calendar_events"), FIRST)
    moved = [event("a", "2025-05-20", "moved"), event("d", "2025-05-02")]
    events.replace_by_key(batch(table, moved, "calendar_events"), LATER)
    got = by_id(events, "event_uuid")
    assert set(got) == {"a", "b", "c", "d"} and events.read().count() == 4
    assert got["a"].title == "moved" and got["a"].event_date == dt.date(2025, 5, 20)
    assert got["c"].title == "first" and got["c"].updated_at == FIRST


def test_delete_can_empty_a_month(events, table):
    stored = [event("a", "2025-03-01"), event("b", "2025-04-01")]
    events.replace(batch(table, stored, "calendar_events"), FIRST)
    events.delete(table("calendar_events", [event("a", "2025-03-01")]))
    assert set(by_id(events, "event_uuid")) == {"b"}
    events.delete(table("calendar_events", [event("none", "2025-03-01")]))
    assert events.read().count() == 1


def test_row_without_date_is_kept(events, table):
    events.replace(batch(table, [event("a", None)], "calendar_events"), FIRST)
    assert by_id(events, "event_uuid")["a"].event_date is None
