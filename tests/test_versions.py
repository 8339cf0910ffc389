"""Loads are seen whole or not at all, once, and read only their part of the table."""

import datetime as dt
import json
import shutil

import pytest

from cadenza import schemas
from cadenza.operators.keyed import MonthTable
from cadenza.operators.versions import ConflictingLoad, Version, VersionLog
from cadenza.session import new_path
from cadenza.streaming import ingest

FIRST, LATER = dt.datetime(2025, 3, 1, 6), dt.datetime(2025, 3, 8, 6)
MONTHS = [f"2025-{m:02d}" for m in range(1, 7)]


class Killed(RuntimeError):
    pass


@pytest.fixture
def store(spark):
    """A table of activities in six months, one athlete a month."""
    return ingest.raw_table(spark, new_path(spark, "versions"), "activities")


def runs(table, run_row, months, **change):
    rows = [
        run_row(activity_id=f"{m}-{k}", athlete_id=k, activity_date=f"{m}-0{k} 07:00:00", **change)
        for m in months
        for k in (1, 2)
    ]
    return table("activities", rows).drop("inserted_at", "updated_at")


def rows_of(store):
    return sorted(store.read().collect(), key=str)


def loads(table, run_row):
    more = runs(table, run_row, [*MONTHS[3:], "2025-07"], weather_temp_c=11.0)
    return {
        "replace": lambda s: s.replace(more, LATER),
        "append": lambda s: s.append(runs(table, run_row, ["2025-08"]), LATER),
        "insert_new": lambda s: s.insert_new(more, LATER),
        "backfill_weather": lambda s: s.backfill_weather(more, LATER),
        "replace_by_key": lambda s: s.replace_by_key(more, LATER),
        "delete": lambda s: s.delete(more.filter("athlete_id = 1")),
    }


@pytest.mark.parametrize("name", ["replace", "append", "insert_new", "backfill_weather", "replace_by_key", "delete"])
@pytest.mark.parametrize("moment", ["before the switch", "half the months"])
def test_a_killed_load_leaves_the_table_and_can_be_repeated(store, table, run_row, monkeypatch, name, moment):
    load = loads(table, run_row)[name]
    store.replace(runs(table, run_row, MONTHS), FIRST)
    before, number = rows_of(store), store.version().number

    with monkeypatch.context() as m:
        if moment == "before the switch":

            def cut(version):
                raise Killed

            m.setattr(store.log, "commit", cut)
        else:
            listed = store._written_parts

            def half(path):  # the files of the first months are there, those of the others are not yet
                months = listed(path)
                assert months
                for month in months[len(months) // 2 :]:
                    shutil.rmtree(f"{path}/part_month={month}")
                raise Killed

            m.setattr(store, "_written_parts", half)
        with pytest.raises(Killed):
            load(store)
    assert rows_of(store) == before and store.version().number == number

    other = MonthTable(store.spark, new_path(store.spark, "whole"), store.schema, store.keys, store.date, stays=True)
    other.replace(runs(table, run_row, MONTHS), FIRST)
    load(other)
    load(store)
    assert rows_of(store) == rows_of(other) and rows_of(store) != before


def test_a_reader_keeps_its_version(store, table, run_row):
    store.replace(runs(table, run_row, MONTHS), FIRST)
    first, number = store.read(), store.version().number
    store.delete(runs(table, run_row, MONTHS[:4]))
    store.insert_new(runs(table, run_row, ["2025-09"]), LATER)
    assert first.count() == 12 and store.read().count() == 6
    assert store.read(version=number).count() == 12


def test_versions_beyond_those_kept_are_dropped_with_their_files(store, table, run_row):
    store.keep = 2
    for k in range(4):
        store.replace(runs(table, run_row, MONTHS[k : k + 1]), FIRST)
    assert store.log.numbers() == [3, 4]
    held = {f.removeprefix("load=") for f in store.log.folders(store.log.data)}
    assert held == store.log.at(3).loads() | store.log.at(4).loads()
    assert store.read(version=3).count() == 2


def test_of_two_loads_at_once_one_is_refused(spark, store, table, run_row):
    store.replace(runs(table, run_row, MONTHS[:1]), FIRST)
    twin = ingest.raw_table(spark, store.path, "activities")
    with pytest.raises(ConflictingLoad), store.load():
        store.insert_new(runs(table, run_row, MONTHS[1:2]), LATER)
        twin.insert_new(runs(table, run_row, MONTHS[2:3]), LATER)
    assert {r.activity_id[:7] for r in rows_of(store)} == {MONTHS[0], MONTHS[2]}
    store.insert_new(runs(table, run_row, MONTHS[1:2]), LATER)
    assert store.read().count() == 6


def test_a_version_is_one_file(spark):
    log = VersionLog(spark, new_path(spark, "log"))
    assert log.current() == Version()
    made = Version(1, {"2025-01": ["a", "b"], "none": ["c"]}, {"s": [4, 1]})
    log.commit(made)
    assert log.current() == made and made.loads() == {"a", "b", "c"}
    assert [n for n in log.folders(f"{log.data}/../versions") if not n.startswith(".")] == ["0000000001.json"]


def test_compact_joins_the_loads_of_a_month(store, table, run_row):
    for k in range(4):
        store.append(runs(table, run_row, [MONTHS[0]]).selectExpr("athlete_id", f"concat(activity_id, '-{k}') AS activity_id", "* EXCEPT (athlete_id, activity_id)"), FIRST)
    store.append(runs(table, run_row, [MONTHS[1]]), FIRST)
    before = rows_of(store)
    store.compact(loads=2)
    assert {m: len(held) for m, held in store.version().parts.items()} == {MONTHS[0]: 1, MONTHS[1]: 1}
    assert rows_of(store) == before
    assert store.version().parts[MONTHS[1]] == store.log.at(store.version().number - 1).parts[MONTHS[1]]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_batch_of_one_month_lists_no_other_month(store, table, run_row):
    store.replace(runs(table, run_row, MONTHS), FIRST)
    batch = store.stage(runs(table, run_row, MONTHS[2:3]))
    beside = store.beside(batch)
    assert beside.inputFiles() and all(f"part_month={MONTHS[2]}" in f for f in beside.inputFiles())
    known = store.known_keys(batch)
    text = plan(known)
    table_side = text[: text.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in text and "part_month" in table_side and "Exchange hash" not in table_side
    assert {tuple(r)[:2] for r in known.collect()} == {(1, f"{MONTHS[2]}-1"), (2, f"{MONTHS[2]}-2")}


def test_only_key_columns_and_buckets_are_read(store, table, run_row, spark):
    store.replace(runs(table, run_row, MONTHS), FIRST)
    one = store.stage(runs(table, run_row, MONTHS[2:3]).limit(1))
    bucket = store._placed(one).first()[store.BUCKET]
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        text = plan(store.known_keys(one))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in text.split("\n") if "FileScan" in line and "part_bucket" in line)
    assert "part_bucket#" in scan and f"= {bucket})" in scan
    read = scan[scan.index("ReadSchema") :]
    assert "activity_id" in read and "distance_km" not in read
    assert "EqualTo(activity_id," in scan


def test_files_have_bloom_filters_of_the_keys(store, table, run_row, spark):
    store.replace(runs(table, run_row, MONTHS[:1]), FIRST)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(store._read().inputFiles()[0])
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        found = {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() >= 0}
    finally:
        reader.close()
    assert found == {"activity_id"}


def test_a_key_that_moves_is_found_in_any_month(spark, table):
    events = ingest.raw_table(spark, new_path(spark, "events"), "calendar_events")
    made = [{"athlete_id": 1, "event_uuid": u, "event_date": f"{m}-01", "title": "x"} for u, m in zip("abc", MONTHS, strict=False)]
    events.replace(table("calendar_events", made).drop("inserted_at", "updated_at"), FIRST)
    moved = [{"athlete_id": 1, "event_uuid": "a", "event_date": "2025-12-01", "title": "y"}]
    events.replace_by_key(table("calendar_events", moved).drop("inserted_at", "updated_at"), LATER)
    assert sorted((r.event_uuid, r.title) for r in rows_of(events)) == [("a", "y"), ("b", "x"), ("c", "x")]
    assert MONTHS[0] not in events.version().parts


def activity(ident, **change):
    record = {"athlete_id": 1, "activityId": ident, "startTimeLocal": "2025-03-05 12:00:00", "distance": 5000.0, "duration": 1500.0, "fetch": 1}
    return json.dumps({**record, **change})


def test_a_batch_handed_over_again_is_loaded_once(spark, tmp_path):
    path = new_path(spark, "t")
    store, aside = ingest.raw_table(spark, path, "activities"), f"{path}-quarantine"
    lines = [activity(1), activity(2), "no json", activity(None)]
    (tmp_path / "a.json").write_text("\n".join(lines))
    schema = f"{ingest.ACTIVITY_RECORD}, {ingest.BROKEN} STRING"
    batch = spark.read.schema(schema).option("columnNameOfCorruptRecord", ingest.BROKEN).json(str(tmp_path))

    def state():
        return rows_of(store), sorted(r.record for r in spark.read.parquet(aside).collect()), store.version()

    take = [store, "activities", batch, "stream-1", 0, FIRST, aside]
    assert ingest.take_batch(*take) == 2
    once = state()
    assert ingest.take_batch(*take) == 2 and state() == once
    assert len(once[0]) == 2 and len(once[1]) == 2


@pytest.mark.parametrize("moment", ["before the switch", "after the switch"])
def test_a_stream_killed_in_a_batch_goes_on_exactly_once(spark, tmp_path, monkeypatch, moment):
    path, progress = new_path(spark, "t"), new_path(spark, "p")
    (tmp_path / "a.json").write_text("\n".join([activity(1), "no json"]))

    def run():
        return ingest.ingest_incremental(spark, "activities", str(tmp_path), path, progress, FIRST)

    real = VersionLog.commit

    def cut(log, version):
        if moment == "after the switch":
            real(log, version)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(VersionLog, "commit", cut)
        with pytest.raises(Exception, match="Killed"):
            run()
    assert run() == 1
    (tmp_path / "b.json").write_text("\n".join([activity(1), activity(2), "[1"]))
    assert run() == 1 and run() == 0
    store = ingest.raw_table(spark, path, "activities")
    assert sorted(r.activity_id for r in store.read().collect()) == ["1", "2"]
    assert spark.read.parquet(f"{path}-quarantine").count() == 2
    assert store.version().number == 2


def test_log_table_without_dates_in_batches(spark, table):
    keys = schemas.KEYS["analysis_log"]
    log = MonthTable(spark, new_path(spark, "log"), schemas.ANALYSIS_LOG, keys, "generated_at")
    assert log.read().count() == 0 and log.read().columns == schemas.ANALYSIS_LOG.names
