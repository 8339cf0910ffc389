import pytest
from pyspark.sql import functions as F

from cadenza.functions import activity as A
from cadenza.functions import text as T
from cadenza.functions import weather as W
from cadenza.functions.numeric import rnd, rnd_agg, rnd_pos


@pytest.fixture(scope="module")
def value(spark):
    one = spark.range(1)

    def evaluate(column):
        return one.select(column.alias("v")).first().v

    return evaluate


def num(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize(
    "column, expected",
    [
        (lambda: T.pace(num(5.25)), "5:15 /km"),
        (lambda: T.pace(num(4.999)), "5:00 /km"),
        (lambda: T.pace(num(None)), "—"),
        (lambda: T.pace(num(0)), "—"),
        (lambda: T.pace_short(num(4.5)), "4:30"),
        (lambda: T.pace_truncated(num(5.5)), "5:30 /km"),
        (lambda: T.pace_uncarried(num(4.999)), "4:60"),
        (lambda: T.duration(num(65.5)), "1h05:30"),
        (lambda: T.duration(num(45)), "45:00"),
        (lambda: T.duration(num(0.5)), "0:30"),
        (lambda: T.duration_short(num(65.4)), "1h 05min"),
        (lambda: T.duration_short(num(45)), "45min"),
        (lambda: T.distance(num(42.195)), "42.2 km"),
        (lambda: T.distance(num(-1)), "—"),
        (lambda: T.distance_short(num(100)), "100 km"),
        (lambda: T.distance_short(num(5.5)), "5.5 km"),
        (lambda: T.heart_rate(num(142.7)), "143 bpm"),
        (lambda: T.load(num(127.4)), "127"),
        (lambda: T.score(num(72.4)), "72 / 100"),
        (lambda: T.date(F.lit("2025-03-15").cast("date")), "15 Mar 2025"),
        (lambda: T.week(F.lit("2025-03-10").cast("date")), "Mar 10"),
        (lambda: T.delta_distance(num(45.2), num(38.0)), "+7.2 km"),
        (lambda: T.delta_distance(num(30), num(45)), "-15.0 km"),
        (lambda: T.delta_distance(num(45), num(None)), None),
        (lambda: T.delta_pace(num(5.25), num(5.5)), "-0:15"),
        (lambda: T.delta_pace(num(5.5), num(5.25)), "+0:15"),
        (lambda: T.signed_gap(num(75)), "+1:15"),
        (lambda: T.signed_gap(num(-75)), "1:15"),
        (lambda: T.signed_gap(num(None)), "—"),
        (lambda: T.fixed(num(None), 1), None),
        (lambda: T.whole(num(2.5)), "2"),
        (lambda: T.distance(num(14.95)), "14.9 km"),
        (lambda: T.distance(num(6.25)), "6.2 km"),
        (lambda: T.distance(num(14.85)), "14.8 km"),
        (lambda: T.distance(num(0.35)), "0.3 km"),
        (lambda: T.fixed(num(2.675), 2), "2.67"),
        (lambda: T.fixed(num(-0.04), 1), "-0.0"),
        (lambda: T.fixed(num(2.5), 0), "2"),
    ],
)
def test_texts(value, column, expected):
    assert value(column()) == expected


@pytest.mark.parametrize(
    "x, places, expected",
    [(1.005, 2, 1.0), (0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13)],
)
def test_rounding(value, x, places, expected):
    assert value(rnd(num(x), places)) == expected
    if x >= 0:
        assert value(rnd_pos(num(x), places)) == expected


def test_rounding_of_sums_ignores_the_last_bits(value):
    assert value(rnd_agg(num(0.285), 2)) == 0.29
    assert value(rnd_agg(num(-0.004), 2)) == 0.0
    assert value(rnd_agg(num(None), 2)) is None


def test_lookups(value):
    assert value(A.type_label(F.lit("Trail_Running"))) == "🏔️ Trail Running"
    assert value(A.type_label(F.lit("rowing"))) == "⚡ rowing"
    assert value(W.code_label(F.lit(95))) == "Thunderstorm"
    assert value(W.code_label(F.lit(7))) == "Code 7"
    assert value(W.condition_label(F.lit("PARTLY_CLOUDY"))) == "☁️ Cloudy"
    assert value(W.condition_label(F.lit("HAZE"))) == "Haze"
    assert value(W.condition_label(F.lit(None).cast("string"))) == "—"
    assert value(A.hr_ratio_zone(F.lit(140), F.lit(185))) == "Zone 3 - Tempo"
    assert value(A.hr_ratio_zone(F.lit(185), F.lit(185))) == "Unknown"


def test_fixed_prints_the_exact_value(spark):
    """All steps of 0.01 up to 500, and a spread of other values, against Python's printing."""
    values = [i / 100 for i in range(50_000)] + [i / 8 for i in range(999)] + [-i * 0.05 for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (0, 1, 2):
        got = df.select("v", T.fixed(F.col("v"), places).alias("t")).collect()
        assert [r.t for r in got] == [f"{r.v:.{places}f}" for r in got]
