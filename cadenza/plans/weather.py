"""How weather moved an athlete's pace, and notes on the days ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions import text as T
from cadenza.functions import weather as W
from cadenza.functions.numeric import ratio, rnd, rnd_agg
from cadenza.functions.reuse import reusable
from cadenza.operators.windows import newest

c = F.col
ATHLETE = "athlete_id"
#: How many runs the impact of weather is judged on, unless a caller asks for others.
LATEST_RUNS = 200
MIN_RUNS = 5
MIN_GROUP = 3


def weather_runs(raw: DataFrame, latest: int | None = LATEST_RUNS) -> DataFrame:
    """Plausible runs with a temperature: the ``latest`` ones of each athlete, or all for None."""
    pace = ratio(c("duration_minutes"), c("distance_km"))
    valid = raw.filter(
        (c("distance_km") > 1.0)
        & (c("duration_minutes") > 5)
        & c("weather_temp_c").isNotNull()
        & F.lower("activity_type").contains("run")
    ).filter(pace.between(2.5, 20.0))
    runs = valid.select(
        ATHLETE,
        "activity_id",
        "activity_date",
        rnd(pace, 2).alias("pace"),
        c("weather_temp_c").alias("temp"),
        (c("weather_wind_speed_ms") * 3.6).alias("wind_kmh"),
        c("weather_precipitation_mm").alias("rain"),
    )
    newer = (c("activity_date").desc(), c("activity_id").desc())
    return runs if latest is None else newest(runs, latest, *newer, spread_by="activity_id")


def temp_buckets(runs: DataFrame) -> DataFrame:
    """Mean pace per temperature bucket with at least three runs."""
    return (
        runs.groupBy(ATHLETE, W.temp_bucket(c("temp")).alias("bucket"))
        .agg(F.count("*").alias("n_runs"), F.avg("pace").alias("avg_pace"))
        .filter(c("n_runs") >= MIN_GROUP)
        .withColumn("line", _bucket_line(c("bucket"), c("avg_pace"), c("n_runs")))
    )


def _bucket_line(label: Column, pace: Column, n: Column) -> Column:
    shown = T.pace_uncarried(rnd_agg(pace, 6))
    return T.fill(K.WEATHER_BUCKET, {"bucket": label, "pace": shown, "n": n.cast("string")})


def _contrast(bad: Column, good: Column) -> tuple[Column, Column, Column]:
    """Mean pace difference in s/km and both counts."""
    slow, fast = F.avg(F.when(bad, c("pace"))), F.avg(F.when(good, c("pace")))
    return (slow - fast) * 60, F.count(F.when(bad, c("pace"))), F.count(F.when(good, c("pace")))


def _impact(runs: DataFrame, bad: Column, good: Column) -> DataFrame:
    diff, n_bad, n_good = _contrast(bad, good)
    return (
        runs.groupBy(ATHLETE)
        .agg(diff.alias("diff_s_per_km"), n_bad.alias("n_bad"), n_good.alias("n_good"))
        .filter((c("n_bad") >= MIN_GROUP) & (c("n_good") >= MIN_GROUP))
        .withColumn("direction", _direction(c("diff_s_per_km")))
    )


def _direction(diff: Column) -> Column:
    return F.when(rnd_agg(diff, 6) > 0, F.lit("slower")).otherwise(F.lit("faster"))


def _wind() -> tuple[Column, Column]:
    """Windy and calm."""
    return c("wind_kmh") >= 25, c("wind_kmh") < 15


def _rain() -> tuple[Column, Column]:
    """Wet and dry."""
    return c("rain") >= 2.0, c("rain") < 0.5


def wind_impact(runs: DataFrame) -> DataFrame:
    return _impact(runs, *_wind())


def rain_impact(runs: DataFrame) -> DataFrame:
    return _impact(runs, *_rain())


@reusable
def _summary_sums() -> list[Column]:
    buckets = {}
    for i, (label, _, _) in enumerate(K.TEMP_BUCKETS):
        inside = W.temp_bucket(c("temp")) == label
        buckets[f"_n{i}"] = F.count(F.when(inside, 1))
        buckets[f"_p{i}"] = F.avg(F.when(inside, c("pace")))
    wind, n_windy, n_calm = _contrast(*_wind())
    rain, n_wet, n_dry = _contrast(*_rain())
    return [
        F.count("*").alias("n_runs"),
        *[e.alias(n) for n, e in buckets.items()],
        F.when((n_windy >= MIN_GROUP) & (n_calm >= MIN_GROUP), wind).alias("_wind"),
        F.when((n_wet >= MIN_GROUP) & (n_dry >= MIN_GROUP), rain).alias("_rain"),
    ]


@reusable
def _summary_text() -> Column:
    bucket_lines = [
        F.when(c(f"_n{i}") >= MIN_GROUP, _bucket_line(F.lit(label), c(f"_p{i}"), c(f"_n{i}")))
        for i, (label, _, _) in enumerate(K.TEMP_BUCKETS)
    ]

    def impact_line(template: str, diff: Column) -> Column:
        size = T.fixed(F.abs(rnd_agg(diff, 0)), 0)
        return T.fill(template, {"size": size, "direction": _direction(diff)})

    text = F.concat_ws(
        "\n",
        T.fill(K.WEATHER_HEAD, {"n": c("n_runs").cast("string")}),
        F.when(F.coalesce(*bucket_lines).isNotNull(), F.lit(K.WEATHER_TEMP_HEAD)),
        *bucket_lines,
        impact_line(K.WEATHER_WIND, c("_wind")),
        impact_line(K.WEATHER_RAIN, c("_rain")),
    )
    return F.when(c("n_runs") >= MIN_RUNS, text).alias("summary")


def weather_summary(runs: DataFrame) -> DataFrame:
    """The whole text per athlete, null below five runs. One aggregate per athlete."""
    return runs.groupBy(ATHLETE).agg(*_summary_sums()).select(ATHLETE, "n_runs", _summary_text())


def forecast_lines(forecast: DataFrame) -> DataFrame:
    """Each forecast day with its warnings and its line of text."""
    flags = W.forecast_flags(
        c("precipitation_mm"), c("wind_kmh"), c("temp_min_c"), c("temp_max_c")
    )
    listed = F.when(c("flags") != "", F.concat(F.lit(" ["), c("flags"), F.lit("]")))
    words = {
        "day": c("day_name"),
        "date": c("date").cast("string"),
        "low": c("temp_min_c").cast("string"),
        "high": c("temp_max_c").cast("string"),
        "condition": c("condition"),
        "flags": F.coalesce(listed, F.lit("")),
    }
    line = T.fill(K.FORECAST_DAY, words).alias("line")
    return forecast.withColumn("flags", flags).select(ATHLETE, "city", "date", "flags", line)


def weather_block(forecast: DataFrame, summary: DataFrame) -> DataFrame:
    """Forecast and history as one text per athlete and city; a city has at most the
    forecast's days, so its lines are few."""
    days = forecast_lines(forecast).groupBy(ATHLETE, "city").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("date", "line"))), lambda d: d["line"]
            ),
            "\n",
        ).alias("_days")
    )
    joined = days.join(summary.select(ATHLETE, "summary"), ATHLETE, "left")
    history = F.coalesce(F.concat(F.lit("\n\n"), c("summary")), F.lit(""))
    head = T.fill(K.FORECAST_HEAD, {"city": c("city")})
    text = F.concat(head, F.lit("\n"), c("_days"), history)
    return joined.select(ATHLETE, "city", text.alias("weather_text"))
