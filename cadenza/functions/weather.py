"""Expressions over weather readings."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions.numeric import first_match, rnd


def celsius(fahrenheit: Column) -> Column:
    return rnd((fahrenheit.cast("double") - 32) / 1.8, 1)


def metres_per_second(kmh: Column) -> Column:
    return rnd(kmh.cast("double") / 3.6, 2)


def condition_code(*texts: Column) -> Column:
    """First non-empty text as an upper-case code with underscores."""
    first = F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])
    trimmed = F.regexp_replace(first, r"^\s+|\s+$", "")
    return F.replace(F.upper(trimmed), F.lit(" "), F.lit("_"))


def condition_label(condition: Column) -> Column:
    """Weather group of a condition text, first group with a matching word."""
    lowered = F.lower(condition)
    groups = [
        (reduce(or_, [lowered.contains(w) for w in words]), F.lit(label))
        for label, words in K.WEATHER_GROUPS
    ]
    capitalised = F.concat(
        F.upper(F.substring(condition, 1, 1)), F.lower(F.substr(condition, F.lit(2)))
    )
    missing = F.coalesce(condition == "", F.lit(True))
    return first_match([(missing, F.lit("—")), *groups], capitalised)


def code_label(code: Column) -> Column:
    """Label of a forecast weather code."""
    labels = F.create_map(*[F.lit(v) for kv in K.WEATHER_CODES.items() for v in kv])
    known = F.try_element_at(labels, code)
    return F.coalesce(known, F.concat(F.lit("Code "), code.cast("string")))


def temp_bucket(temp: Column) -> Column:
    branches = []
    for label, lo, hi in K.TEMP_BUCKETS:
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (temp >= lo)
        if hi is not None:
            inside = inside & (temp < hi)
        branches.append((inside, F.lit(label)))
    return first_match(branches)


def forecast_flags(rain: Column, wind: Column, t_min: Column, t_max: Column) -> Column:
    """Comma-separated warnings of one forecast day, empty when there are none."""

    def reading(word: str, value: Column, unit: str) -> Column:
        return F.concat(F.lit(word), value.cast("string"), F.lit(unit))

    return F.concat_ws(
        ", ",
        first_match(
            [
                (rain >= 5, reading("rain ", rain, "mm")),
                (rain >= 1, reading("light rain ", rain, "mm")),
            ]
        ),
        first_match(
            [
                (wind >= 30, reading("strong wind ", wind, "km/h")),
                (wind >= 20, reading("wind ", wind, "km/h")),
            ]
        ),
        first_match([(t_max >= 28, F.lit(K.FORECAST_HEAT)), (t_min <= 0, F.lit(K.FORECAST_FROST))]),
    )
