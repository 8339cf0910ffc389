"""Expressions over one activity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza import constants as K
from cadenza.functions.numeric import band, first_match, rnd_pos


def distance_category(km: Column) -> Column:
    """Race distance of a length in km, null between the bands."""
    closed = [(km.between(lo, hi), F.lit(label)) for label, lo, hi in K.DISTANCE_BANDS]
    return first_match([*closed, (km > K.ULTRA_ABOVE_KM, F.lit(K.ULTRA_LABEL))])


def sane_pace(raw_pace: Column, km: Column, minutes: Column) -> Column:
    """Raw pace when plausible, else minutes per km; null without pace or distance."""
    return first_match(
        [
            (raw_pace.isNull() | km.isNull() | (km == 0), F.lit(None).cast("double")),
            (raw_pace.between(K.PACE_MIN, K.PACE_MAX), raw_pace),
        ],
        rnd_pos(minutes / F.nullif(km, F.lit(0.0)), 3),
    )


def repaired_pace(raw_pace: Column, km: Column, minutes: Column) -> Column:
    """Like :func:`sane_pace`, but a missing raw pace is recomputed too."""
    return first_match(
        [
            (raw_pace.between(K.PACE_MIN, K.PACE_MAX), raw_pace),
            (km > 0, rnd_pos(minutes / F.nullif(km, F.lit(0.0)), 3)),
        ]
    )


def is_race(event_type: Column, name: Column) -> Column:
    """Tagged as a race, or a race word in the name."""
    lowered = F.lower(F.coalesce(name, F.lit("")))
    hit = F.lower(F.coalesce(event_type, F.lit(""))) == "race"
    for word in K.RACE_WORDS:
        hit = hit | lowered.contains(word)
    return hit


def pace_zone(pace: Column) -> Column:
    return band(pace, K.PACE_ZONES, "<", missing="no_data")


def hr_zone(hr: Column) -> Column:
    return band(hr, K.HR_ZONES, "<", missing="no_hr_data")


def terrain(gain: Column) -> Column:
    return band(gain, K.TERRAINS, "<", missing="unknown")


def effort_level(hr: Column, pace: Column) -> Column:
    """Effort of heart rate and pace. A missing pace fails every pace test, so only a
    heart rate of 150 or more still reads as hard."""
    return first_match(
        [
            (hr.isNull(), F.lit("unknown")),
            ((hr < 130) & (pace > 6.5), F.lit("easy")),
            ((hr < 150) & pace.between(5.5, 6.5), F.lit("moderate")),
            ((hr >= 150) | (pace < 5.5), F.lit("hard")),
        ],
        F.lit("moderate"),
    )


def training_load(minutes: Column, hr: Column) -> Column:
    return rnd_pos(minutes * band(hr, K.LOAD_FACTORS, "<", missing=K.LOAD_FACTOR_NO_HR), 2)


def time_of_day(hour: Column) -> Column:
    return first_match(
        [
            (hour.between(5, 11), F.lit("morning")),
            (hour.between(12, 17), F.lit("afternoon")),
            (hour.between(18, 21), F.lit("evening")),
        ],
        F.lit("night"),
    )


def zero_or_missing(x: Column) -> Column:
    return F.coalesce(x == 0, F.lit(True))


def type_label(activity_type: Column) -> Column:
    """Display label of an activity type."""
    labels = F.create_map(*[F.lit(v) for kv in K.ACTIVITY_LABELS.items() for v in kv])
    known = F.try_element_at(labels, F.lower(activity_type))
    return F.coalesce(known, F.concat(F.lit(K.ACTIVITY_LABEL_OTHER), activity_type))


def hr_ratio_zone(avg_hr: Column, max_hr: Column) -> Column:
    """Zone by share of maximum heart rate; outside 50-100 % is Unknown."""
    share = avg_hr.cast("double") / F.nullif(max_hr.cast("double"), F.lit(0.0))
    return first_match(
        [((share >= lo) & (share < hi), F.lit(name)) for name, lo, hi in K.HR_RATIO_ZONES],
        F.lit("Unknown"),
    )
