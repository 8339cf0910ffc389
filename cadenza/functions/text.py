"""Display text of metrics. ``MISSING`` stands for values that cannot be shown."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "—"


def fill(template: str, values: dict[str, Column]) -> Column:
    """Text with each ``{name}`` replaced; null when a value it names is null."""
    parts = re.split(r"\{(\w+)\}", template)
    cells = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if p or not i]
    return F.concat(*cells)


def _shift(value: Column) -> Column:
    """Ten times a (sum, rest) pair: the nearest double and, exactly, what it leaves out.

    Ten times is eight times plus twice, which both are exact; the rest is the sum's rounding error.
    """

    def parts(v: Column) -> Column:
        a, b = v["s"] * 8, v["s"] * 2
        total = a + b
        other = total - a
        rest = (a - (total - other)) + (b - other)
        return F.struct(total.alias("s"), (rest + v["e"] * 10).alias("e"))

    return F.transform(F.array(value), parts)[0]


def _half_even(value: Column) -> Column:
    """The pair's nearest whole number; a half goes where the rest points, else to the even side."""

    def whole_of(v: Column) -> Column:
        low = F.floor(v["s"])
        tied = (v["s"] - low == 0.5) & (v["e"] != 0)
        near = F.when(v["e"] > 0, low + 1).otherwise(low).cast("double")
        found = F.when(tied, near).otherwise(F.bround(v["s"], 0))
        return F.when(v["s"] < 0, -F.abs(found)).otherwise(found)

    return F.transform(F.array(value), whole_of)[0]


def fixed(x: Column, places: int) -> Column:
    """Number with a fixed count of decimals; null stays null.

    The exact binary value is rounded, halves to even, as printing does: 14.95 is a little less
    than its name and gives 14.9.
    """
    value = F.struct(x.cast("double").alias("s"), F.lit(0.0).alias("e"))
    for _ in range(places):
        value = _shift(value)
    return F.when(x.isNotNull(), F.format_string(f"%.{places}f", _half_even(value) / float(10**places)))


def whole(x: Column) -> Column:
    """Whole number as text, halves to even."""
    return F.bround(x.cast("double"), 0).cast("bigint").cast("string")


def two_digits(x: Column) -> Column:
    return F.lpad(x.cast("bigint").cast("string"), 2, "0")


def _shown(ok: Column, text: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), text).otherwise(F.lit(MISSING))


def _clock(seconds: Column) -> Column:
    """m:ss of whole seconds."""
    return F.concat(
        F.floor(seconds / 60).cast("bigint").cast("string"), F.lit(":"), two_digits(seconds % 60)
    )


def _pace_seconds(pace: Column) -> Column:
    """Whole seconds per km, the part minute rounded on its own."""
    minutes = F.floor(pace)
    return minutes * 60 + F.bround((pace - minutes) * 60, 0).cast("bigint")


def pace_short(pace: Column) -> Column:
    """m:ss, 60 seconds carried into the minute."""
    return _shown(pace > 0, _clock(_pace_seconds(pace)))


def pace(p: Column) -> Column:
    """m:ss /km, 60 seconds carried into the minute."""
    return _shown(p > 0, F.concat(_clock(_pace_seconds(p)), F.lit(" /km")))


def pace_uncarried(p: Column) -> Column:
    """m:ss where rounding may print :60, as the coaching texts do."""
    minutes = F.floor(p)
    seconds = F.bround((p - minutes) * 60, 0)
    return F.concat(minutes.cast("string"), F.lit(":"), two_digits(seconds))


def pace_truncated(p: Column) -> Column:
    """m:ss /km with part seconds dropped."""
    minutes = F.floor(p)
    return F.concat(
        minutes.cast("string"), F.lit(":"), two_digits(F.floor((p - minutes) * 60)), F.lit(" /km")
    )


def duration(minutes: Column) -> Column:
    """1h05:30 from an hour on, else 45:00."""
    total = F.bround(minutes * 60, 0).cast("bigint")
    h = F.floor(total / 3600)
    rest = total % 3600
    long_form = F.concat(
        h.cast("string"),
        F.lit("h"),
        two_digits(F.floor(rest / 60)),
        F.lit(":"),
        two_digits(rest % 60),
    )
    return _shown(minutes >= 0, F.when(h > 0, long_form).otherwise(_clock(rest)))


def duration_short(minutes: Column) -> Column:
    """1h 05min from an hour on, else 45min."""
    total = F.bround(minutes.cast("double"), 0).cast("bigint")
    h = F.floor(total / 60)
    long_form = F.concat(h.cast("string"), F.lit("h "), two_digits(total % 60), F.lit("min"))
    short_form = F.concat((total % 60).cast("string"), F.lit("min"))
    return _shown(minutes >= 0, F.when(h > 0, long_form).otherwise(short_form))


def distance(km: Column, places: int = 1) -> Column:
    return _shown(km >= 0, F.concat(fixed(km, places), F.lit(" km")))


def distance_short(km: Column) -> Column:
    """No decimals from 100 km on."""
    text = F.when(km >= 100, whole(km)).otherwise(fixed(km, 1))
    return _shown(km >= 0, F.concat(text, F.lit(" km")))


def heart_rate(bpm: Column) -> Column:
    return _shown(bpm > 0, F.concat(whole(bpm), F.lit(" bpm")))


def load(x: Column) -> Column:
    return _shown(x >= 0, whole(x))


def score(x: Column, best: int = 100) -> Column:
    return _shown(x.isNotNull(), F.concat(whole(x), F.lit(f" / {best}")))


def date(d: Column, fmt: str = "dd MMM yyyy") -> Column:
    return _shown(d.isNotNull(), F.date_format(d, fmt))


def week(d: Column) -> Column:
    return F.date_format(d, "MMM dd")


def delta_distance(new: Column, old: Column) -> Column:
    """+7.2 km; null when either is missing."""
    delta = new - old
    sign = F.when(delta >= 0, F.lit("+")).otherwise(F.lit("-"))
    return F.concat(sign, fixed(F.abs(delta), 1), F.lit(" km"))


def delta_pace(new: Column, old: Column) -> Column:
    """+0:15; null when either is missing."""
    delta = new - old
    sign = F.when(delta >= 0, F.lit("+")).otherwise(F.lit("-"))
    return F.concat(sign, _clock(F.bround(F.abs(delta) * 60, 0).cast("bigint")))


def signed_gap(seconds: Column) -> Column:
    """m:ss of a gap to a goal; only a positive gap shows its sign."""
    size = F.floor(F.abs(seconds))
    sign = F.when(seconds > 0, F.lit("+")).otherwise(F.lit(""))
    return _shown(seconds.isNotNull(), F.concat(sign, _clock(size)))
