"""Rounding, bands and safe arithmetic as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A sum of doubles depends on the order of its terms in the last bits, so a mean
# that is exactly half way would round up in one run and down in the next. Rounding
# an aggregate lifts it by this share of the last place first.
_TIE_LIFT = 1e-6


def rnd(x: Column, places: int) -> Column:
    """Round a value of one row, halves away from zero."""
    return _signed(x, places, 0.0)


def rnd_pos(x: Column, places: int) -> Column:
    """:func:`rnd` of a value that is never negative.

    Names ``x`` once: expressions that build on each other do not double in size at
    every step when a filter is pushed down through them.
    """
    return _positive(x, places, 0.0)


def rnd_agg(x: Column, places: int) -> Column:
    """Round an aggregate of doubles; ties do not depend on the order of the sum."""
    return _signed(x, places, _TIE_LIFT)


def rnd_agg_pos(x: Column, places: int) -> Column:
    """:func:`rnd_agg` of a value that is never negative."""
    return _positive(x, places, _TIE_LIFT)


def _positive(x: Column, places: int, lift: float) -> Column:
    scale = F.lit(float(10**places))
    return F.floor(x.cast("double") * scale + F.lit(0.5 + lift)) / scale


def _signed(x: Column, places: int, lift: float) -> Column:
    return F.signum(x.cast("double")) * _positive(F.abs(x), places, lift) + F.lit(0.0)


def band(x: Column, steps: list, test: str, missing=None) -> Column:
    """Label of the first step whose bound ``x`` meets; ``missing`` when x is null.

    ``test`` is one of ``<``, ``<=``, ``>=``. A step without bound takes the rest.
    """
    meets = {"<": Column.__lt__, "<=": Column.__le__, ">=": Column.__ge__}[test]
    *bounded, (rest, _) = steps
    branches = [(meets(x, F.lit(bound)), F.lit(label)) for label, bound in bounded]
    if missing is not None:
        branches.insert(0, (x.isNull(), F.lit(missing)))
    return first_match(branches, F.lit(rest))


def first_match(branches: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """CASE over (condition, value) pairs."""
    chain = reduce(lambda acc, b: acc.when(*b), branches[1:], F.when(*branches[0]))
    return chain if default is None else chain.otherwise(default)


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, null where den is zero or null."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def safe_divide(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, ``default`` where den is zero; null inputs stay null."""
    return F.when(den == 0, F.lit(default)).otherwise(ratio(num, den))


def pct_change(new: Column, base: Column) -> Column:
    """Change against a positive base in percent, else null."""
    return F.when(base > 0, (new - base) / base * 100.0)


def or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0))
