"""Column expressions. Every one stays inside generated code: no Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed


def bucketize(
    value: Column,
    cuts: Sequence,
    labels: Sequence[str],
    *,
    closed: str = "left",
    exact_head: bool = False,
) -> Column:
    """Label the range a value falls in; the last label takes the rest.

    ``closed="left"`` makes the ranges ``[a, b)``, ``closed="right"`` makes
    them ``(a, b]``. With ``exact_head`` the first label is for values equal to
    the first cut only. NULL compares with nothing and so lands in the last
    label; filter it before where that is not wanted.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("one label more than cuts is needed")
    if closed not in ("left", "right"):
        raise ValueError("closed is 'left' or 'right'")
    out = None
    for position, (cut, label) in enumerate(zip(cuts, labels)):
        if position == 0 and exact_head:
            inside = value == F.lit(cut)
        else:
            inside = value < F.lit(cut) if closed == "left" else value <= F.lit(cut)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out.otherwise(labels[-1])


def label_map(value: Column, labels: Mapping, otherwise: Column | None = None) -> Column:
    """Replace known values by their labels, others by ``otherwise``."""
    out = None
    for known, label in labels.items():
        hit = value == F.lit(known)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(value if otherwise is None else otherwise)


def plain_words(value: Column) -> Column:
    """Underscores to spaces: the fallback label of an unknown code."""
    return F.replace(value, F.lit("_"), F.lit(" "))


def tidy_city(value: Column) -> Column:
    return F.lower(F.trim(value))


def tidy_state(value: Column) -> Column:
    return F.upper(F.trim(value))


def region_of_state(state: Column) -> Column:
    out = None
    for region, states in fixed.REGION_STATES.items():
        inside = state.isin(states)
        out = F.when(inside, region) if out is None else out.when(inside, region)
    return out.otherwise("Unknown")


def yyyymmdd(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_key(moment: Column, first: date, last: date) -> Column:
    """Key of the calendar day, or -1 when NULL or outside the calendar.

    The calendar has no gaps, so the key is a function of the day and no join
    with the date dimension is needed, whatever the number of date roles.
    """
    day = moment.cast("date")
    return F.when(day.between(F.lit(first), F.lit(last)), yyyymmdd(day)).otherwise(
        F.lit(fixed.UNKNOWN_KEY)
    )


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``; the time of day is ignored."""
    return F.datediff(end.cast("date"), start.cast("date"))


def hour_boundaries(start: Column, end: Column) -> Column:
    """How many full-hour marks lie between the two moments.

    Not the elapsed hours: 00:59 to 01:01 crosses one mark. Built from the day
    and the hour of day, so it does not depend on the session time zone.
    """
    days = F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    return days * 24 + F.hour(end) - F.hour(start)


def late_flag(delivered: Column, promised: Column) -> Column:
    """1 late, 0 in time, NULL while either moment is missing (exact moments)."""
    return F.when(
        delivered.isNotNull() & promised.isNotNull(), (delivered > promised).cast("int")
    )


def great_circle_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Distance on a sphere by the law of cosines; NULL without both latitudes."""
    north_a, north_b = F.radians(lat_a), F.radians(lat_b)
    turn = F.radians(lng_b) - F.radians(lng_a)
    cosine = F.cos(north_a) * F.cos(north_b) * F.cos(turn) + F.sin(north_a) * F.sin(north_b)
    # Rounding can leave [-1, 1], where acos has no value. least/greatest skip
    # NULLs, hence the guard on the latitudes outside.
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine))
    return F.when(
        lat_a.isNotNull() & lat_b.isNotNull(), F.lit(fixed.EARTH_RADIUS_KM) * F.acos(clamped)
    )


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, NULL where the bottom is 0."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean(value: Column) -> Column:
    """Average as exact sum over count: decimals do not depend on row order."""
    return ratio(F.sum(value), F.count(value))


def percent(flag: Column) -> Column:
    """Share of 1s among the non-NULL 0/1 flags, in percent."""
    return ratio(F.sum(flag) * 100, F.count(flag))


def flag(condition: Column) -> Column:
    """1 when true, otherwise 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def period_key(year: Column, part: Column, width: int) -> Column:
    """Sort key of a period within a year: ``year * width + part``."""
    return year * F.lit(width) + part
