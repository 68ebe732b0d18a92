"""Calendar expressions.  A period is the first day of its month, as DATE."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Spanish month names as they appear in the monthly cost file.
SPANISH_MONTHS = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)

# Day of month on which a statement falls due.
FIRST_DUE_DAY = 10
SECOND_DUE_DAY = 15


def period_of(date: Column) -> Column:
    return F.trunc(date, "MM")


def shift_period(period: Column, months: int) -> Column:
    return F.add_months(period, months)


def due_date(period: Column, day: int) -> Column:
    return F.date_add(period, day - 1)


def month_index(period: Column) -> Column:
    """Months since year 0, so that consecutive periods differ by one."""
    return F.year(period) * 12 + F.month(period) - 1


def statement_key(owner_id: Column, period: Column) -> Column:
    """Natural BIGINT key of a (building or unit, period) pair: id followed by yyyyMM."""
    return owner_id.cast("bigint") * 1000000 + F.year(period) * 100 + F.month(period)


def us_week(date: Column) -> Column:
    """Week of the year with weeks starting on Sunday and January 1st in week 1."""
    january_first = F.dayofweek(F.trunc(date, "YEAR"))
    return F.call_function("div", F.dayofyear(date) + january_first - 2, F.lit(7)).cast("int") + 1


def spanish_month_number(name: Column) -> Column:
    """1..12 for a Spanish month name, whatever its case and outer blanks; else null."""
    pairs = [F.lit(x) for i, m in enumerate(SPANISH_MONTHS, 1) for x in (m, i)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(name)))


def spanish_month_name(number: Column) -> Column:
    return F.get(F.array(*[F.lit(m) for m in SPANISH_MONTHS]), number - 1)


def nth_business_day(year: Column, month: Column, n: Column) -> Column:
    """n-th Monday-to-Friday day of a month; null past its end, the 1st when n < 1."""
    first = F.make_date(year, month, F.lit(1))
    weekdays = F.filter(
        F.sequence(first, F.last_day(first)), lambda d: ~F.dayofweek(d).isin(1, 7)
    )
    return F.when(n < 1, first).otherwise(F.get(weekdays, n - 1))


def in_period(date: Column, year: int, month: int) -> Column:
    """Half-open month range, so that parquet statistics can prune row groups."""
    start = dt.date(year, month, 1)
    end = dt.date(year + month // 12, month % 12 + 1, 1)
    return (date >= F.lit(start)) & (date < F.lit(end))


def in_year(date: Column, year: int) -> Column:
    return (date >= F.lit(dt.date(year, 1, 1))) & (date < F.lit(dt.date(year + 1, 1, 1)))


def in_range(date: Column, since: dt.date | None, until: dt.date | None, as_of: dt.date | None = None) -> Column:
    """Inclusive date range; an open start is everything, an open end ``as_of``, which is today unless given."""
    upper = F.lit(until or as_of) if until or as_of else F.current_date()
    condition = date <= upper
    return condition if since is None else condition & (date >= F.lit(since))
