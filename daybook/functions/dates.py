"""Dates, calendar attributes and the demand calendar as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.scalars import literal_map
from daybook.schemas import HOLIDAYS


def iso_text(moment: Column) -> Column:
    """ISO date text of a date or timestamp."""
    return F.date_format(moment, "yyyy-MM-dd")


def shifted(
    moment: Column, days=0, hours=0, minutes=0, seconds=0
) -> Column:
    """Timestamp plus (or, negative, minus) an interval; each part is a number or a column."""
    parts = [F.lit(p) if isinstance(p, (int, float)) else p for p in (days, hours, minutes, seconds)]
    return moment + F.make_interval(
        days=parts[0], hours=parts[1], mins=parts[2], secs=parts[3].cast("decimal(18,6)")
    )


def arrival_date(event_time: Column, load_date: Column, delay_days: Column) -> Column:
    """Day a row lands: the later of event day and load day, plus its delay."""
    return F.date_add(F.greatest(F.to_date(event_time), load_date), delay_days)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def holiday_name(day: Column) -> Column:
    """Name of the public holiday on a day, else NULL."""
    return F.try_element_at(literal_map(HOLIDAYS), iso_text(day))


def calendar_columns(day: Column) -> dict[str, Column]:
    """The attributes of the date dimension."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.weekday(day) + 1,
        "day_name": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day),
        "is_weekend": is_weekend(day),
        "is_polish_public_holiday": holiday_name(day).isNotNull(),
        "holiday_name": holiday_name(day),
    }


def within(day: Column, start: Column, end: Column) -> Column:
    """Whether a day lies in a range, both ends included."""
    return day.between(start, end)


def _demand(day: Column) -> Column:
    one = F.lit("1").cast("decimal(6,4)")

    def factor(applies: Column, value: str) -> Column:
        return F.when(applies, F.lit(value).cast("decimal(6,4)")).otherwise(one)

    month, date = F.month(day), F.dayofmonth(day)
    return (
        factor(F.weekday(day) >= 4, "1.35")
        * factor((month == 1) & (date <= 21), "1.15")
        * factor((month == 2) & (date <= 16), "1.10")
        * factor(month == 3, "1.20")
        * factor(iso_text(day).isin("2026-01-01", "2026-01-06"), "0.65")
    )


def demand_factor(day: Column) -> Column:
    """Expected order volume of a day relative to a plain weekday (product of fixed factors)."""
    return _demand(day).cast("double")


def expected_orders(day: Column, average: int) -> Column:
    """Whole number of orders expected on a day, from the average of a plain weekday."""
    return F.greatest(F.lit(0), (F.lit(average).cast("decimal(4,0)") * _demand(day)).cast("int"))
