"""Rules for dates and the attributes of a calendar day."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Accepted day layouts after "/" has become "-", and how their parts make an ISO day.
ISO_DAY = (r"^(\d{4})-(\d{2})-(\d{2})$", "$1-$2-$3")
US_DAY = (r"^(\d{2})-(\d{2})-(\d{4})$", "$3-$1-$2")


def standard_date(text: Column, layouts: Iterable[tuple[str, str]] = (ISO_DAY,)) -> Column:
    """The date under the first layout that fits; impossible dates and other text give NULL.

    The text is put in ISO order and cast: unlike a formatter, the cast neither builds nor
    throws anything for text that is no date.
    """
    dashed = F.replace(text, F.lit("/"), F.lit("-"))
    readings = [
        F.when(dashed.rlike(shape), (dashed if (shape, order) == ISO_DAY else F.regexp_replace(dashed, shape, order)).try_cast("date"))
        for shape, order in layouts
    ]
    return F.coalesce(*readings)


def day_number(day: Column) -> Column:
    """Integer key ``yyyymmdd``, from arithmetic rather than text formatting."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar(day: Column) -> dict[str, Column]:
    """Attributes of a date dimension row; the week starts with Sunday = 0."""
    return {
        "date_key": day_number(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month_number": F.month(day),
        "month_name": F.monthname(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week_number": F.dayofweek(day) - 1,
        "day_name": F.dayname(day),
    }
