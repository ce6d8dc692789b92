"""Date keys and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed_values as fv


def parse_timestamp(text: Column) -> Column:
    """Timestamp of a text value; malformed text gives null instead of an error."""
    return F.try_to_timestamp(text)


def date_id(date: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.date_format(date, fv.DATE_ID_FORMAT).cast("int")


def calendar_parts(date: Column) -> dict[str, Column]:
    """Columns of the tournament calendar (long weekday, ISO week, weekend)."""
    return {
        "date_id": date_id(date),
        "full_date": date,
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "week_of_year": F.weekofyear(date),
        "day_of_week": F.date_format(date, fv.LONG_WEEKDAY),
        "is_weekend": F.weekday(date) >= 5,
    }


def fact_date_parts(date: Column) -> dict[str, Column]:
    """Columns of a date dimension derived from a fact (short weekday)."""
    return {
        "date": date,
        "date_id": date_id(date),
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": F.date_format(date, fv.SHORT_WEEKDAY),
    }
