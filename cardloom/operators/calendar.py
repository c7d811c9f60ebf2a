"""Dates: parsing, calendar parts, holidays, ages in days and months."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions.stats import floor_days, ntz

# Default holidays, by the names used in the feature columns.
HOLIDAYS = {
    "Christmas_Day_2017": "2017-12-25",
    "Mothers_Day_2017": "2017-06-04",
    "fathers_day_2017": "2017-08-13",
    "Children_day_2017": "2017-10-12",
    "Valentine_Day_2017": "2017-06-12",
    "Black_Friday_2017": "2017-11-24",
    "Mothers_Day_2018": "2018-05-13",
}
NEW_HOLIDAYS = ("Christmas_Day_2017", "Children_day_2017", "Black_Friday_2017", "Mothers_Day_2018")
QUARTER_STARTS = (
    "2017-01-01",
    "2017-04-01",
    "2017-07-01",
    "2017-10-01",
    "2018-01-01",
    "2018-04-01",
)
HOLIDAY_HORIZON_DAYS = 100
QUARTER_DAYS = 91
DAYS_PER_MONTH = 30


def parse_dates(df: DataFrame, column: str, to: str = "timestamp_ntz") -> DataFrame:
    """Text to date or timestamp. A bare yyyy-MM means the first of the month;
    text that is no date becomes NULL."""
    c = F.trim(F.col(column))
    full = F.when(F.length(c) == 7, F.concat(c, F.lit("-01"))).otherwise(c)
    return df.withColumn(column, full.try_cast(to))


def calendar_parts(df: DataFrame, column: str = "purchase_date") -> DataFrame:
    """Month, day, hour, ISO week and weekday with Monday as 0."""
    c = F.col(column)
    return df.withColumns(
        {
            "month": F.month(c),
            "day": F.dayofmonth(c),
            "hour": F.hour(c),
            "weekofyear": F.weekofyear(c),
            "weekday": F.weekday(c),
        }
    )


def weekend_flag(df: DataFrame, column: str = "purchase_date") -> DataFrame:
    return df.withColumn("weekend", (F.weekday(F.col(column)) >= 5).cast("int"))


def quarter(df: DataFrame, column: str = "first_active_month") -> DataFrame:
    return df.withColumn("quarter", F.quarter(F.col(column)))


def days_until(date: str, column: str) -> Column:
    return floor_days(ntz(date), column)


def holiday_proximity(
    df: DataFrame, holidays: Mapping[str, str] = HOLIDAYS, column: str = "purchase_date"
) -> DataFrame:
    """Days until each holiday when it lies 1 to 99 days ahead, else 0."""
    new = {}
    for name, date in holidays.items():
        days = days_until(date, column)
        near = (days > 0) & (days < HOLIDAY_HORIZON_DAYS)
        new[name] = F.when(near, days).otherwise(F.lit(0).cast("long"))
    return df.withColumns(new)


def _months_before(as_of: str, column: str) -> Column:
    return F.floor(floor_days(ntz(as_of), column) / F.lit(DAYS_PER_MONTH))


def month_diff(df: DataFrame, as_of: str, column: str = "purchase_date") -> DataFrame:
    """Thirty-day months from purchase to ``as_of``, shifted by month_lag."""
    return df.withColumn("month_diff", _months_before(as_of, column) + F.col("month_lag"))


def month_diff_nolag(
    df: DataFrame, as_of: str, column: str = "purchase_date", name: str = "nomonth_diff"
) -> DataFrame:
    return df.withColumn(name, _months_before(as_of, column))


def window_name(start: str) -> str:
    """'2017-04-01' -> '20174'."""
    year, month, _ = start.split("-")
    return f"{year}{int(month)}"


def quarter_window_flags(
    df: DataFrame, starts: Sequence[str] = QUARTER_STARTS, column: str = "purchase_date"
) -> DataFrame:
    """Per start date: 1 when the purchase lies 1 to 90 days before it, and that
    flag times the price."""
    flags = {}
    for start in starts:
        days = days_until(start, column)
        flags[window_name(start)] = F.when((days > 0) & (days < QUARTER_DAYS), 1).otherwise(0)
    df = df.withColumns(flags)
    return df.withColumns({n + "price": F.col(f"`{n}`") * F.col("price") for n in flags})
