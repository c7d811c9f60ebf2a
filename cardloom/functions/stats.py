"""Expressions whose default Spark meaning differs from the one wanted here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def as_col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def ntz(value: str) -> Column:
    """Timestamp literal without time zone."""
    return F.lit(value).cast("timestamp_ntz")


def safe_ratio(a: Column | str, b: Column | str, on_zero: str = "null") -> Column:
    """a / b in double. A zero divisor gives NULL, or with ``on_zero='inf'``
    a signed infinity (NULL for 0/0)."""
    a, b = as_col(a).cast("double"), as_col(b).cast("double")
    ratio = F.try_divide(a, b)
    if on_zero == "null":
        return ratio
    if on_zero != "inf":
        raise ValueError(f"on_zero must be 'null' or 'inf', got {on_zero!r}")
    return (
        F.when((b == 0) & (a > 0), F.lit(float("inf")))
        .when((b == 0) & (a < 0), F.lit(float("-inf")))
        .otherwise(ratio)
    )


def floor_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole days elapsed, rounded down, so twelve hours early is -1."""
    micros = F.timestamp_diff(
        "MICROSECOND",
        as_col(earlier).cast("timestamp_ntz"),
        as_col(later).cast("timestamp_ntz"),
    )
    return F.floor(micros / F.lit(float(MICROS_PER_DAY)))


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(as_col(c), digits)


# Aggregates as SQL text, one expression per statistic: wide profiles hold
# hundreds of them. {c} is the quoted column.
AGGREGATES = {
    # 0, not NULL, for a group without values.
    "sum": "coalesce(sum({c}), 0)",
    "mean": "avg({c})",
    "min": "min({c})",
    "max": "max({c})",
    "var": "var_samp({c})",
    # With the bias adjustment; NULL under 3 values, 0 for a constant group.
    "skew": (
        "CASE WHEN count({c}) < 3 THEN NULL WHEN min({c}) = max({c}) THEN 0D"
        " ELSE skewness({c}) * sqrt(count({c}) * (count({c}) - 1D)) / (count({c}) - 2) END"
    ),
    "size": "count(1)",
    "count": "count({c})",
    "nunique": "count(DISTINCT {c})",
}


def checked_bit(column: str) -> str:
    """SQL for a value's bit in a mask. Only for whole numbers in 0..63; any other value is an
    error, since its bit would be another's."""
    c = f"`{column}`"
    message = f"{column} has a value that is no whole number in 0..63; count it with nunique"
    return (
        f"CASE WHEN {c} BETWEEN 0 AND 63 AND {c} = floor({c}) THEN shiftleft(1L, cast({c} AS int))"
        f" WHEN {c} IS NOT NULL THEN raise_error('{message}') END"
    )


def checked_bits(column: str) -> str:
    """SQL for the set of a group's values as one 64-bit mask: it merges like a sum, where
    count(DISTINCT) would expand and shuffle every row."""
    return f"bit_or({checked_bit(column)})"


def aggregate(stat: str, column: str, name: str) -> Column:
    """The statistic of the column under ``name``."""
    if stat == "small_nunique":
        return F.expr(f"coalesce(cast(bit_count({checked_bits(column)}) AS bigint), 0L) AS `{name}`")
    if stat not in AGGREGATES:
        raise ValueError(f"unknown statistic {stat!r} of {column}")
    return F.expr(AGGREGATES[stat].replace("{c}", f"`{column}`") + f" AS `{name}`")


def smoothed_mean(total: Column, n: Column, prior: Column, center: float = 85.0) -> Column:
    """Mean pulled to ``prior`` by a logistic weight on the row count."""
    w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n.cast("double") - F.lit(center))))
    mean = F.try_divide(total, n.cast("double"))
    return F.when(n > 0, prior * (F.lit(1.0) - w) + mean * w)
