"""Price, duration and interaction columns of a cleaned log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.stats import safe_ratio

AMOUNT = "purchase_amount"


def price_ratio(df: DataFrame, on_zero: str = "null") -> DataFrame:
    return df.withColumn("price", safe_ratio(AMOUNT, "installments", on_zero))


def price_ratio_plus1(df: DataFrame, on_zero: str = "null") -> DataFrame:
    return df.withColumn("price", safe_ratio(AMOUNT, F.col("installments") + 1, on_zero))


def duration(df: DataFrame) -> DataFrame:
    return df.withColumn("duration", F.col(AMOUNT) * F.col("month_diff"))


def amount_month_ratio(df: DataFrame, on_zero: str = "null") -> DataFrame:
    return df.withColumn("amount_month_ratio", safe_ratio(AMOUNT, "month_diff", on_zero))


def duration_no(df: DataFrame) -> DataFrame:
    return df.withColumn("duration_no", F.col(AMOUNT) * F.col("nomonth_diff"))


def amount_month_ratio_no(df: DataFrame, on_zero: str = "null") -> DataFrame:
    return df.withColumn("amount_month_ratio_no", safe_ratio(AMOUNT, "nomonth_diff", on_zero))


def amount_interactions(df: DataFrame) -> DataFrame:
    factors = ("authorized_flag", "category_3", "category_1", "category_2", "weekend")
    return df.withColumns({f + "_amount": F.col(f) * F.col(AMOUNT) for f in factors})


def monthlag_amount(df: DataFrame, on_zero: str = "null") -> DataFrame:
    """Amount over (month_lag - 1); lag 1 divides by zero."""
    return df.withColumn(
        "monthlag_amount", safe_ratio(AMOUNT, F.col("month_lag") - 1, on_zero)
    )
