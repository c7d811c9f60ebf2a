"""Row-level cleaning of transactions and cards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.stats import half_even

# Fixed values of the data set: the stand-in merchant, the codes that mean
# "installments unknown", the outlier bound, the amount bound, and the affine
# map from the anonymised amount scale to currency.
DEFAULT_MERCHANT = "M_ID_00a6ca8a8a"
INSTALLMENT_SENTINELS = (-1, 999)
OUTLIER_BELOW = -30
AMOUNT_BOUND = 0.8
AMOUNT_SCALE = 0.00150265118
AMOUNT_SHIFT = 497.06
CATEGORY_3_CODES = {"A": 0, "B": 1, "C": 2}
CATEGORY_3_CODES_WITH_UNKNOWN = {"D": 0, "A": 1, "B": 2, "C": 3}


def fill_defaults(df: DataFrame, category_3: str = "A") -> DataFrame:
    return df.fillna(
        {"category_2": 1.0, "category_3": category_3, "merchant_id": DEFAULT_MERCHANT}
    )


def sentinel_to_null(
    df: DataFrame, column: str = "installments", sentinels: Sequence[int] = INSTALLMENT_SENTINELS
) -> DataFrame:
    c = F.col(column)
    return df.withColumn(column, F.when(~c.isin(*sentinels), c))


def clip_upper(
    df: DataFrame, column: str = "purchase_amount", bound: float = AMOUNT_BOUND
) -> DataFrame:
    """min(x, bound); NULL stays NULL, which `least` would turn into the bound."""
    c = F.col(column)
    return df.withColumn(column, F.when(c > bound, F.lit(bound)).otherwise(c))


def yn_to_int(
    df: DataFrame, columns: Sequence[str] = ("authorized_flag", "category_1")
) -> DataFrame:
    return df.withColumns(
        {c: F.when(F.col(c) == "Y", 1).when(F.col(c) == "N", 0) for c in columns}
    )


def recode_category3(df: DataFrame, codes: Mapping[str, int] = CATEGORY_3_CODES) -> DataFrame:
    out = F.lit(None).cast("int")
    for letter, code in codes.items():
        out = F.when(F.col("category_3") == letter, code).otherwise(out)
    return df.withColumn("category_3", out)


def restore_amount(df: DataFrame, column: str = "purchase_amount") -> DataFrame:
    return df.withColumn(
        column, half_even(F.col(column) / F.lit(AMOUNT_SCALE) + F.lit(AMOUNT_SHIFT), 8)
    )


def round_target(df: DataFrame, column: str = "target") -> DataFrame:
    return df.withColumn("rounded_target", half_even(column, 0))


def flag_outliers(df: DataFrame) -> DataFrame:
    """1 below the bound, 0 otherwise, NULL without a target."""
    target = F.col("target")
    return df.withColumn(
        "outliers", F.when(target < OUTLIER_BELOW, 1).when(target.isNotNull(), 0)
    )


def split_train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    target = F.col("target")
    return df.filter(target.isNotNull()), df.filter(target.isNull())


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(0, list(columns) if columns is not None else None)


def nan_pred_to_zero(df: DataFrame, column: str = "pred") -> DataFrame:
    zero = F.lit(0.0)
    return df.withColumn(column, F.coalesce(F.nanvl(F.col(column), zero), zero))


def filter_lag_from(df: DataFrame, k: int) -> DataFrame:
    return df.filter(F.col("month_lag") >= k)


def filter_lag_range(df: DataFrame, lo: int, hi: int) -> DataFrame:
    return df.filter(F.col("month_lag").between(lo, hi))


def clean(df: DataFrame, amount: str = "clip", unknown_category: bool = False) -> DataFrame:
    """The usual cleaning of a log. ``amount`` is 'clip' or 'restore';
    ``unknown_category`` keeps a missing category_3 as its own code."""
    df = fill_defaults(df, "D" if unknown_category else "A")
    df = sentinel_to_null(df)
    if amount == "clip":
        df = clip_upper(df)
    elif amount == "restore":
        df = restore_amount(df)
    else:
        raise ValueError(f"amount must be 'clip' or 'restore', got {amount!r}")
    df = yn_to_int(df)
    return recode_category3(
        df, CATEGORY_3_CODES_WITH_UNKNOWN if unknown_category else CATEGORY_3_CODES
    )
