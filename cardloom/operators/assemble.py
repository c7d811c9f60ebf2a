"""Joining the feature tables and the features across both logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.stats import floor_days, safe_ratio

DATE_COLUMNS = (
    "hist_purchase_date_max",
    "hist_purchase_date_min",
    "new_purchase_date_max",
    "new_purchase_date_min",
)


def assemble_features(cards: DataFrame, frames: Sequence[DataFrame], how: str = "left") -> DataFrame:
    """All feature tables on card_id. Each is one row per card and partitioned by
    it, so only the cards are shuffled. ``how='outer'`` also keeps cards that
    occur in a feature table only."""
    how = {"left": "left", "outer": "full"}[how]
    return reduce(lambda a, b: a.join(b, "card_id", how), frames, cards)


def first_last_buy(df: DataFrame) -> DataFrame:
    """Days from the first active month to the first and last purchase."""
    new = {}
    for log in ("hist", "new"):
        for edge, name in (("min", "first"), ("max", "last")):
            new[f"{log}_{name}_buy"] = floor_days(f"{log}_purchase_date_{edge}", "first_active_month")
    return df.withColumns(new)


def to_epoch_seconds(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Timestamps to seconds since 1970, the same in every session time zone."""
    origin = F.lit("1970-01-01").cast("timestamp_ntz")
    return df.withColumns(
        {
            c: F.timestamp_diff("MICROSECOND", origin, F.col(c).cast("timestamp_ntz")) / F.lit(1e6)
            for c in columns
        }
    )


# result, operation, new column, hist column (without their prefixes)
_PAIRS = (
    ("card_id_total", "+", "card_id_size"),
    ("card_id_cnt_total", "+", "card_id_count"),
    ("card_id_cnt_ratio", "/", "card_id_count"),
    ("purchase_amount_total", "+", "purchase_amount_sum"),
    ("purchase_amount_mean", "+", "purchase_amount_mean"),
    ("purchase_amount_max", "+", "purchase_amount_max"),
    ("purchase_amount_min", "+", "purchase_amount_min"),
    ("purchase_amount_ratio", "/", "purchase_amount_sum"),
    ("month_diff_mean", "+", "month_diff_mean"),
    ("month_diff_ratio", "/", "month_diff_mean"),
    ("month_lag_mean", "+", "month_lag_mean"),
    ("month_lag_max", "+", "month_lag_max"),
    ("month_lag_min", "+", "month_lag_min"),
    ("category_1_mean", "+", "category_1_mean"),
    ("installments_total", "+", "installments_sum"),
    ("installments_mean", "+", "installments_mean"),
    ("installments_max", "+", "installments_max"),
    ("installments_ratio", "/", "installments_sum"),
    ("duration_mean", "+", "duration_mean"),
    ("duration_min", "+", "duration_min"),
    ("duration_max", "+", "duration_max"),
    ("amount_month_ratio_mean", "+", "amount_month_ratio_mean"),
    ("amount_month_ratio_min", "+", "amount_month_ratio_min"),
    ("amount_month_ratio_max", "+", "amount_month_ratio_max"),
)


def hist_new_combine(df: DataFrame) -> DataFrame:
    """Sums and ratios of the new and historical profile, prices of the sums, and
    customer lifetime values; NULL when one log lacks the card."""
    new = {}
    for name, op, column in _PAIRS:
        n, h = F.col(f"new_{column}"), F.col(f"hist_{column}")
        new[name] = n + h if op == "+" else safe_ratio(n, h)
    for log in ("new", "hist"):
        new[f"{log}_CLV"] = safe_ratio(
            F.col(f"{log}_card_id_count") * F.col(f"{log}_purchase_amount_sum"),
            f"{log}_month_diff_mean",
        )
    df = df.withColumns(new)
    return df.withColumns(
        {
            "price_total": safe_ratio("purchase_amount_total", "installments_total"),
            "price_mean": safe_ratio("purchase_amount_mean", "installments_mean"),
            "price_max": safe_ratio("purchase_amount_max", "installments_max"),
            "CLV_ratio": safe_ratio("new_CLV", "hist_CLV"),
        }
    )


def union_folds(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack per-fold results, and the test cards, by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
