"""Wide grouped profiles of the transaction logs.

A spec maps a column to the statistics wanted of it; `agg_spec` turns it into
one grouped aggregate. All statistics merge from partial results, so a key that
holds a third of the log is combined on the map side like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.lookup import lookup, pulled, together
from cardloom.functions.stats import aggregate, floor_days, ntz, safe_ratio
from cardloom.operators import amounts, calendar, cleaning

Spec = dict[str, tuple[str, ...]]

# What the profiles read of a log.
LOG_COLUMNS = (
    "card_id",
    "merchant_id",
    "merchant_category_id",
    "subsector_id",
    "authorized_flag",
    "category_1",
    "category_2",
    "category_3",
    "installments",
    "purchase_amount",
    "purchase_date",
    "month_lag",
)

SIX = ("sum", "max", "min", "mean", "var", "skew")


def agg_spec(
    df: DataFrame, key: str, spec: Mapping[str, Sequence[str]], prefix: str = "", placed: bool = False
) -> DataFrame:
    """One row per non-null key with ``<prefix><column>_<stat>`` columns.

    Open-ended distinct counts run as a narrow aggregate of their own: in one
    aggregate with the rest, every row would be expanded once per counted
    column and carry all the other buffers through the shuffle. Both results
    are partitioned by the key, so joining them shuffles nothing. The statistic
    ``small_nunique`` is a distinct count of whole numbers in 0..63, made with the others
    and named like ``nunique``; a value outside is an error. ``placed`` rows are already
    partitioned by key; each distinct count is then made apart, since several at once expand
    the rows and lose the partitioning.
    """
    df = df.filter(F.col(key).isNotNull())
    names, plain, counted = [], [], []
    for column, stats in spec.items():
        if {"nunique", "small_nunique"} <= set(stats):
            raise ValueError(f"{column}: nunique and small_nunique are one statistic of one name")
        for stat in stats:
            name = f"{prefix}{column}_{stat.removeprefix('small_')}"
            names.append(name)
            (counted if stat == "nunique" else plain).append(aggregate(stat, column, name))
    out = [key, *[f"`{n}`" for n in names]]
    if not counted:
        return df.groupBy(key).agg(*plain).select(*out)
    sides = [[c] for c in counted] if placed else [counted]
    distinct = reduce(lambda a, b: a.join(b, key), (df.groupBy(key).agg(*side) for side in sides))
    if not plain:
        return distinct.select(*out)
    return df.groupBy(key).agg(*plain).join(distinct, key).select(*out)


def category_amount_stats(
    df: DataFrame,
    columns: Sequence[str] = ("category_2", "category_3"),
    stats: Sequence[str] = ("mean", "min", "max", "sum"),
    value: str = "purchase_amount",
    over: DataFrame | None = None,
) -> DataFrame:
    """Statistics of the amount per category, attached to every row. One pass
    over the log serves all the columns. They are those of ``over``, where ``df`` is
    only a part of the log."""
    combined = (
        (df if over is None else over)
        .groupBy(*columns)
        .agg(
            F.sum(value).alias("s"),
            F.count(value).alias("n"),
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
        )
    )
    # A handful of rows in practice; computed once when that holds.
    combined = combined if (local := pulled(combined)) is None else local
    made = {
        "mean": F.try_divide(F.sum("s"), F.sum("n")),
        "min": F.min("lo"),
        "max": F.max("hi"),
        "sum": F.coalesce(F.sum("s"), F.lit(0.0)),
    }
    for c in columns:
        table = (
            combined.filter(F.col(c).isNotNull())
            .groupBy(c)
            .agg(*[made[s].alias(f"{c}_{s}") for s in stats])
        )
        df = df.join(F.broadcast(table), c, "left") if local is not None else lookup(df, table, [c])
    return df


def purchase_span(df: DataFrame, as_of: str, prefix: str, size: str = "card_id_size") -> DataFrame:
    """Days between first and last purchase, that over the row count, and days
    from the last and the first purchase to ``as_of``."""
    first, last = F.col(f"`{prefix}purchase_date_min`"), F.col(f"`{prefix}purchase_date_max`")
    span = floor_days(last, first)
    return df.withColumns(
        {
            f"{prefix}purchase_date_diff": span,
            f"{prefix}purchase_date_average": safe_ratio(span, f"{prefix}{size}"),
            f"{prefix}purchase_date_uptonow": floor_days(ntz(as_of), last),
            f"{prefix}purchase_date_uptomin": floor_days(ntz(as_of), first),
        }
    )


def hist_spec(holidays: Sequence[str] = tuple(calendar.HOLIDAYS)) -> Spec:
    return {
        "subsector_id": ("nunique",),
        "merchant_id": ("nunique",),
        "merchant_category_id": ("nunique",),
        "month": ("small_nunique", "mean", "min", "max"),
        "hour": ("small_nunique", "mean", "min", "max"),
        "weekofyear": ("small_nunique", "mean", "min", "max"),
        "weekday": ("mean",),
        "day": ("small_nunique", "mean", "min"),
        "purchase_amount": SIX,
        "installments": ("sum", "max", "mean", "var", "skew"),
        "purchase_date": ("max", "min"),
        "month_lag": ("max", "min", "mean", "var", "skew"),
        "month_diff": ("max", "min", "mean", "var", "skew"),
        "authorized_flag": ("mean",),
        "weekend": ("mean",),
        "category_1": ("mean",),
        "category_2": ("mean",),
        "category_3": ("mean",),
        "card_id": ("size", "count"),
        "price": ("sum", "mean", "max", "min", "var"),
        **{h: ("mean",) for h in holidays},
        "duration": ("mean", "min", "max", "var", "skew"),
        "amount_month_ratio": ("mean", "min", "max", "var", "skew"),
        "category_2_mean": ("mean",),
        "category_3_mean": ("mean",),
    }


def new_spec(holidays: Sequence[str] = calendar.NEW_HOLIDAYS) -> Spec:
    spec = hist_spec(holidays)
    del spec["authorized_flag"]
    spec |= {
        "month": ("mean", "min", "max"),
        "weekday": ("mean", "min", "max"),
        "day": ("small_nunique", "mean", "min", "max"),
        "month_diff": ("mean", "var", "skew"),
        "price": ("mean", "max", "min", "var"),
    }
    return spec


def lag_spec(holidays: Sequence[str] = tuple(calendar.HOLIDAYS)) -> Spec:
    spec = hist_spec(holidays)
    del spec["month_lag"]
    return spec


def merchant_spec(holidays: Sequence[str] = tuple(calendar.HOLIDAYS)) -> Spec:
    spec = hist_spec(holidays)
    return spec | {"card_id": ("nunique",), "merchant_id": ("count", "size")}


def amount_spec() -> Spec:
    wide = (
        "purchase_amount",
        "price",
        "duration",
        "amount_month_ratio",
        "duration_no",
        "amount_month_ratio_no",
    )
    crossed = (
        "authorized_flag_amount",
        "category_3_amount",
        "category_2_amount",
        "category_1_amount",
        "monthlag_amount",
    )
    return {
        **{c: SIX for c in wide},
        "category_3": ("mean",),
        **{c: SIX for c in crossed},
        "category_3_mean": ("mean",),
    }


def quarter_spec(starts: Sequence[str] = calendar.QUARTER_STARTS) -> Spec:
    spec: Spec = {}
    for start in starts:
        name = calendar.window_name(start)
        spec[name + "price"] = ("sum", "mean", "max", "min", "var")
        spec[name] = ("sum", "mean")
    return spec


def enrich(
    log: DataFrame,
    as_of: str,
    holidays: Mapping[str, str],
    amount: str = "clip",
    installments_plus1: bool = False,
    lag_in_month_diff: bool = True,
    whole: DataFrame | None = None,
) -> DataFrame:
    """Cleaned log with every column the profile specs name. Where ``log`` is only a part of
    a log, category means are those of the ``whole``."""
    df = cleaning.clean(log, amount)
    df = calendar.weekend_flag(calendar.calendar_parts(df))
    df = amounts.price_ratio_plus1(df) if installments_plus1 else amounts.price_ratio(df)
    df = calendar.holiday_proximity(df, holidays)
    if lag_in_month_diff:
        df = calendar.month_diff(df, as_of)
    else:
        df = calendar.month_diff_nolag(df, as_of, name="month_diff")
    df = amounts.amount_month_ratio(amounts.duration(df))
    over = None if whole is None else cleaning.clean(whole, amount)
    return category_amount_stats(df, stats=("mean",), over=over)


def hist_card_profile(
    hist: DataFrame, as_of: str, holidays: Mapping[str, str] = calendar.HOLIDAYS
) -> DataFrame:
    def profile(rows: DataFrame, placed: bool) -> DataFrame:
        df = enrich(rows, as_of, holidays, whole=hist)
        return agg_spec(df, "card_id", hist_spec(tuple(holidays)), "hist_", placed)

    return purchase_span(together(hist, "card_id", profile), as_of, "hist_")


def new_card_profile(
    new: DataFrame, as_of: str, holidays: Mapping[str, str] | None = None
) -> DataFrame:
    if holidays is None:
        holidays = {h: calendar.HOLIDAYS[h] for h in calendar.NEW_HOLIDAYS}
    def profile(rows: DataFrame, placed: bool) -> DataFrame:
        df = enrich(rows, as_of, holidays, whole=new)
        return agg_spec(df, "card_id", new_spec(tuple(holidays)), "new_", placed)

    return purchase_span(together(new, "card_id", profile), as_of, "new_")


def lag_profile(
    hist: DataFrame, k: int, as_of: str, holidays: Mapping[str, str] = calendar.HOLIDAYS
) -> DataFrame:
    """Profile of the rows with month_lag >= k. The category means are those of
    the whole log, so the filter comes after them."""
    prefix = f"hist_monthlag{k}"
    df = enrich(hist, as_of, holidays, lag_in_month_diff=False)
    df = cleaning.filter_lag_from(df, k)
    df = purchase_span(agg_spec(df, "card_id", lag_spec(tuple(holidays)), prefix), as_of, prefix)
    return df.drop(f"{prefix}purchase_date_max", f"{prefix}purchase_date_min")


def quarter_profile(
    hist: DataFrame, starts: Sequence[str] = calendar.QUARTER_STARTS
) -> DataFrame:
    df = amounts.price_ratio_plus1(cleaning.clean(hist))
    df = calendar.quarter_window_flags(df, starts)
    return agg_spec(df, "card_id", quarter_spec(starts), "hist_")


def amount_columns(log: DataFrame, as_of: str, whole: DataFrame | None = None) -> DataFrame:
    """With ``whole``, ``log`` is a part of it, and category means are those of the whole."""
    df = cleaning.clean(log, "restore", unknown_category=True)
    df = amounts.price_ratio_plus1(calendar.weekend_flag(df))
    df = calendar.month_diff_nolag(calendar.month_diff(df, as_of), as_of)
    df = amounts.duration_no(amounts.duration(df))
    df = amounts.amount_month_ratio_no(amounts.amount_month_ratio(df))
    df = amounts.monthlag_amount(amounts.amount_interactions(df))
    over = None if whole is None else cleaning.clean(whole, "restore", unknown_category=True)
    return category_amount_stats(df, ("category_3",), ("mean",), over=over)


def new_amount_profile(new: DataFrame, as_of: str) -> DataFrame:
    return agg_spec(amount_columns(new, as_of), "card_id", amount_spec(), "new_amount")


def hist_amount_profile(hist: DataFrame, lo: int, hi: int, as_of: str) -> DataFrame:
    """Amounts over the rows with lo <= month_lag <= hi."""
    df = cleaning.filter_lag_range(amount_columns(hist, as_of), lo, hi)
    return agg_spec(df, "card_id", amount_spec(), f"hist_month{lo}{hi}_amount")
