"""Merchant profiles, and what they say about the cards that shop there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.lookup import clustered, hot_split_lookup, lookup, pulled, together
from cardloom.operators import calendar, cleaning
from cardloom.operators.columns import prefix_columns
from cardloom.operators.profiles import LOG_COLUMNS, agg_spec, enrich, merchant_spec, purchase_span
from cardloom.sources.staging import staged

# Merchant columns per grouped aggregate.
BLOCK = 25
COMBINED_PREFIX = "mer+his"
LOOKUP_PREFIX = "mer1"
DATES = ("purchase_date_max", "purchase_date_min")


def visited_only(log: DataFrame, visiting: DataFrame) -> DataFrame:
    """The rows of ``log`` at merchants that ``visiting`` has, a missing one being the
    default merchant in both. A semi-join, which the optimizer broadcasts or shuffles by the
    measured size of the visited merchants."""
    name = F.coalesce("merchant_id", F.lit(cleaning.DEFAULT_MERCHANT)).alias("merchant_id")
    merchants = visiting.select(name).distinct()
    return cleaning.fill_defaults(log).join(merchants, "merchant_id", "left_semi")


def merchant_profile(
    log: DataFrame,
    prefix: str,
    as_of: str,
    holidays: Mapping[str, str],
    amount: str,
    visiting: DataFrame | None = None,
) -> DataFrame:
    """With ``visiting``, only of the merchants in that log: those of any other would be
    aggregated for nobody. Category means stay those of the whole log."""
    whole = log.select(*LOG_COLUMNS)
    narrow = cleaning.fill_defaults(whole)
    if visiting is not None:
        narrow = visited_only(whole, visiting).select(*LOG_COLUMNS)
    # Logs are kept card by card, so a merchant's rows are everywhere: bring them
    # together while they are narrow.
    log = staged(clustered(narrow, "merchant_id"), "by-merchant")
    part = None if visiting is None else whole
    df = enrich(log, as_of, holidays, amount, installments_plus1=True, whole=part)
    df = agg_spec(df, "merchant_id", merchant_spec(tuple(holidays)), prefix)
    return purchase_span(df, as_of, prefix, size="merchant_id_size")


def hist_merchant_profile(
    hist: DataFrame,
    as_of: str,
    holidays: Mapping[str, str] = calendar.HOLIDAYS,
    amount: str = "clip",
    visiting: DataFrame | None = None,
) -> DataFrame:
    return merchant_profile(hist, "hist_", as_of, holidays, amount, visiting)


def new_merchant_profile(
    new: DataFrame,
    as_of: str,
    holidays: Mapping[str, str] = calendar.HOLIDAYS,
    amount: str = "restore",
) -> DataFrame:
    return merchant_profile(new, "new_", as_of, holidays, amount)


def merchant_full_join(new_profile: DataFrame, hist_profile: DataFrame) -> DataFrame:
    return new_profile.join(hist_profile, "merchant_id", "full")


def merchant_combined(new_profile: DataFrame, hist_profile: DataFrame) -> DataFrame:
    """Sum of the new and the historical value of each column of that name; a
    merchant missing on one side counts 0 there."""
    joined = merchant_full_join(new_profile, hist_profile)
    names = [
        c.removeprefix("hist_")
        for c in hist_profile.columns
        if c != "merchant_id" and not c.endswith(DATES)
    ]
    return joined.selectExpr(
        "merchant_id",
        *[
            f"coalesce(cast(`new_{n}` AS double), 0D) + coalesce(cast(`hist_{n}` AS double), 0D)"
            f" AS `{COMBINED_PREFIX}hist_{n}`"
            for n in names
        ],
    )


def merchant_lookup(
    log: DataFrame, merchants: DataFrame, small: bool | None = None
) -> DataFrame:
    """The merchant's profile on each row; NULLs for an unknown merchant.
    ``small`` says that the profile is already known to fit a broadcast."""
    renamed = prefix_columns(merchants, LOOKUP_PREFIX, keep=("merchant_id",))
    if small is None:
        return lookup(log, renamed, ["merchant_id"])
    if small:
        return log.join(F.broadcast(renamed), "merchant_id", "left")
    return hot_split_lookup(log, renamed, ["merchant_id"])


def card_merchant_profile(log: DataFrame, merchants: DataFrame, prefix: str = "new_") -> DataFrame:
    """Sum, mean, min and max of each merchant column over a card's purchases.

    The log is first reduced to one row per card and merchant with a count, so
    the profile meets each pair once however often the card shopped there.
    """
    visits = staged(
        cleaning.fill_defaults(log)
        .filter(F.col("card_id").isNotNull())
        .groupBy("card_id", "merchant_id")
        .agg(F.count(F.lit(1)).alias("__n")),
        "visits",
    )
    names = [c for c in merchants.columns if c != "merchant_id"]
    merchants = staged(merchants, "merchants")  # made once for all that reads it
    table = pulled(merchants)
    merchants = merchants if table is None else table

    joined = merchant_lookup(visits, merchants, small=table is not None)
    if table is None:
        joined = staged(joined, "visited")  # joined once for all blocks

    def block(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        stats = []
        for c in columns:
            name = LOOKUP_PREFIX + c
            v = f"`{name}`"
            total, n = f"sum({v} * __n)", f"sum(CASE WHEN {v} IS NOT NULL THEN __n END)"
            stats += [
                F.expr(f"coalesce({total}, 0D) AS `{prefix}{name}_sum`"),
                F.expr(f"try_divide({total}, {n}) AS `{prefix}{name}_mean`"),
                F.expr(f"min({v}) AS `{prefix}{name}_min`"),
                F.expr(f"max({v}) AS `{prefix}{name}_max`"),
            ]
        return rows.groupBy("card_id").agg(*stats)

    def profile(rows: DataFrame, _: bool) -> DataFrame:
        blocks = [block(rows, names[i : i + BLOCK]) for i in range(0, len(names), BLOCK)]
        return reduce(lambda a, b: a.join(b, "card_id"), blocks)

    return together(joined, "card_id", profile, count_in=visits)
