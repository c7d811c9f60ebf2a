import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardloom.functions.stats import floor_days, half_even, ntz, safe_ratio, smoothed_mean
from cardloom.operators import cards, cleaning, columns, profiles
from cardloom.operators.calendar import holiday_proximity, month_diff_nolag


def values(df, column):
    return [r[column] for r in df.collect()]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0), (-1.0, 0), (0.0, 0), (3.0, 2), (None, 2)], "a double, b int")
    assert values(df.select(safe_ratio("a", "b").alias("r")), "r") == [None, None, None, 1.5, None]
    got = values(df.select(safe_ratio("a", "b", "inf").alias("r")), "r")
    assert got == [math.inf, -math.inf, None, 1.5, None]
    with pytest.raises(ValueError):
        safe_ratio("a", "b", "zero")


def test_floor_days_rounds_down(spark):
    df = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ'2001-01-01 12:00:00', TIMESTAMP_NTZ'2000-12-31 12:00:00')) AS t"
    )
    assert values(df.select(floor_days(ntz("2001-01-01"), "t").alias("d")), "d") == [-1, 0]


def test_thirty_day_months_round_down(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2001-01-02 00:00:00' AS purchase_date")
    assert values(month_diff_nolag(df, "2001-01-01"), "nomonth_diff") == [-1]


def test_holiday_gate_is_open_at_1_and_99(spark):
    df = spark.sql(
        "SELECT explode(array('2000-12-25', '2000-12-24', '2000-09-17', '2000-09-16', '2000-12-26'))"
        " AS d"
    ).select(F.col("d").cast("timestamp_ntz").alias("purchase_date"))
    got = values(holiday_proximity(df, {"x": "2000-12-25"}), "x")
    assert got == [0, 1, 99, 0, 0]


GROUPS = {
    "one": [2.5],
    "two": [1.0, 4.0],
    "flat": [3.0] * 5,
    "some": [1.0, 2.0, 9.0, 4.5, -3.0],
    "gaps": [None, 1.0, None, 7.0, 2.0],
    "none": [None, None],
}


def test_agg_spec_equals_pandas(spark):
    rows = [(k, v) for k, vs in GROUPS.items() for v in vs] + [(None, 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    stats = ("sum", "mean", "min", "max", "var", "skew", "count", "size", "nunique")
    got = {r["k"]: r for r in profiles.agg_spec(df, "k", {"v": stats}, "p_").collect()}
    grouped = pd.DataFrame(rows, columns=["k", "v"]).groupby("k")["v"]
    want = pd.DataFrame({s: getattr(grouped, s)() for s in stats})
    assert set(got) == set(GROUPS)
    for k in GROUPS:
        for s in stats:
            a, b = got[k][f"p_v_{s}"], want.loc[k, s]
            assert (a is None and pd.isna(b)) or a == pytest.approx(b, abs=1e-12), (k, s)


def test_calendar_distinct_count(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (1, 53), (2, None), (3, 63)], "k int, month int")
    got = profiles.agg_spec(df, "k", {"month": ("nunique",)}).collect()
    assert {r["k"]: r["month_nunique"] for r in got} == {1: 2, 2: 0, 3: 1}


def test_unknown_statistic(spark):
    with pytest.raises(ValueError):
        profiles.agg_spec(spark.range(3), "id", {"id": ("median",)})


def test_clean_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (0.9,), (0.5,)], "purchase_amount double")
    assert values(cleaning.clip_upper(df), "purchase_amount") == [None, 0.8, 0.5]
    df = spark.createDataFrame([(-1,), (999,), (0,), (None,)], "installments int")
    assert values(cleaning.sentinel_to_null(df), "installments") == [None, None, 0, None]


def test_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (-2.5,), (2.4,)], "x double")
    assert values(df.select(half_even("x").alias("r")), "r") == [0.0, 2.0, -2.0, 2.0]


def test_rowwise_deviation_skips_nulls(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 4.0), (1.0, None, 4.0), (1.0, None, None)], "feature_1 double, feature_2 double, feature_3 double"
    )
    got = cards.rowwise_stats(df).collect()
    want = pd.DataFrame([(1, 2, 4), (1, None, 4), (1, None, None)], dtype=float).std(axis=1)
    assert got[0]["feature_var"] == pytest.approx(want[0])
    assert got[1]["feature_var"] == pytest.approx(want[1])
    assert got[2]["feature_var"] is None
    assert got[1]["feature_sum"] is None and got[1]["feature_max"] == 4.0


def test_smoothed_mean(spark):
    df = spark.createDataFrame([(10.0, 85), (0.0, 0), (400.0, 400)], "s double, n long")
    got = values(df.select(smoothed_mean(F.col("s"), F.col("n"), F.lit(1.0)).alias("e")), "e")
    assert got[0] == pytest.approx((1.0 + 10 / 85) / 2)
    assert got[1] is None
    assert got[2] == pytest.approx(1.0)


def test_narrow_types_bounds_are_strict(spark):
    df = spark.createDataFrame(
        [(126, 127, -128, 1.0, 1e300), (0, 0, 0, 2.0, 0.0)], "a int, b int, c long, d double, e double"
    )
    got = dict(columns.narrow_types(df).dtypes)
    assert got == {"a": "tinyint", "b": "smallint", "c": "smallint", "d": "float", "e": "double"}


def test_one_hot_limit(spark):
    with pytest.raises(ValueError):
        cards.one_hot(spark.range(20), ["id"], max_values=10)


def test_category_stats_ignore_null_category(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 9.0)], "c string, purchase_amount double")
    got = profiles.category_amount_stats(df, ["c"], ["mean", "sum"]).collect()
    assert sorted((r["c"], r["c_mean"], r["c_sum"]) for r in got if r["c"]) == [("a", 2.0, 4.0)] * 2
    assert [r["c_mean"] for r in got if r["c"] is None] == [None]
