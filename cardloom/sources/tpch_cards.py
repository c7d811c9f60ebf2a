"""Cards and transaction logs read out of TPC-H style tables.

The sample data of this repository is an order star schema; this mapping shows
it as a card portfolio, nulls and sentinel codes included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-09-01"
HOLIDAYS = {
    "Christmas_Day_2000": "2000-12-25",
    "Mothers_Day_2000": "2000-06-04",
    "fathers_day_2000": "2000-08-13",
    "Children_day_2000": "2000-10-12",
    "Valentine_Day_2000": "2000-06-12",
    "Black_Friday_2000": "2000-11-24",
    "Mothers_Day_2001": "2001-05-13",
}
NEW_HOLIDAYS = {
    k: HOLIDAYS[k]
    for k in ("Christmas_Day_2000", "Children_day_2000", "Black_Friday_2000", "Mothers_Day_2001")
}
QUARTER_STARTS = (
    "2000-07-01",
    "2000-10-01",
    "2001-01-01",
    "2001-04-01",
    "2001-07-01",
    "2001-10-01",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Months back from the last one, 2001-08: every sixteen of them are the history and
# the new months of one card, so each customer has five cards and every line is used.
BACK = "((2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate))"


def transactions(spark: SparkSession, sf_dir: str, first_lag: int, last_lag: int) -> DataFrame:
    """Transactions with these month lags, the 14 log columns."""
    orders = _table(spark, sf_dir, "orders").filter(
        F.expr(f"2 - {BACK} % 16 BETWEEN {first_lag} AND {last_lag}")
    )
    lines = _table(spark, sf_dir, "lineitem")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    shops = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    # One table after the other: a join of shops and nation has no known size, and the lines
    # would be shuffled to meet it.
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(shops, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    )
    return joined.selectExpr(
        f"concat('C_', o_custkey, '_', {BACK} DIV 16) AS card_id",
        "CASE WHEN l_suppkey % 20 = 0 THEN NULL ELSE concat('M_', l_suppkey) END AS merchant_id",
        "p_size AS merchant_category_id",
        "p_brand AS subsector_id",
        "s_nationkey AS city_id",
        "n_regionkey AS state_id",
        "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS authorized_flag",
        "CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS category_1",
        "CASE WHEN o_orderpriority LIKE '4%' THEN NULL"
        " ELSE CAST(substr(o_orderpriority, 1, 1) AS double) END AS category_2",
        "CASE WHEN l_returnflag = 'A' THEN 'A' WHEN l_returnflag = 'N' THEN 'B'"
        " WHEN l_returnflag = 'R' AND l_linenumber <> 7 THEN 'C' END AS category_3",
        "CASE WHEN l_quantity = 50 THEN 999 WHEN l_quantity = 1 THEN -1"
        " ELSE l_linenumber - 1 END AS installments",
        "l_extendedprice / 60000.0D - 0.75D AS purchase_amount",
        "o_orderdate + make_dt_interval(0, 0, 0, (l_orderkey * 37 + l_linenumber * 3607) % 86400)"
        " AS purchase_date",
        f"CAST(2 - {BACK} % 16 AS int) AS month_lag",
    )


def hist_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags -13 to 0 of the cards' observation months."""
    return transactions(spark, sf_dir, -13, 0)


def new_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags 1 and 2."""
    return transactions(spark, sf_dir, 1, 2)


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").withColumn(
        "window", F.explode(F.sequence(F.lit(0), F.lit(4)))
    )
    return customers.selectExpr(
        "concat('C_', c_custkey, '_', window) AS card_id",
        "make_date(1998 + CAST(c_custkey % 3 AS int), 1 + CAST(c_custkey % 12 AS int), 1)"
        " AS first_active_month",
        "1 + c_nationkey % 5 AS feature_1",
        "1 + c_nationkey % 3 AS feature_2",
        "CAST(c_custkey % 2 AS int) AS feature_3",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_acctbal < -700 THEN -33.2D"
        " ELSE c_acctbal / 2000.0D - 2.5D END AS target",
    )


def train_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards(spark, sf_dir).filter("target IS NOT NULL")


def test_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards(spark, sf_dir).filter("target IS NULL").drop("target")
