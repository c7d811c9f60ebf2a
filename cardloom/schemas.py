"""Input schemas. Every reader passes one of these, so nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

CARDS = T.StructType(
    [
        T.StructField("card_id", T.StringType()),
        T.StructField("first_active_month", T.StringType()),
        T.StructField("feature_1", T.IntegerType()),
        T.StructField("feature_2", T.IntegerType()),
        T.StructField("feature_3", T.IntegerType()),
        T.StructField("target", T.DoubleType()),
    ]
)

# Test cards carry no target column in their file.
TEST_CARDS = T.StructType(CARDS.fields[:-1])

TRANSACTIONS = T.StructType(
    [
        T.StructField("authorized_flag", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("city_id", T.IntegerType()),
        T.StructField("category_1", T.StringType()),
        T.StructField("installments", T.IntegerType()),
        T.StructField("category_3", T.StringType()),
        T.StructField("merchant_category_id", T.IntegerType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("month_lag", T.IntegerType()),
        T.StructField("purchase_amount", T.DoubleType()),
        T.StructField("purchase_date", T.TimestampNTZType()),
        T.StructField("category_2", T.DoubleType()),
        T.StructField("state_id", T.IntegerType()),
        T.StructField("subsector_id", T.IntegerType()),
    ]
)

# Months after the observation month are "new", the others historical.
LAGS = list(range(2, -14, -1))
