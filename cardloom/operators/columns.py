"""Operators on the columns of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Smallest type first; a value must lie strictly inside the bounds.
INT_TYPES = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31), ("bigint", 2**63))
FLOAT_MAX = 3.4028234663852886e38

# Columns that are never model inputs.
NOT_FEATURES = (
    "first_active_month",
    "target",
    "card_id",
    "outliers",
    "hist_purchase_date_max",
    "hist_purchase_date_min",
    "hist_card_id_size",
    "new_purchase_date_max",
    "new_purchase_date_min",
    "new_card_id_size",
)


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ("card_id",)) -> DataFrame:
    return df.selectExpr(*[f"`{c}`" if c in keep else f"`{c}` AS `{prefix}{c}`" for c in df.columns])


def select_features(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> DataFrame:
    return df.select(*[f"`{c}`" for c in feature_names(df, exclude)])


def feature_names(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    """Numeric columns outside the exclude list."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and isinstance(f.dataType, T.NumericType)
    ]


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def sort_by_key(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the smallest type that holds its range. One
    pass finds all ranges. Meant for tables about to be stored."""
    ints = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    floats = (T.FloatType, T.DoubleType)
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, ints + floats)]
    if not numeric:
        return df
    bounds = df.agg(
        *[F.min(f"`{f.name}`").alias(f"lo{i}") for i, f in enumerate(numeric)],
        *[F.max(f"`{f.name}`").alias(f"hi{i}") for i, f in enumerate(numeric)],
    ).first()
    targets = {}
    for i, f in enumerate(numeric):
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if lo is None:
            continue
        if isinstance(f.dataType, ints):
            fitting = [t for t, edge in INT_TYPES if lo > -edge and hi < edge - 1]
            if fitting:
                targets[f.name] = fitting[0]
        elif lo > -FLOAT_MAX and hi < FLOAT_MAX:
            targets[f.name] = "float"
    return df.select(
        *[
            F.col(f"`{c}`").cast(targets[c]).alias(c) if c in targets else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
