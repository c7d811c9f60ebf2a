"""Features of the card table itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.lookup import lookup
from cardloom.functions.stats import floor_days, ntz, safe_ratio
from cardloom.operators.calendar import quarter
from cardloom.operators.cleaning import flag_outliers

FEATURES = ("feature_1", "feature_2", "feature_3")


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Append by column name; what one side lacks is NULL."""
    return train.unionByName(test, allowMissingColumns=True)


def elapsed_days(df: DataFrame, as_of: str, column: str = "first_active_month") -> DataFrame:
    return df.withColumn("elapsed_time", floor_days(ntz(as_of), column))


def elapsed_interactions(df: DataFrame) -> DataFrame:
    new = {}
    for i, f in enumerate(FEATURES, start=1):
        new[f"days_feature{i}"] = F.col("elapsed_time") * F.col(f)
        new[f"days_feature{i}_ratio"] = safe_ratio(f, "elapsed_time")
    return df.withColumns(new)


def outlier_rate_encode(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Replace each feature value by the outlier rate of the train cards with it."""
    columns = list(df.columns)
    for f in features:
        rates = df.filter(F.col(f).isNotNull()).groupBy(f).agg(F.avg("outliers").alias("__rate"))
        df = (
            lookup(df, rates, [f])
            .withColumn(f, F.col("__rate"))
            .select(*columns)
        )
    return df


def rowwise_stats(df: DataFrame) -> DataFrame:
    """Sum, mean, extremes and sample deviation across the three features. The
    column called feature_var holds the standard deviation."""
    a, b, c = (F.col(f).cast("double") for f in FEATURES)
    zero = F.lit(0.0)
    n = sum((x.isNotNull().cast("int") for x in (a, b, c)), F.lit(0))
    mean = F.try_divide(sum((F.coalesce(x, zero) for x in (a, b, c)), zero), n)
    squares = sum((F.coalesce(F.pow(x - mean, F.lit(2)), zero) for x in (a, b, c)), zero)
    return df.withColumns(
        {
            "feature_sum": a + b + c,
            "feature_mean": (a + b + c) / 3,
            "feature_max": F.greatest(a, b, c),
            "feature_min": F.least(a, b, c),
            "feature_var": F.when(n > 1, F.sqrt(squares / (n - 1))),
        }
    )


def one_hot(
    df: DataFrame,
    columns: Sequence[str],
    max_values: int,
    null_as_category: bool = True,
) -> DataFrame:
    """One 0/1 column per value of each column, in value order, and one for NULL
    when asked. The values become columns, so the caller says how many a column
    may have; more are an error."""
    for c in columns:
        found = (
            df.filter(F.col(c).isNotNull()).select(c).distinct().limit(max_values + 1).collect()
        )
        if len(found) > max_values:
            raise ValueError(f"{c} has more than {max_values} values; encode it by lookup instead")
        hot = {f"{c}_{v}": F.col(c).eqNullSafe(F.lit(v)).cast("int") for v in sorted(r[0] for r in found)}
        if null_as_category:
            hot[f"{c}_nan"] = F.col(c).isNull().cast("int")
        df = df.withColumns(hot).drop(c)
    return df


def card_table(train: DataFrame, test: DataFrame, as_of: str) -> DataFrame:
    """Train and test cards with all card-level features."""
    df = union_train_test(flag_outliers(train), test.withColumn("target", F.lit(None).cast("double")))
    df = quarter(df)
    df = elapsed_interactions(elapsed_days(df, as_of))
    return rowwise_stats(outlier_rate_encode(df))
