"""Reproducible, stratified, contiguous folds without a single-task sort.

Every global rank is split in two: an order-preserving bucket taken from the
sort value itself, and the position inside the bucket. The bucket counts are a
small table; the positions are windows over buckets, which are even in size
because md5 values, and the spread positions, are uniform. A class holding most
of the rows is spread over all buckets too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.operators.cleaning import round_target, split_train_test

# Buckets per class when shuffling: 16 ** HEX_DIGITS.
HEX_DIGITS = 3
POSITION_BUCKETS = 4_096
CLASS_STEP = 0.000001


def class_counts(df: DataFrame, cls: str = "rounded_target") -> DataFrame:
    return df.groupBy(cls).agg(F.count(F.lit(1)).alias("n"))


def shuffle_key(seed: int, key: str = "card_id") -> Column:
    return F.md5(F.concat(F.col(key), F.lit(f":{seed}")))


def shuffle_in_class(
    df: DataFrame, seed: int, cls: str = "rounded_target", key: str = "card_id"
) -> DataFrame:
    """Adds the class size, class index (1 for the smallest class value), table
    size and a 0-based random rank within the class: ``class_size``,
    ``class_index``, ``total``, ``class_rank``."""
    keyed = df.withColumn("__md5", shuffle_key(seed, key))
    keyed = keyed.withColumn("__bucket", F.substring("__md5", 1, HEX_DIGITS))

    # At most classes x 16**HEX_DIGITS rows from here on.
    sizes = keyed.groupBy(cls, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    in_class = Window.partitionBy(cls)
    classes = (
        sizes.groupBy(cls)
        .agg(F.sum("__n").alias("class_size"))
        .withColumn("class_index", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(cls)))
        .withColumn("total", F.sum("class_size").over(Window.partitionBy(F.lit(0))))
    )
    before = in_class.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        cls,
        "__bucket",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
    ).join(classes, cls)

    # The window and the join use the same partitioning: one shuffle of the rows.
    inside = Window.partitionBy(cls, "__bucket").orderBy("__md5", key)
    ranked = keyed.withColumn("__inside", F.row_number().over(inside))
    return (
        ranked.join(offsets, [cls, "__bucket"])
        .withColumn("class_rank", F.col("__offset") + F.col("__inside") - 1)
        .drop("__md5", "__bucket", "__offset", "__inside")
    )


def stratified_interleave(
    df: DataFrame, seed: int, cls: str = "rounded_target", key: str = "card_id"
) -> DataFrame:
    """Adds ``position``: each class is spread evenly over the whole table."""
    n, v = F.col("total").cast("double"), F.col("class_size").cast("double")
    position = n / (v + 1) + F.col("class_rank") * (n / v) + F.lit(CLASS_STEP) * F.col("class_index")
    return shuffle_in_class(df, seed, cls, key).withColumn("position", position)


def kfold_contiguous(
    df: DataFrame, k: int, position: str = "position", key: str = "card_id"
) -> DataFrame:
    """Adds ``fold_rank`` (0-based order by position) and ``fold``: k contiguous
    slices, the first n mod k of them one row longer. Needs ``total``."""
    share = F.col(position) / F.col("total") * POSITION_BUCKETS
    bucketed = df.withColumn(
        "__bucket", F.least(F.floor(share), F.lit(POSITION_BUCKETS - 1)).cast("int")
    )
    # At most POSITION_BUCKETS rows.
    sizes = bucketed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = (
        Window.partitionBy(F.lit(0))
        .orderBy("__bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy("__bucket").orderBy(position, key)
    ranked = (
        bucketed.withColumn("__inside", F.row_number().over(inside))
        .join(offsets, "__bucket")
        .withColumn("fold_rank", F.col("__offset") + F.col("__inside") - 1)
    )
    return ranked.withColumn("fold", fold_of(F.col("fold_rank"), F.col("total"), k)).drop(
        "__bucket", "__offset", "__inside"
    )


def fold_of(rank: Column, n: Column, k: int) -> Column:
    short = F.floor(n / k)
    longer = n - short * k
    in_long = longer * (short + 1)
    return (
        F.when(rank < in_long, F.floor(rank / (short + 1)))
        .otherwise(longer + F.floor(F.try_divide(rank - in_long, short)))
        .cast("int")
    )


def stratified_folds(train: DataFrame, k: int, seed: int, key: str = "card_id") -> DataFrame:
    """Train cards with their fold; the helper columns are dropped."""
    columns = list(train.columns)
    df = stratified_interleave(round_target(train), seed, key=key)
    return kfold_contiguous(df, k, key=key).select(*[F.col(f"`{c}`") for c in columns], "fold")


def card_folds(cards: DataFrame, k: int, seed: int) -> DataFrame:
    """card_id, target, fold for all cards; test cards get fold -1."""
    train, test = split_train_test(cards.select("card_id", "target"))
    return stratified_folds(train, k, seed).unionByName(
        test.withColumn("fold", F.lit(-1))
    )
