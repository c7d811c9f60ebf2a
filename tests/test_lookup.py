import pytest
from pyspark.sql import functions as F

from cardloom.functions import lookup as lk


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a tenth null, the rest spread out."""
    return spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 4001))
        .alias("key"),
    )


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(3000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"),
        (F.col("id") * 2).alias("v"),
    )


def rows(df):
    return sorted(df.select("id", "key", "v").collect())


def test_every_way_gives_the_plain_left_join(skewed, table):
    want = rows(skewed.join(table, "key", "left"))
    assert rows(lk.lookup(skewed, table, ["key"])) == want
    assert rows(lk.lookup(skewed, table, ["key"], max_rows=100)) == want
    assert rows(lk.hot_split_lookup(skewed, table, ["key"], parts=5)) == want


def test_two_keys(skewed, table):
    left = skewed.withColumn("fold", (F.col("id") % 3).cast("int"))
    right = table.withColumn("fold", F.explode(F.array(F.lit(0), F.lit(2))))
    want = rows(left.join(right, ["key", "fold"], "left"))
    assert rows(lk.hot_split_lookup(left, right, ["key", "fold"], parts=7)) == want


def test_pulled_is_bounded(spark):
    assert lk.pulled(spark.range(11), 10) is None
    assert lk.pulled(spark.range(10), 10).count() == 10


def test_clustered_keeps_rows_and_spreads_the_hot_key(skewed):
    spark = skewed.sparkSession
    out = lk.clustered(skewed, "key", parts=5)
    assert sorted(out.collect(), key=str) == sorted(skewed.collect(), key=str)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = lk.clustered(skewed, "key", parts=5).withColumn("p", F.spark_partition_id())
        per_part = {r["p"]: r["count"] for r in spread.filter("key = 'hot'").groupBy("p").count().collect()}
        assert len(per_part) == 4 and max(per_part.values()) < 10_000 / 2
        # Any other key stays in one partition.
        others = spread.filter("key <> 'hot'").groupBy("key").agg(F.count_distinct("p").alias("n"))
        assert others.agg(F.max("n")).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_keys_are_chosen_by_their_share(spark, skewed):
    assert [r.key for r in lk.hot(skewed, ["key"], 5).collect()] == ["hot"]
    # Many equally heavy keys are all hot, none is left out by a fixed number.
    even = spark.range(45_000).select((F.col("id") % 1500).alias("key"))
    assert lk.hot(even, ["key"], 1501).count() == 1500
    assert lk.hot(even, ["key"], 1499).count() == 0
    assert lk.hot(even.limit(0), ["key"], 10).count() == 0


def test_bytes_are_bounded_too(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("v"))
    assert lk.pulled(wide, 100, 5_000) is None
