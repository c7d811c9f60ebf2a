"""Aggregates over rows that were brought together by key while narrow."""

import pytest
from pyspark.sql import functions as F

from cardloom.functions.lookup import crowded, together
from cardloom.operators import cuts, encode, merchants, profiles

AS_OF = "2001-09-01"


def shuffled_by_card(df):
    """The shuffles that aggregates and joins by card ask for themselves."""
    return sum("Exchange hashpartitioning(card_id" in x and "ENSURE_REQUIREMENTS" in x for x in plan(df).split("\n"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def log(spark, hot):
    """200 cards, one with ``hot`` rows, and rows without a card."""
    df = spark.range(2000 + hot).select(
        F.when(F.col("id") < hot, "C_hot").when(F.col("id") % 97 == 0, None)
        .otherwise(F.concat(F.lit("C_"), (F.col("id") % 199).cast("string"))).alias("card_id"),
        F.concat(F.lit("M_"), (F.col("id") % 13).cast("string")).alias("merchant_id"),
        (F.col("id") % 7).cast("int").alias("merchant_category_id"),
        F.concat(F.lit("S"), (F.col("id") % 5).cast("string")).alias("subsector_id"),
        F.when(F.col("id") % 3 == 0, "Y").otherwise("N").alias("authorized_flag"),
        F.when(F.col("id") % 4 == 0, "Y").otherwise("N").alias("category_1"),
        (F.col("id") % 5).cast("double").alias("category_2"),
        F.element_at(F.array(*map(F.lit, "ABC")), (F.col("id") % 3 + 1).cast("int")).alias("category_3"),
        (F.col("id") % 6).cast("int").alias("installments"),
        ((F.col("id") * 37 % 101) / 10.0 - 0.7).alias("purchase_amount"),
        F.expr("timestamp_ntz'2001-01-01 00:00:00' + make_dt_interval(cast(id % 200 AS int), cast(id % 24 AS int))").alias("purchase_date"),
        (-(F.col("id") % 14)).cast("int").alias("month_lag"),
        (F.col("id") % 3).alias("city_id"),
        (F.col("id") % 2).alias("state_id"),
    )
    return df


@pytest.mark.parametrize("hot", [0, 3000])
def test_hot_keys_are_found_by_their_buckets(spark, hot):
    found = crowded(log(spark, hot), "card_id", parts=20)
    assert ([r[0] for r in found.collect()] if found else []) == (["C_hot"] if hot else [])


def close(a, b):
    assert a.columns == b.columns
    left, right = ({r["card_id"]: r for r in x.collect()} for x in (a, b))
    assert set(left) == set(right) and None not in left
    for card, row in left.items():
        for c in a.columns:
            want = right[card][c]
            assert row[c] == (pytest.approx(want, rel=1e-8, abs=1e-8) if isinstance(want, float) else want), (card, c)


@pytest.mark.parametrize("hot", [0, 3000])
def test_card_profile_equals_one_without_placing(spark, hot):
    rows = log(spark, hot)
    df = profiles.enrich(rows, AS_OF, {"h": "2001-05-13"})
    want = profiles.purchase_span(profiles.agg_spec(df, "card_id", profiles.hist_spec(("h",)), "hist_"), AS_OF, "hist_")
    got = profiles.hist_card_profile(rows, AS_OF, {"h": "2001-05-13"})
    close(got, want)


def test_buffers_of_cold_keys_are_not_shuffled(spark):
    got = profiles.hist_card_profile(log(spark, 0), AS_OF, {"h": "2001-05-13"})
    # Rows once for the plain aggregate and once for each of three distinct counts.
    assert plan(got).count("REPARTITION_BY_COL") == 4 and shuffled_by_card(got) == 0


def test_cut_profile_results_are_not_shuffled(spark):
    spec = {"merchant_id": ("nunique",), "purchase_amount": ("sum", "var")}
    made = [cuts.Cut(f"p{k}_", k, None, spec) for k in (0, -6)]
    rows = log(spark, 0).repartition("card_id")
    text = plan(cuts.cut_profiles(rows, "card_id", made, placed=True))
    assert "ENSURE_REQUIREMENTS, " not in text
    close(cuts.cut_profiles(rows, "card_id", made, placed=True), cuts.cut_profiles(log(spark, 3000).limit(0).unionByName(log(spark, 0)), "card_id", made))


@pytest.mark.parametrize("hot", [0, 3000])
def test_encoded_blocks_share_one_shuffle(spark, hot):
    rows = log(spark, hot).withColumn("purchase_date", F.col("purchase_date"))
    cards = rows.where("card_id IS NOT NULL").select("card_id").distinct().withColumn(
        "target", F.when(F.crc32("card_id") % 5 != 0, F.crc32("card_id") % 11 / 3.0)
    )
    got = encode.oof_target_encode(rows, cards, "p_", ["city_id", "category_2", "merchant_id"], k=3)
    assert got.count() == cards.count()
    assert plan(got).count("ENSURE_REQUIREMENTS, ") <= 2 + 4 * bool(hot)
    ratio = encode.ratio_name("city_id", "category_2")
    sums = {r[0]: r[1] for r in got.select("card_id", f"p_{ratio}_max").collect()}
    assert any(v is not None for v in sums.values())


@pytest.mark.parametrize("hot", [0, 3000])
def test_merchants_are_made_once(spark, hot):
    rows = log(spark, hot)
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    shops = rows.groupBy("merchant_id").agg(F.sum("purchase_amount").alias("x"))
    shops = shops.mapInArrow(seen, shops.schema)
    got = merchants.card_merchant_profile(rows, shops, "n_")
    assert got.count() == (201 if hot else 200) - 1
    assert made.value == 13


def by_sql(spark, rows, cards, columns, prefix):
    """Each card with the statistics of its rows, as plain aggregates and a join."""
    stats = [F.expr(sql.replace("{c}", c) + f" AS {prefix}{c}_{s}") for c in columns for s, sql in encode._ENCODED_SQL.items()]
    return cards.join(rows.groupBy("card_id").agg(*stats), "card_id", "left")


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_placed_encodings_equal_plain_aggregates(spark, batch):
    """Cards that go on over batches, come twice, have no rows, no values or no id."""
    nan = float("nan")
    values = [(f"c{i % 9}", None if i % 4 == 0 else (i * 37 % 11) / 3, 1e8 + i % 3, None if i % 9 != 3 else 2.5) for i in range(120)]
    values += [("one", 0.1, None, None), ("nan", nan, nan, 1.0), ("nan", 1.0, nan, nan), ("flat", 0.1, 0.1, 0.1), ("flat", 0.1, 0.1, 0.1)]
    rows = spark.createDataFrame(values, "card_id string, a double, b double, c double")
    ids = [*{v[0] for v in values}, "c1", "c1", "none", "none", None, None]
    cards = spark.createDataFrame([(x,) for x in ids], "card_id string")
    want = by_sql(spark, rows, cards, "abc", "p_")
    counted = cards.groupBy("card_id").agg(F.count(F.lit(1)).alias("__copies"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        joined = encode.join_encoding_left(counted, rows.repartition("card_id").withColumn("__in", F.lit(1)))
        got = encode.placed_encoding_profile(joined, "abc", "p_")
        assert got.columns == want.columns
        show = lambda t: sorted(str([f"{v:.9g}" if isinstance(v, float) else v for v in r]) for r in t.collect())
        assert show(got) == show(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_wide_results_of_encodings_are_not_aggregated_or_shuffled(spark):
    rows = log(spark, 0)
    cards = rows.where("card_id IS NOT NULL").select("card_id").distinct().withColumn("target", F.crc32("card_id") % 11 / 3.0)
    text = plan(encode.oof_target_encode(rows, cards, "p_", ["city_id", "category_2"], k=3))
    assert "var_samp" not in text and text.count("MapInArrow") == 1
    assert "Exchange" not in text[: text.index("MapInArrow")]


@pytest.mark.parametrize("batch", [1, 5, 10_000])
def test_placed_cuts_equal_those_merged_from_states(spark, batch):
    spec = {
        "merchant_id": ("nunique",), "purchase_amount": profiles.SIX, "installments": ("small_nunique", "mean", "count"),
        "purchase_date": ("min", "max"), "category_1": ("count", "size"), "gap": profiles.SIX,
    }
    made = [cuts.Cut("a_", -6, None, spec), cuts.Cut("b_", -9, -4, spec), cuts.Cut("c_", -1, 100, {"gap": ("sum", "var")})]
    rows = log(spark, 40).withColumn("gap", F.when(F.crc32("merchant_id") % 3 == 0, F.col("purchase_amount")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = cuts.cut_profiles(rows.repartition("card_id"), "card_id", made, placed=True)
        assert "HashAggregate" in plan(got) and "skewness" not in plan(got)
        close(got, cuts.cut_profiles(rows, "card_id", made))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
