"""One query per operator, each over the whole sample tables.

`present` gives every result the same plain types on both engines: integers as
bigint, rounded doubles, dates and timestamps as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.functions import lookup as lk
from cardloom.models import blend as bl
from cardloom.models import boosting, extra_trees, gram, network, oof, ordered, scaling, selection
from cardloom.operators import (
    amounts,
    assemble,
    calendar,
    cards,
    cleaning,
    columns,
    cuts,
    encode,
    folds,
    lags,
    merchants,
    profiles,
)
from cardloom.plans.scoring import AMOUNT_RANGES, LAG_FROM
from cardloom.sources import readers, staging
from cardloom.sources import tpch_cards as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROW = ("card_id", "purchase_date")
RIDGE_FEATURES = ["hist_rows", "feature_2"]
GRAM_FEATURES = ["hist_rows", "feature_2", "hist_amount"]
GRAM_ALPHAS = (0.1, 1.0, 1000.0)


# Sums differ in their last bits with the order of addition, so doubles are
# rounded, large ones more coarsely. The sample amounts are multiples of 1/6e6,
# which often fall on a half; the small shift moves them off it.
ROUNDED = (
    "CASE WHEN abs({c}) < 100 THEN round({c} + 3.14159e-8D, 6)"
    " WHEN abs({c}) < 1e6 THEN round({c} + 3.14159e-8D, 3)"
    " ELSE round({c} + 3.14159e-5D, 0) END"
)


def present(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = f"cast({c} AS bigint)"
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = ROUNDED.replace("{c}", f"cast({c} AS double)")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = f"cast({c} AS string)"
        out.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*out)


def floating(df: DataFrame) -> DataFrame:
    """All numbers as double: for wide profiles that mix counts and means."""
    return df.selectExpr(
        *[
            f"cast(`{f.name}` AS double) AS `{f.name}`"
            if isinstance(f.dataType, T.NumericType)
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


class Sample:
    """The sample tables of one query run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._kept: dict[tuple, DataFrame] = {}

    def kept(self, df: DataFrame, *name: object) -> DataFrame:
        """``df`` written once for all steps of the query that read it."""
        if name not in self._kept:
            self._kept[name] = staging.staged(df, "-".join(map(str, name)))
        return self._kept[name]

    @property
    def hist(self) -> DataFrame:
        return X.hist_log(self.spark, self.dir)

    @property
    def new(self) -> DataFrame:
        return X.new_log(self.spark, self.dir)

    @property
    def cards(self) -> DataFrame:
        return X.cards(self.spark, self.dir)

    @property
    def train(self) -> DataFrame:
        return X.train_cards(self.spark, self.dir)

    @property
    def test(self) -> DataFrame:
        return X.test_cards(self.spark, self.dir)

    @property
    def card_table(self) -> DataFrame:
        return cards.card_table(self.train, self.test, X.AS_OF)

    @property
    def kept_hist(self) -> DataFrame:
        """For profiles, which read the log more than once."""
        return self.kept(self.hist.select(*profiles.LOG_COLUMNS), "hist-log")

    @property
    def kept_new(self) -> DataFrame:
        return self.kept(self.new.select(*profiles.LOG_COLUMNS), "new-log")

    @property
    def hist_profile(self) -> DataFrame:
        return profiles.hist_card_profile(self.kept_hist, X.AS_OF, X.HOLIDAYS)

    @property
    def new_profile(self) -> DataFrame:
        return profiles.new_card_profile(self.kept_new, X.AS_OF, X.NEW_HOLIDAYS)

    @property
    def hist_merchants(self) -> DataFrame:
        return merchants.hist_merchant_profile(self.kept_hist, X.AS_OF, X.HOLIDAYS)

    @property
    def new_merchants(self) -> DataFrame:
        return merchants.new_merchant_profile(self.kept_new, X.AS_OF, X.HOLIDAYS)

    @property
    def all_merchants(self) -> DataFrame:
        return merchants.merchant_combined(self.new_merchants, self.hist_merchants)

    @property
    def lag_matrix(self) -> DataFrame:
        return lags.lag_pivot(lags.combine_lag_tables(self.hist, self.new))

    @property
    def lag_totals(self) -> DataFrame:
        return lags.running_total_by_lag(self.lag_matrix)

    @property
    def combined(self) -> DataFrame:
        return assemble.assemble_features(self.card_table, [self.hist_profile, self.new_profile])

    @property
    def model_table(self) -> DataFrame:
        """Cards with a few complete features, for the regressors."""
        counts = self.hist.groupBy("card_id").agg(
            F.count(F.lit(1)).alias("hist_rows"), F.sum("purchase_amount").alias("hist_amount")
        )
        return self.cards.join(counts, "card_id", "left").fillna(
            0, ["hist_rows", "hist_amount"]
        )

    def folded(self, seed: int, k: int = 6, columns: tuple[str, ...] = ()) -> DataFrame:
        f = folds.card_folds(self.cards, k, seed).select("card_id", "fold")
        rows = self.model_table.join(f, "card_id")
        return self.kept(rows.select(*columns) if columns else rows, "folded", seed, k, *columns)

    def guess(self) -> DataFrame:
        """A plain prediction per train card, with folds."""
        return (
            self.folded(120)
            .filter("target IS NOT NULL")
            .withColumn("pred", F.col("feature_1") * 0.25 - F.col("feature_2") * 0.5)
        )


def query(name: str):
    def register(fn: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: present(fn(Sample(spark, sf_dir)))
        return fn

    return register


# Scans, sinks, schema


def _csv(df: DataFrame, name: str) -> str:
    path = staging.stage_path(df.sparkSession, name)
    df.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path, header=True)
    return path


@query("read_cards")
def _(s):
    month = F.date_format("first_active_month", "yyyy-MM")
    path = _csv(s.cards.withColumn("first_active_month", month), "cards-csv")
    return readers.read_cards(s.spark, path)


@query("read_transactions")
def _(s):
    log = s.hist.withColumn("subsector_id", F.substring("subsector_id", 7, 9).cast("int"))
    path = _csv(log.select(*readers.schemas.TRANSACTIONS.names), "log-csv")
    return readers.read_transactions(s.spark, path)


@query("read_limited")
def _(s):
    return readers.read_limited(s.hist, 100).agg(F.count(F.lit(1)).alias("n"))


@query("read_columns_for_ids")
def _(s):
    return readers.read_columns_for_ids(s.test)


@query("checkpoint_write_read")
def _(s):
    return staging.staged(s.cards, "cards")


@query("checkpoint_resumed")
def _(s):
    """One stage asked for five times: how often it was made by then, and its rows."""
    path, made, out = staging.stage_path(s.spark, "resumed"), [], []

    def run(case: str, table: DataFrame, as_of: str) -> None:
        def make() -> DataFrame:
            made.append(case)
            return cards.elapsed_days(table, as_of)

        stage = staging.resumed(s.spark, make, path, "elapsed", {"as_of": as_of}, [table])
        kept = stage.agg(F.count(F.lit(1)).alias("rows"), F.sum("elapsed_time").alias("days"))
        # The next case overwrites the stage, so its sums are taken now.
        out.append((case, len(made), *kept.first()))

    run("1 first", s.cards, X.AS_OF)
    run("2 equal", s.cards, X.AS_OF)
    run("3 other day", s.cards, "2001-10-01")
    run("4 other cards", s.train, "2001-10-01")
    run("5 equal", s.train, "2001-10-01")
    return s.spark.createDataFrame(out, "step string, made long, n_rows long, days long")


@query("read_mixed_headers")
def _(s):
    """A folder of CSV files of two column orders, each read by its own header."""
    card = s.cards.withColumn("first_active_month", F.date_format("first_active_month", "yyyy-MM"))
    path = staging.stage_path(s.spark, "mixed-csv")
    odd = F.pmod(F.crc32("card_id"), F.lit(2)) == 1
    card.where(odd).write.csv(path, header=True)
    card.where(~odd).select(*reversed(card.columns)).write.mode("append").csv(path, header=True)
    return readers.read_cards(s.spark, path, mixed=True)


@query("merchant_store")
def _(s):
    path = staging.stage_path(s.spark, "merchants")
    readers.merchant_store(s.hist_merchants, path)
    return floating(readers.read_merchants(s.spark, path))


@query("write_scores_csv")
def _(s):
    path = readers.write_scores_csv(s.train, staging.stage_path(s.spark, "scores"))
    return s.spark.read.schema("card_id string, target double").csv(path, header=True)


@query("narrow_types")
def _(s):
    return columns.narrow_types(s.model_table.drop("first_active_month"))


@query("prefix_columns")
def _(s):
    return columns.prefix_columns(s.cards, "kkk")


@query("select_features")
def _(s):
    return columns.select_features(cleaning.flag_outliers(s.cards))


# Rows


@query("flag_outliers")
def _(s):
    return cleaning.flag_outliers(s.cards).select("card_id", "target", "outliers")


@query("split_train_test")
def _(s):
    train, test = cleaning.split_train_test(s.cards.select("card_id", "target"))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query("fill_defaults")
def _(s):
    return cleaning.fill_defaults(s.hist).select(*ROW, "category_2", "category_3", "merchant_id")


@query("sentinel_to_null")
def _(s):
    return cleaning.sentinel_to_null(s.hist).select(*ROW, "installments")


@query("clip_upper")
def _(s):
    return cleaning.clip_upper(s.hist).select(*ROW, "purchase_amount")


@query("yn_to_int")
def _(s):
    return cleaning.yn_to_int(s.hist).select(*ROW, "authorized_flag", "category_1")


@query("recode_category3")
def _(s):
    plain = cleaning.recode_category3(s.hist).select(*ROW, "category_3")
    filled = cleaning.fill_defaults(s.new, "D")
    coded = cleaning.recode_category3(filled, cleaning.CATEGORY_3_CODES_WITH_UNKNOWN)
    return plain.unionByName(coded.select(*ROW, "category_3"))


@query("restore_amount")
def _(s):
    return cleaning.restore_amount(s.hist).select(*ROW, "purchase_amount")


@query("parse_dates")
def _(s):
    text = s.cards.select("card_id", F.col("first_active_month").cast("string").alias("day"))
    text = text.withColumn("month", F.substring("day", 1, 7))
    return calendar.parse_dates(calendar.parse_dates(text, "day", "date"), "month")


@query("round_target")
def _(s):
    return cleaning.round_target(s.train).select("card_id", "rounded_target")


@query("calendar_parts")
def _(s):
    return calendar.calendar_parts(s.hist).select(
        *ROW, "month", "day", "hour", "weekofyear", "weekday"
    )


@query("weekend_flag")
def _(s):
    return calendar.weekend_flag(s.hist).select(*ROW, "weekend")


@query("quarter")
def _(s):
    return calendar.quarter(s.cards).select("card_id", "quarter")


@query("elapsed_days")
def _(s):
    return cards.elapsed_days(s.cards, X.AS_OF).select("card_id", "elapsed_time")


@query("elapsed_interactions")
def _(s):
    df = cards.elapsed_interactions(cards.elapsed_days(s.cards, X.AS_OF))
    return df.select(
        "card_id",
        *[f"days_feature{i}" for i in (1, 2, 3)],
        *[f"days_feature{i}_ratio" for i in (1, 2, 3)],
    )


@query("rowwise_stats")
def _(s):
    return cards.rowwise_stats(s.cards).select(
        "card_id", "feature_sum", "feature_mean", "feature_max", "feature_min", "feature_var"
    )


@query("one_hot")
def _(s):
    return cards.one_hot(s.hist.select(*ROW, "category_3", "category_1"), ["category_3", "category_1"], max_values=100)


@query("price_ratio")
def _(s):
    df = cleaning.sentinel_to_null(s.hist)
    return amounts.price_ratio(df).select(*ROW, "price")


@query("price_ratio_plus1")
def _(s):
    df = cleaning.sentinel_to_null(s.hist)
    return amounts.price_ratio_plus1(df).select(*ROW, "price")


@query("holiday_proximity")
def _(s):
    return calendar.holiday_proximity(s.hist, X.HOLIDAYS).select(*ROW, *X.HOLIDAYS)


@query("month_diff")
def _(s):
    return calendar.month_diff(s.hist, X.AS_OF).select(*ROW, "month_diff")


@query("month_diff_nolag")
def _(s):
    return calendar.month_diff_nolag(s.hist, X.AS_OF).select(*ROW, "nomonth_diff")


@query("duration")
def _(s):
    return amounts.duration(calendar.month_diff(s.hist, X.AS_OF)).select(*ROW, "duration")


@query("amount_month_ratio")
def _(s):
    df = amounts.amount_month_ratio(calendar.month_diff(s.hist, X.AS_OF))
    return df.select(*ROW, "amount_month_ratio")


@query("duration_no")
def _(s):
    return amounts.duration_no(calendar.month_diff_nolag(s.hist, X.AS_OF)).select(*ROW, "duration_no")


@query("amount_month_ratio_no")
def _(s):
    df = amounts.amount_month_ratio_no(calendar.month_diff_nolag(s.hist, X.AS_OF))
    return df.select(*ROW, "amount_month_ratio_no")


@query("amount_interactions")
def _(s):
    df = calendar.weekend_flag(cleaning.clean(s.hist, "restore", unknown_category=True))
    names = ("authorized_flag", "category_3", "category_1", "category_2", "weekend")
    return amounts.amount_interactions(df).select(*ROW, *[n + "_amount" for n in names])


@query("monthlag_amount")
def _(s):
    return amounts.monthlag_amount(s.new).select(*ROW, "monthlag_amount")


@query("quarter_window_flags")
def _(s):
    df = amounts.price_ratio_plus1(cleaning.clean(s.hist))
    names = [calendar.window_name(q) for q in X.QUARTER_STARTS]
    return calendar.quarter_window_flags(df, X.QUARTER_STARTS).select(
        *ROW, *names, *[n + "price" for n in names]
    )


@query("filter_lag_from")
def _(s):
    return cleaning.filter_lag_from(s.hist, -2).select(*ROW, "month_lag")


@query("filter_lag_range")
def _(s):
    return cleaning.filter_lag_range(s.hist, -7, -3).select(*ROW, "month_lag")


@query("first_last_buy")
def _(s):
    return assemble.first_last_buy(s.combined).select(
        "card_id", "hist_first_buy", "hist_last_buy", "new_first_buy", "new_last_buy"
    )


@query("to_epoch_seconds")
def _(s):
    return assemble.to_epoch_seconds(s.combined).select("card_id", *assemble.DATE_COLUMNS)


@query("hist_new_combine")
def _(s):
    df = s.combined
    out = assemble.hist_new_combine(df)
    return floating(out.select("card_id", *[c for c in out.columns if c not in df.columns]))


def _unbounded_prices(s: Sample) -> DataFrame:
    df = amounts.price_ratio(cleaning.sentinel_to_null(s.hist), on_zero="inf")
    prices = df.groupBy("card_id").agg(
        F.max("price").alias("price_max"), F.min("price").alias("price_min")
    )
    return s.cards.select("card_id", "target").join(prices, "card_id", "left")


@query("replace_infinite")
def _(s):
    return scaling.replace_infinite(_unbounded_prices(s), ["price_max", "price_min"])


@query("impute_train_mean")
def _(s):
    df = scaling.replace_infinite(_unbounded_prices(s), ["price_max", "price_min"])
    return scaling.impute_train_mean(df, ["price_max", "price_min"])


@query("fill_zero")
def _(s):
    counts = s.new.groupBy("card_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("purchase_amount").alias("amount")
    )
    return cleaning.fill_zero(s.cards.select("card_id").join(counts, "card_id", "left"))


@query("nan_pred_to_zero")
def _(s):
    pred = F.when(F.col("feature_1") == 1, F.lit(float("nan"))).when(
        F.col("feature_2") > 1, F.col("target")
    )
    return cleaning.nan_pred_to_zero(s.cards.withColumn("pred", pred)).select("card_id", "pred")


# Joins


@query("assemble_features")
def _(s):
    return floating(s.combined.drop("first_active_month"))


@query("assemble_features_outer")
def _(s):
    a = s.hist.groupBy("card_id").agg(F.count(F.lit(1)).alias("hist_n"))
    b = s.new.groupBy("card_id").agg(F.count(F.lit(1)).alias("new_n"))
    return assemble.assemble_features(s.test.select("card_id", "feature_1"), [a, b], "outer")


@query("label_transactions")
def _(s):
    labelled = encode.label_transactions(s.hist, folds.card_folds(s.cards, 7, 10))
    return labelled.select(*ROW, "target", "fold")


def _merchant_rates(log: DataFrame) -> DataFrame:
    return (
        log.filter("merchant_id IS NOT NULL AND month_lag < -9")
        .groupBy("merchant_id")
        .agg(F.avg("purchase_amount").alias("rate"))
    )


@query("lookup_encode")
def _(s):
    rows = s.kept(s.new.select(*ROW, "merchant_id"), "new-rows")
    out = encode.lookup_encode(rows, _merchant_rates(s.hist), "merchant_id", "rate", "enc")
    return out.select(*ROW, "merchant_id", "enc")


@query("lookup_encode_hot_split")
def _(s):
    log = s.kept(s.hist.select(*ROW, "merchant_id", "month_lag", "purchase_amount"), "hist-rows")
    return lk.hot_split_lookup(log.select(*ROW, "merchant_id"), _merchant_rates(log), ["merchant_id"], parts=200)


@query("join_encoding_left")
def _(s):
    means = s.hist.groupBy("card_id").agg(F.avg("purchase_amount").alias("amount_mean"))
    return encode.join_encoding_left(s.test.select("card_id"), means)


@query("join_observation_date")
def _(s):
    dates = encode.last_observation_date(s.hist)
    return encode.join_observation_date(s.cards.select("card_id", "target"), dates, "full")


@query("combine_lag_tables")
def _(s):
    return lags.combine_lag_tables(s.hist, s.new)


@query("merchant_full_join")
def _(s):
    new = s.new_merchants.select("merchant_id", "new_price_sum", "new_merchant_id_size")
    hist = s.hist_merchants.select("merchant_id", "hist_price_sum", "hist_merchant_id_size")
    return merchants.merchant_full_join(new, hist)


@query("merchant_lookup")
def _(s):
    rows = s.kept_new.select(*ROW, "merchant_id")
    return floating(merchants.merchant_lookup(rows, s.all_merchants))


def _stacks(s: Sample) -> list[DataFrame]:
    """Three stacks of plain predictions; the third covers train cards only."""
    a = s.model_table.select(
        "card_id",
        "target",
        (F.col("feature_1") * 0.25).alias("m1"),
        (F.col("hist_amount") * 0.5).alias("m2"),
    )
    b = s.model_table.select("card_id", "target", (F.col("feature_2") - 2.0).alias("m1"))
    c = b.filter("target IS NOT NULL").select(
        "card_id", "target", (F.col("m1") * F.col("target")).alias("m1")
    )
    return [a, b, c]


@query("stack_join")
def _(s):
    return bl.stack_join(_stacks(s))


@query("align_test_predictions")
def _(s):
    return bl.align_test_predictions(s.test, bl.stack_join(_stacks(s)))


# Aggregates


@query("agg_spec")
def _(s):
    spec = {
        "purchase_amount": profiles.SIX,
        "installments": ("sum", "count", "nunique"),
        "merchant_id": ("nunique", "size"),
    }
    return floating(profiles.agg_spec(s.hist, "state_id", spec, "p_"))


@query("hist_card_profile")
def _(s):
    return floating(s.hist_profile)


@query("new_card_profile")
def _(s):
    return floating(s.new_profile)


@query("purchase_span")
def _(s):
    df = profiles.agg_spec(
        s.new, "card_id", {"purchase_date": ("max", "min"), "card_id": ("size",)}, "new_"
    )
    return floating(profiles.purchase_span(df, X.AS_OF, "new_"))


for _k, _suffix in ((0, ""), (-2, "_2"), (-6, "_6")):
    query("lag_profile" + _suffix)(
        lambda s, k=_k: floating(profiles.lag_profile(s.hist, k, X.AS_OF, X.HOLIDAYS))
    )


@query("cut_profiles")
def _(s):
    """The seven lag and amount profiles together, from one pass over the log."""
    return floating(
        cuts.lag_and_amount_profiles(s.kept_hist, X.AS_OF, X.HOLIDAYS, LAG_FROM, AMOUNT_RANGES)
    )


@query("quarter_profile")
def _(s):
    return floating(profiles.quarter_profile(s.hist, X.QUARTER_STARTS))


@query("new_amount_profile")
def _(s):
    return floating(profiles.new_amount_profile(s.new, X.AS_OF))


for _lo, _hi, _suffix in ((-7, -3, ""), (-1, 100, "_1"), (-3, 100, "_3"), (-100, 100, "_all")):
    query("hist_amount_profile" + _suffix)(
        lambda s, lo=_lo, hi=_hi: floating(profiles.hist_amount_profile(s.hist, lo, hi, X.AS_OF))
    )


@query("hist_merchant_profile")
def _(s):
    return floating(s.hist_merchants)


@query("new_merchant_profile")
def _(s):
    return floating(s.new_merchants)


@query("visited_merchant_profile")
def _(s):
    """Historical profiles of the merchants that the new log visits."""
    return floating(
        merchants.hist_merchant_profile(s.hist, X.AS_OF, X.HOLIDAYS, visiting=s.new)
    )


@query("merchant_combined")
def _(s):
    return s.all_merchants


@query("card_merchant_profile")
def _(s):
    return floating(merchants.card_merchant_profile(s.kept_new, s.all_merchants))


@query("category_amount_stats")
def _(s):
    df = profiles.category_amount_stats(cleaning.clean(s.hist))
    made = [f"{c}_{m}" for c in ("category_2", "category_3") for m in ("mean", "min", "max", "sum")]
    return df.select(*ROW, *made)


@query("outlier_rate_encode")
def _(s):
    df = cards.outlier_rate_encode(cleaning.flag_outliers(s.cards))
    return df.select("card_id", *cards.FEATURES)


@query("last_observation_date")
def _(s):
    return encode.last_observation_date(s.hist)


@query("first_new_observation_date")
def _(s):
    return encode.first_new_observation_date(s.new)


@query("smoothed_target_mean")
def _(s):
    labelled = encode.label_transactions(s.hist, folds.card_folds(s.cards, 7, 10))
    return encode.smoothed_target_mean(labelled, "merchant_id", F.lit(-0.5))


@query("transaction_prior")
def _(s):
    labelled = encode.label_transactions(s.hist, folds.card_folds(s.cards, 7, 10))
    return encode.transaction_prior(labelled)


def _encoded_log(s: Sample) -> DataFrame:
    return s.kept(s.hist.select("card_id", *encode.ENCODED_KEYS), "hist-keys")


@query("oof_target_encode")
def _(s):
    return encode.oof_target_encode(_encoded_log(s), s.cards, ratios=False)


@query("oof_target_encode_new")
def _(s):
    return encode.oof_target_encode(s.new, s.cards, "new_target_encoding_", ratios=False)


@query("target_ratio_pairs")
def _(s):
    return encode.oof_target_encode(_encoded_log(s), s.cards)


@query("date_target_encode")
def _(s):
    return encode.date_target_encode(s.cards, s.hist)


@query("lag_amount_sum")
def _(s):
    return lags.lag_amount_sum(lags.combine_lag_tables(s.hist, s.new))


@query("lag_pivot")
def _(s):
    return s.lag_matrix


@query("class_counts")
def _(s):
    return folds.class_counts(cleaning.round_target(s.train))


@query("rmse")
def _(s):
    return oof.rmse(s.guess())


@query("fold_rmse")
def _(s):
    return oof.fold_rmse(s.guess())


# Order


@query("shuffle_in_class")
def _(s):
    df = folds.shuffle_in_class(cleaning.round_target(s.train), 120)
    return df.select("card_id", "rounded_target", "class_size", "class_index", "total", "class_rank")


@query("stratified_interleave")
def _(s):
    df = folds.stratified_interleave(cleaning.round_target(s.train), 120)
    return df.select("card_id", "rounded_target", "position")


@query("kfold_contiguous")
def _(s):
    df = folds.stratified_interleave(cleaning.round_target(s.train), 120)
    return folds.kfold_contiguous(df, 6).select("card_id", "fold_rank", "fold")


@query("running_total_by_lag")
def _(s):
    return s.lag_totals


def _added(made: DataFrame, base: DataFrame) -> DataFrame:
    return made.select(
        "card_id", *[F.col(f"`{c}`") for c in made.columns if c not in base.columns]
    )


@query("lag_stats")
def _(s):
    return _added(lags.lag_stats(s.lag_totals), s.lag_totals)


@query("lag_argmax")
def _(s):
    return lags.lag_argmax(s.lag_totals).select("card_id", "month_lag_maxindex")


@query("lag_argmin")
def _(s):
    return lags.lag_argmin(s.lag_totals).select("card_id", "month_lag_minindex")


@query("new_share")
def _(s):
    return lags.new_share(lags.lag_stats(s.lag_totals)).select("card_id", F.col("`new_%`"))


@query("lag_shares")
def _(s):
    df = lags.lag_stats(s.lag_totals)
    return _added(lags.lag_shares(df), df)


@query("lag_deltas")
def _(s):
    return _added(lags.lag_deltas(s.lag_totals), s.lag_totals)


@query("monthly_change")
def _(s):
    return lags.monthly_change(s.hist, s.new)


@query("sort_by_key")
def _(s):
    return columns.sort_by_key(s.cards.select("card_id", "target"), "card_id")


def _spreads(s: Sample) -> list[DataFrame]:
    """feature, importance per fold: log1p of the feature's spread outside it."""
    names = ["feature_1", "feature_2", "feature_3", "hist_rows", "hist_amount"]
    out = []
    for fold in (0, 1):
        kept = s.folded(120).filter(f"target IS NOT NULL AND fold <> {fold}")
        spread = kept.select(*[F.log1p(F.var_samp(n)).alias(n) for n in names])
        out.append(spread.unpivot([], names, "feature", "importance"))
    return out


@query("top_k_features")
def _(s):
    a, b = _spreads(s)
    return selection.top_k_features(a.unionByName(b), 3)


# Sets


@query("union_train_test")
def _(s):
    return cards.union_train_test(cleaning.flag_outliers(s.train), s.test)


@query("union_folds")
def _(s):
    df = s.folded(120, columns=("card_id", "target", "fold"))
    parts = [df.filter(F.col("fold") == f) for f in range(6)]
    return assemble.union_folds([*parts, df.filter("fold = -1").drop("target")])


@query("concat_columns")
def _(s):
    return selection.concat_columns(_spreads(s))


@query("distinct_keys")
def _(s):
    return columns.distinct_keys(s.hist, "card_id")


# Learning

SMALL_TREES = dict(maxIter=3, maxDepth=3)
INPUTS = ["feature_1", "feature_2", "feature_3", "hist_rows", "hist_amount"]


@query("standardize")
def _(s):
    return scaling.standardize(
        _unbounded_prices(s).select(
            "card_id",
            *[F.when(F.abs(c) < scaling.INF, F.col(c)).alias(c) for c in ("price_max", "price_min")],
        ),
        ["price_max", "price_min"],
    )


@query("embed_2d")
def _(s):
    return scaling.embed_2d(s.card_table, columns.feature_names(s.card_table))


@query("minmax_scale")
def _(s):
    df = s.model_table.select("card_id", "target", *INPUTS).withColumn("flat", F.lit(7.0))
    return scaling.minmax_scale(df, [*INPUTS, "flat"])


@query("oof_predict")
def _(s):
    data = oof.vectors(s.folded(40), RIDGE_FEATURES)
    return oof.stack_level1(data, {"pred": oof.ridge(data, 10.0)}, 6)


@query("oof_gbt")
def _(s):
    return oof.oof_gbt(s.folded(40), INPUTS, **SMALL_TREES)


BOOSTING = boosting.Params(trees=12, depth=4, leaves=12, rate=0.1, patience=4)


@query("oof_histogram")
def _(s):
    return boosting.oof_histogram(oof.vectors(s.folded(40), INPUTS), oof.VECTOR, 6, BOOSTING)


def _no_worse(out: DataFrame) -> DataFrame:
    """Every card has a prediction, and a model that may stop at once is no worse, over the
    folds it never saw, than the mean it starts from."""
    known = out.where("target IS NOT NULL")
    n, total = known.agg(F.count("target"), F.sum("target")).first()
    means = known.groupBy("fold").agg(
        ((F.lit(total) - F.sum("target")) / (F.lit(n) - F.count("target"))).alias("mean")
    )
    gap = lambda c: F.sum(F.pow(F.col("target") - F.col(c), F.lit(2)))
    better = known.join(means, "fold").agg((gap("pred") <= gap("mean")).alias("ok")).first()["ok"]
    return _stated_predictions(out).withColumn("no_worse", F.lit(int(better)))


@query("oof_histogram_stated")
def _(s):
    data = oof.vectors(s.folded(40), INPUTS)
    return _no_worse(boosting.oof_histogram(data, oof.VECTOR, 6, BOOSTING))


CATEGORIES = ["feature_1", "feature_2", "feature_3"]
ORDERED = ordered.Params(trees=8, depth=4, rate=0.2, patience=4)


@query("ordered_statistics")
def _(s):
    told = ordered.ordered_statistics(s.folded(40, columns=("card_id", "target", "fold", *CATEGORIES)), CATEGORIES, 6)
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}_ts").alias("told")) for c in CATEGORIES])
    return (
        told.select("card_id", F.col("__level").alias("level"), F.explode(each).alias("e"))
        .select("card_id", "level", "e.feature", F.posexplode("e.told").alias("model", "statistic"))
    )


def _ordered(s) -> DataFrame:
    rows = s.folded(40)
    data = oof.vectors(rows, [c for c in INPUTS if c not in CATEGORIES])
    with_kinds = data.join(rows.select("card_id", *CATEGORIES), "card_id")
    return ordered.oof_ordered(with_kinds, oof.VECTOR, CATEGORIES, 6, ORDERED)


@query("oof_ordered")
def _(s):
    return _ordered(s)


@query("oof_ordered_stated")
def _(s):
    return _no_worse(_ordered(s))


EXTRA_TREES = extra_trees.Params(trees=40, depth=5, feature_share=0.6)


@query("oof_extra_trees")
def _(s):
    return extra_trees.oof_extra(oof.vectors(s.folded(40), INPUTS), oof.VECTOR, 6, EXTRA_TREES)


@query("oof_extra_trees_stated")
def _(s):
    """A tree averages targets of other folds, so its prediction stays between them."""
    out = extra_trees.oof_extra(oof.vectors(s.folded(40), INPUTS), oof.VECTOR, 6, EXTRA_TREES)
    low, high = s.train.agg(F.min("target"), F.max("target")).first()
    inside = F.col("pred").between(low - 1e-9, high + 1e-9).cast("int")
    return _stated_predictions(out).join(out.select("card_id", inside.alias("inside")), "card_id")


NETWORK = network.Params(widths=(16, 8), epochs=6, slices=2, rate=0.02)


@query("oof_network")
def _(s):
    return network.oof_network(oof.vectors(s.folded(40), INPUTS), oof.VECTOR, 6, NETWORK)


@query("oof_network_stated")
def _(s):
    data = oof.vectors(s.folded(40), INPUTS)
    return _stated_predictions(network.oof_network(data, oof.VECTOR, 6, NETWORK, "pred"))


@query("oof_forest")
def _(s):
    return oof.oof_forest(s.folded(40), INPUTS, numTrees=10, maxDepth=4)


@query("oof_ridge")
def _(s):
    return oof.oof_ridge(s.folded(40), RIDGE_FEATURES, 0.1)


@query("feature_importance")
def _(s):
    data = oof.vectors(s.folded(120), INPUTS)
    return selection.feature_importance(data, INPUTS, oof.gbt(**SMALL_TREES), 0)


@query("select_by_importance")
def _(s):
    df = cleaning.flag_outliers(s.folded(120))
    return selection.select_by_importance(df, (4, 3, 2), estimator=oof.gbt(**SMALL_TREES))


@query("stack_level1")
def _(s):
    data = oof.vectors(s.folded(40), RIDGE_FEATURES)
    learners = {"ridgek": oof.ridge(data, 0.1), "stiff": oof.ridge(data, 1000.0)}
    return oof.stack_level1(data, learners, 6)


@query("stack_features")
def _(s):
    return bl.stack_features(_stacks(s))


@query("blend")
def _(s):
    df = s.model_table.select(
        "card_id",
        (F.col("hist_amount") * 0.1).alias("ridge"),
        (F.col("feature_1") * 0.2).alias("nn"),
        (F.col("hist_rows") * 0.01).alias("lgb"),
    )
    return bl.blend(df)


@query("repeat_average")
def _(s):
    frames = []
    for r in range(bl.REPEATS):
        frames.append(oof.oof_ridge(s.folded(bl.REPEAT_SEED + r), RIDGE_FEATURES, bl.LEVEL2_ALPHA))
    return bl.repeat_average(frames)


@query("gram_ridge")
def _(s):
    """Coefficients of all repeats, folds and penalties from one pass over the rows."""
    # Each part is written before the next: in one plan the driver would hold the broadcasts and
    # the generated code of all repeats at a time, and the pivot's rows would compute them once more.
    rows = s.kept(s.model_table.select("card_id", "target", *GRAM_FEATURES), "model-table")
    cards = s.kept(s.cards.select("card_id", "target"), "targets")
    named = [f"fold_{r}" for r in range(bl.REPEATS)]
    for r, name in enumerate(named):
        f = folds.card_folds(cards, 6, bl.REPEAT_SEED + r)
        rows = rows.join(s.kept(f.select("card_id", F.col("fold").alias(name)), name), "card_id")
    data = s.kept(oof.assembled(rows, GRAM_FEATURES, named), "gram-rows")
    grams = gram.fold_grams(data, oof.VECTOR, named)
    out = []
    for r, name in enumerate(named):
        for held in range(6):
            for alpha in GRAM_ALPHAS:
                beta, intercept = grams.solve(alpha, held, name)
                out.append((r, held, alpha, *map(float, beta), intercept))
    return s.spark.createDataFrame(out, "r int, held int, alpha double, b1 double, b2 double, b3 double, b0 double")


@query("score_single")
def _(s):
    return bl.score_single(s.model_table, INPUTS, **SMALL_TREES)[1]


# What SQL can state of the trained results: which rows, folds and targets come
# back, that every row has a finite value, and the bounds and sums values keep.


def _stated_predictions(df: DataFrame) -> DataFrame:
    known = F.coalesce(~F.isnan("pred") & (F.abs("pred") < scaling.INF), F.lit(False))
    return df.select("card_id", "target", "fold", known.cast("int").alias("predicted"))


@query("oof_gbt_stated")
def _(s):
    return _stated_predictions(oof.oof_gbt(s.folded(40), INPUTS, **SMALL_TREES))


@query("oof_forest_stated")
def _(s):
    """A forest averages targets, so it stays between them."""
    pred = oof.oof_forest(s.folded(40), INPUTS, numTrees=10, maxDepth=4)
    low, high = s.train.agg(F.min("target"), F.max("target")).first()
    inside = F.col("pred").between(low - 1e-9, high + 1e-9).cast("int")
    stated = _stated_predictions(pred)
    return stated.join(pred.select("card_id", inside.alias("inside")), "card_id")


@query("score_single_stated")
def _(s):
    scores = bl.score_single(s.model_table, INPUTS, **SMALL_TREES)[1]
    return scores.select("card_id", F.col("target").isNotNull().cast("int").alias("scored"))


@query("feature_importance_stated")
def _(s):
    """Before the logarithm the shares of the gain are 0 to 1 and sum to one."""
    data = oof.vectors(s.folded(120), INPUTS)
    found = selection.feature_importance(data, INPUTS, oof.gbt(**SMALL_TREES), 0)
    share = F.expm1("importance")
    total = F.sum(share).over(Window.partitionBy("fold"))
    return found.select("feature", "fold", share.between(0, 1).cast("int").alias("ok"), total.alias("total"))


@query("select_by_importance_stated")
def _(s):
    df = cleaning.flag_outliers(s.folded(120))
    out = selection.select_by_importance(df, (4, 3, 2), estimator=oof.gbt(**SMALL_TREES))
    return out.select("card_id", "outliers", "target", F.lit(len(out.columns) - 3).alias("features"))


@query("embed_2d_stated")
def _(s):
    """Components are centred and uncorrelated, the first varies more, and the
    other two columns are their sum and product."""
    df = scaling.embed_2d(s.card_table, columns.feature_names(s.card_table))
    plus = F.abs(F.col("`umap+umap`") - F.col("umap0") - F.col("umap1")) < 1e-9
    times = F.abs(F.col("`umap*umap`") - F.col("umap0") * F.col("umap1")) < 1e-9
    close = lambda c: (F.abs(c) < 1e-6).cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((plus & times).cast("int")).alias("n_right"),
        close(F.avg("umap0")).alias("centred0"),
        close(F.avg("umap1")).alias("centred1"),
        close(F.corr("umap0", "umap1")).alias("uncorrelated"),
        (F.var_samp("umap0") > F.var_samp("umap1")).cast("int").alias("ordered"),
    )
