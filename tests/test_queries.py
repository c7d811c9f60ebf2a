"""Queries against their SQL on the smallest sample, and what their plans hold.

All queries run through `python -m checks.compare`; the ones here are quick.
"""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences
from checks.queries import QUERIES
from cardloom.models import gram
from cardloom.operators import profiles
from cardloom.sources import readers, staging
from cardloom.sources import tpch_cards as X

QUICK = """
read_cards read_transactions write_scores_csv narrow_types prefix_columns split_train_test
fill_defaults recode_category3 restore_amount parse_dates calendar_parts elapsed_interactions
one_hot price_ratio holiday_proximity amount_interactions quarter_window_flags replace_infinite
lookup_encode_hot_split stack_features hist_card_profile hist_amount_profile category_amount_stats
last_observation_date transaction_prior lag_pivot monthly_change shuffle_in_class kfold_contiguous
checkpoint_resumed read_mixed_headers gram_ridge cut_profiles ordered_statistics oof_ordered_stated oof_extra_trees_stated oof_network_stated
top_k_features oof_ridge minmax_scale fold_rmse embed_2d_stated feature_importance_stated
""".split()

# No SQL for the values of tree ensembles and principal components; what can be stated of
# them is in the queries of the same name with _stated.
ROWS_ONLY = {
    "embed_2d",
    "oof_gbt",
    "oof_forest",
    "oof_histogram",
    "oof_ordered",
    "oof_extra_trees",
    "oof_network",
    "feature_importance",
    "select_by_importance",
    "score_single",
}


@pytest.fixture(scope="module")
def con(sample):
    return connect(sample)


def test_every_query_has_sql_unless_it_cannot():
    assert set(QUERIES) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sample, con, name):
    assert differences(queries()[name](spark, sample), con, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def test_gram_ridge_passes_read_a_stage(spark, sample, monkeypatch):
    """One plan of all repeats would be in the driver at a time, and run once per pass."""
    seen, made = [], gram.fold_grams
    monkeypatch.setattr(gram, "fold_grams", lambda data, *a: seen.append(data) or made(data, *a))
    assert queries()["gram_ridge"](spark, sample).count() == 54
    (data,) = seen
    assert "Scan parquet" in plan(data) and "Exchange" not in plan(data) and "Join" not in plan(data)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_log_scan_is_pruned(spark, sample):
    df = profiles.agg_spec(X.hist_log(spark, sample), "card_id", {"purchase_amount": ("sum",)})
    text = plan(df)
    assert "l_shipdate" not in text and "o_totalprice" not in text


def test_the_two_logs_use_every_line(spark, sample):
    lines = spark.read.parquet(f"{sample}/lineitem.parquet").count()
    hist, new = X.hist_log(spark, sample), X.new_log(spark, sample)
    assert hist.count() + new.count() == lines
    assert hist.unionByName(new).join(X.cards(spark, sample), "card_id", "left_anti").count() == 0


def test_no_cross_join_and_no_python(spark, sample):
    for name in ("hist_card_profile", "monthly_change", "merchant_full_join", "kfold_contiguous"):
        text = plan(queries()[name](spark, sample))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
            assert bad not in text, (name, bad)


def test_filter_reaches_staged_log(spark, sample):
    log = staging.staged(X.hist_log(spark, sample), "log")
    text = plan(profiles.cleaning.filter_lag_from(log, -2).select("card_id"))
    assert "GreaterThanOrEqual(month_lag,-2)" in text
    assert "ReadSchema: struct<card_id:string,month_lag:int>" in text


def test_reader_turns_nan_into_null(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("c", float("nan"))], "card_id string, purchase_amount double")
    df = df.selectExpr("*", "cast(NULL AS double) AS category_2")
    df.write.parquet(path)
    assert readers.read_transactions(spark, path, "parquet").first()["purchase_amount"] is None


def test_folds_are_made_once_for_all_branches(spark, sample):
    for name in ("union_folds", "fold_rmse"):
        text = plan(queries()[name](spark, sample))
        assert "lineitem.parquet" not in text and "Window" not in text, name
