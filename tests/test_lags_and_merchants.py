import pytest

from cardloom.operators import assemble, lags, merchants
from cardloom.schemas import LAGS


@pytest.fixture(scope="module")
def matrix(spark):
    rows = [("tie", 0, 1.0), ("tie", -5, 2.0), ("tie", -5, 3.0), ("none", -3, None), (None, 0, 5.0)]
    df = spark.createDataFrame(rows, "card_id string, month_lag int, purchase_amount double")
    return lags.lag_pivot(df)


def by_card(df):
    return {r["card_id"]: r for r in df.collect()}


def test_pivot_fills_zero_and_drops_null_cards(matrix):
    got = by_card(matrix)
    assert set(got) == {"tie", "none"}
    assert got["tie"]["0"] == 1.0 and got["tie"]["-5"] == 5.0
    assert [got["none"][str(k)] for k in LAGS] == [0.0] * 16


def test_totals_run_upwards_and_deltas_add_up(matrix):
    totals = lags.running_total_by_lag(matrix)
    got = by_card(lags.lag_deltas(totals))["tie"]
    assert got["-13"] == 0.0 and got["-5"] == 5.0 and got["2"] == 6.0
    names = [f"{a}-{b}" for a, b in zip(LAGS, LAGS[1:])]
    assert sum(got[n] for n in names) == got["2"] - got["-13"]


def test_ties_go_to_the_latest_month(matrix):
    totals = lags.running_total_by_lag(matrix)
    got = by_card(lags.lag_argmin(lags.lag_argmax(totals)))
    assert got["tie"]["month_lag_maxindex"] == 2
    assert got["tie"]["month_lag_minindex"] == -6
    assert got["none"]["month_lag_maxindex"] == 2 and got["none"]["month_lag_minindex"] == 2


def test_stats_of_an_idle_card(matrix):
    got = by_card(lags.lag_shares(lags.new_share(lags.lag_stats(lags.running_total_by_lag(matrix)))))
    assert got["none"]["month_lag_min"] is None and got["none"]["month_lag_var"] == 0.0
    assert got["none"]["new_%"] is None and got["none"]["2%"] is None
    assert got["tie"]["month_lag_min"] == 5.0


def test_unknown_merchants_and_repeat_visits(spark):
    shops = spark.createDataFrame([("a", 1.0, 10.0), ("b", 3.0, None)], "merchant_id string, x double, y double")
    log = spark.createDataFrame(
        [("c", "a", "A", 1.0), ("c", "a", "A", 1.0), ("c", "b", "A", 1.0), ("d", "zz", "A", 1.0), ("d", None, "A", 1.0)],
        "card_id string, merchant_id string, category_3 string, category_2 double",
    )
    got = by_card(merchants.card_merchant_profile(log, shops, "n_"))
    c, d = got["c"], got["d"]
    assert (c["n_mer1x_sum"], c["n_mer1x_min"], c["n_mer1x_max"]) == (5.0, 1.0, 3.0)
    assert c["n_mer1x_mean"] == pytest.approx(5 / 3) and c["n_mer1y_mean"] == 10.0
    assert d["n_mer1x_sum"] == 0.0 and d["n_mer1x_mean"] is None


def test_combined_merchants_pair_by_name(spark):
    new = spark.createDataFrame([("a", 1.0, 5), ("b", 2.0, 6)], "merchant_id string, new_x double, new_n long")
    hist = spark.createDataFrame([("a", 10.0, 7)], "merchant_id string, hist_x double, hist_n long")
    got = {r["merchant_id"]: r for r in merchants.merchant_combined(new, hist).collect()}
    assert (got["a"]["mer+hishist_x"], got["a"]["mer+hishist_n"]) == (11.0, 12.0)
    assert (got["b"]["mer+hishist_x"], got["b"]["mer+hishist_n"]) == (2.0, 6.0)


def test_outer_assembly_keeps_cards_of_the_log(spark):
    cards = spark.createDataFrame([("a",)], "card_id string")
    part = spark.createDataFrame([("a", 1), ("z", 2)], "card_id string, n int")
    assert assemble.assemble_features(cards, [part]).count() == 1
    assert assemble.assemble_features(cards, [part], "outer").count() == 2


def test_only_visited_merchants_are_profiled(spark, sample):
    from cardloom.operators import cleaning, merchants
    from cardloom.sources import tpch_cards as X

    hist, new = X.hist_log(spark, sample), X.new_log(spark, sample).where("merchant_id IN ('M_2', 'M_5')")
    some = merchants.hist_merchant_profile(hist, X.AS_OF, X.HOLIDAYS, visiting=new)
    every = merchants.hist_merchant_profile(hist, X.AS_OF, X.HOLIDAYS)
    visited = {r[0] or cleaning.DEFAULT_MERCHANT for r in new.select("merchant_id").distinct().collect()}
    want = {r.merchant_id: r for r in every.collect() if r.merchant_id in visited}
    got = {r.merchant_id: r for r in some.collect()}
    assert 0 < len(want) < every.count() and set(got) == set(want)
    for name, row in got.items():
        for a, b in zip(row, want[name]):
            assert a == b or (isinstance(a, float) and abs(a - b) <= 1e-9 * max(1, abs(a)))

