import hashlib
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardloom.operators import cleaning, encode, folds
from cardloom.sources import tpch_cards as X


@pytest.fixture(scope="module")
def cards(spark, sample):
    return X.cards(spark, sample).select("card_id", "target").cache()


def brute_folds(df, k, seed):
    """card -> fold, by a plain loop."""
    train = df[df.target.notna()].copy()
    train["cls"] = train.target.round(0)
    n = len(train)
    placed = []
    for i, (_, group) in enumerate(sorted(train.groupby("cls")), start=1):
        ids = sorted(group.card_id, key=lambda c: (hashlib.md5(f"{c}:{seed}".encode()).hexdigest(), c))
        v = len(ids)
        placed += [(n / (v + 1) + j * (n / v) + 0.000001 * i, c) for j, c in enumerate(ids)]
    order = [c for _, c in sorted(placed)]
    sizes = [n // k + (f < n % k) for f in range(k)]
    out, start = {}, 0
    for f, size in enumerate(sizes):
        out.update(dict.fromkeys(order[start : start + size], f))
        start += size
    return out


@pytest.mark.parametrize("k,seed", [(7, 10), (6, 120), (2, 1)])
def test_folds_equal_brute_force(cards, k, seed):
    got = {r["card_id"]: r["fold"] for r in folds.card_folds(cards, k, seed).collect()}
    pdf = cards.toPandas()
    want = brute_folds(pdf, k, seed) | dict.fromkeys(pdf.card_id[pdf.target.isna()], -1)
    assert got == want


def test_more_folds_than_cards(spark):
    df = spark.createDataFrame([(f"c{i}", float(i)) for i in range(3)], "card_id string, target double")
    got = sorted(r["fold"] for r in folds.card_folds(df, 5, 1).collect())
    assert got == [0, 1, 2]


def test_classes_are_spread_over_folds(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("c"), "id").alias("card_id"),
        F.when(F.col("id") % 50 == 0, -33.2).otherwise((F.col("id") % 2).cast("double")).alias("target"),
    )
    got = folds.card_folds(df, 5, 3).filter("target < -30").groupBy("fold").count().collect()
    assert [r["count"] for r in got] == [20] * 5


def test_no_window_over_the_whole_table(cards):
    df = folds.kfold_contiguous(
        folds.stratified_interleave(cleaning.round_target(cards.filter("target IS NOT NULL")), 1), 6
    )
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "row_number" in line and "class_index" not in line:
            assert "__bucket" in line, line


@pytest.fixture(scope="module")
def log(spark, sample):
    return X.hist_log(spark, sample).select("card_id", "merchant_id", "category_2").cache()


def brute_encoding(log, fold_of, target, key, held):
    """Encodings of ``key`` seen by a card of fold ``held``."""
    kept = log[log.card_id.map(lambda c: c in target and fold_of[c] != held)]
    y = kept.card_id.map(target)
    prior = y.mean()
    out = {}
    for value, ys in y.groupby(kept[key]):
        w = 1 / (1 + math.exp(-(len(ys) - 85)))
        out[value] = prior * (1 - w) + ys.mean() * w
    return out


def test_encoding_equals_per_fold_computation(cards, log):
    got = {
        r["card_id"]: r
        for r in encode.oof_target_encode(log, cards, "p_", ["merchant_id", "category_2"]).collect()
    }
    pdf, plog = cards.toPandas(), log.toPandas()
    train = pdf[pdf.target.notna()]
    target = dict(zip(train.card_id, train.target))
    fold_of = brute_folds(pdf, 7, 10)
    tables = {
        (held, k): brute_encoding(plog, fold_of, target, k, held)
        for held in range(-1, 7)
        for k in ("merchant_id", "category_2")
    }
    for card, rows in plog.groupby("card_id"):
        held = fold_of.get(card, -1)
        m = rows.merchant_id.map(tables[held, "merchant_id"]).astype(float)
        c = rows.category_2.map(tables[held, "category_2"]).astype(float)
        r = m / c
        for name, s in (("merchant_idtaren", m), ("category_2taren", c), ("merchant_idtarencategory_2tarensou", r)):
            row = got[card]
            assert row[f"p_{name}_sum"] == pytest.approx(s.sum(), abs=1e-9)
            for stat in ("mean", "max", "min", "var"):
                a, b = row[f"p_{name}_{stat}"], getattr(s, stat)()
                assert (a is None and pd.isna(b)) or a == pytest.approx(b, abs=1e-9), (card, name, stat)
    assert set(got) == set(pdf.card_id)


def test_own_target_does_not_leak(cards, log):
    """Moving one card's target inside its class leaves its own encoding alone."""
    card = next(
        r["card_id"]
        for r in log.join(cards.filter("target > 0.1 AND target < 0.4"), "card_id").limit(1).collect()
    )
    moved = cards.withColumn(
        "target", F.when(F.col("card_id") == card, F.col("target") - 0.05).otherwise(F.col("target"))
    )
    a, b = (
        encode.oof_target_encode(log, c, "p_", ["category_2"], ratios=False).filter(F.col("card_id") == card).first()
        for c in (cards, moved)
    )
    assert a["p_category_2taren_sum"] == pytest.approx(b["p_category_2taren_sum"], abs=1e-12)
