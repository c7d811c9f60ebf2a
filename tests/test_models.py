import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.models import blend, oof, scaling, selection


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        x = rng.normal(size=3)
        y = None if i % 5 == 0 else float(2 * x[0] - x[1] + rng.normal() * 0.1)
        rows.append((f"c{i}", y, -1 if y is None else i % 3, *map(float, x), 0 if y is None else 1))
    return spark.createDataFrame(
        rows, "card_id string, target double, fold int, a double, b double, c double, outliers int"
    ).cache()


FEATURES = ["a", "b", "c"]


@pytest.mark.parametrize("alpha", [0.1, 1.0, 50.0])
def test_ridge_is_the_closed_form(table, alpha):
    got = {r["card_id"]: r["pred"] for r in oof.oof_ridge(table, FEATURES, alpha, 3).collect()}
    pdf = table.toPandas()
    test_preds = []
    for fold in range(3):
        kept = pdf[(pdf.fold != fold) & (pdf.fold >= 0)]
        x, y = kept[FEATURES].to_numpy(), kept.target.to_numpy()
        m = x.mean(0)
        beta = np.linalg.solve((x - m).T @ (x - m) + alpha * np.eye(3), (x - m).T @ (y - y.mean()))
        held = pdf[pdf.fold == fold]
        for card, p in zip(held.card_id, y.mean() + (held[FEATURES].to_numpy() - m) @ beta):
            assert got[card] == pytest.approx(p, abs=1e-8)
        test = pdf[pdf.fold == -1]
        test_preds.append(y.mean() + (test[FEATURES].to_numpy() - m) @ beta)
    for card, p in zip(test.card_id, np.mean(test_preds, axis=0)):
        assert got[card] == pytest.approx(p, abs=1e-8)


def test_trees_beat_the_mean(table):
    spread = table.filter("target IS NOT NULL").agg(F.stddev_pop("target")).first()[0]
    data = oof.vectors(table, FEATURES)
    learners = {
        "gbt": oof.gbt(maxIter=5, maxDepth=3, stepSize=0.3),
        "forest": oof.forest(numTrees=10, maxDepth=4, featureSubsetStrategy="all"),
    }
    out = oof.stack_level1(data, learners, 3).cache()
    assert out.count() == 240 and out.filter("gbt IS NULL OR forest IS NULL").count() == 0
    for name in learners:
        assert oof.rmse(out, p=name).first()["rmse"] < spread


def test_selection_finds_the_signal(table):
    out = selection.select_by_importance(
        table.withColumn("noise", F.rand(3)), (2,), estimator=oof.gbt(maxIter=3, maxDepth=3)
    )
    assert sorted(out.columns) == sorted(["card_id", "outliers", "target", "a", "b"])


def test_passes_share_one_layout_and_fit_at_the_same_time(table, monkeypatch):
    wide = table.withColumns({"noise": F.rand(3), "gap": F.when(F.col("a") > 0, F.col("c"))})
    names, learner = ["a", "b", "c", "noise", "gap"], oof.gbt(maxIter=3, maxDepth=3)
    whole = scaling.model_inputs(wide, names)
    kept = names
    for size in (4, 3, 2):  # one model after the other, each pass laid out anew
        data = oof.vectors(whole, kept)
        found = [selection.feature_importance(data, kept, learner, f) for f in (0, 1)]
        kept = [r["feature"] for r in selection.top_k_features(found[0].union(found[1]), size).collect()]

    laid, plain, both = [], selection.feature_importance, threading.Barrier(2, timeout=120)

    def vectors(df, features):
        laid.append(df.filter("fold = -1").count())
        return oof.vectors(df, features)

    def together(data, features, estimator, fold):
        both.wait()
        assert data.first()[oof.VECTOR].size == len(features)
        return plain(data, features, estimator, fold)

    monkeypatch.setattr(selection, "vectors", vectors)
    monkeypatch.setattr(selection, "feature_importance", together)
    out = selection.select_by_importance(wide, (4, 3, 2), estimator=learner)
    assert out.columns == ["card_id", "outliers", "target", *kept]
    assert out.count() == 240 and laid == [0]


def test_slices_keep_rows_and_order(table):
    data = oof.vectors(table, FEATURES)
    rows = lambda df: {(r["card_id"], r["target"], r["fold"], tuple(r[oof.VECTOR])) for r in df.collect()}
    assert rows(selection.sliced(data, [2, 0])) == rows(oof.vectors(table, ["c", "a"]))


def test_components_are_orthogonal_and_ordered(table):
    pdf = scaling.embed_2d(table, FEATURES).toPandas()
    assert pdf["umap0"].var() >= pdf["umap1"].var()
    assert abs(np.corrcoef(pdf["umap0"], pdf["umap1"])[0, 1]) < 1e-6


def test_infinities_and_gaps(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [("a", 1.0, 1.0, None), ("b", 1.0, inf, None), ("c", 1.0, 3.0, None), ("d", None, inf, 2.0), ("e", None, -inf, None)],
        "card_id string, target double, x double, empty double",
    )
    got = {r["card_id"]: r for r in scaling.replace_infinite(df, ["x", "empty"]).collect()}
    assert [got[k]["x"] for k in "abcde"] == [1.0, 4.0, 3.0, 4.0, 1.0]
    inputs = {r["card_id"]: r for r in scaling.model_inputs(df, ["x", "empty"]).collect()}
    assert inputs["e"]["empty"] == 0.0 and inputs["d"]["empty"] == 2.0


def test_standardize_matches_imputed_population_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (4.0, 5.0)], "x double, flat double")
    got = scaling.standardize(df, ["x", "flat"]).collect()
    x = np.array([1.0, 2.5, 4.0])
    assert [r["x"] for r in got] == pytest.approx(list((x - x.mean()) / x.std()))
    assert [r["flat"] for r in got] == [0.0] * 3


def test_constant_column_is_shifted(spark):
    df = spark.createDataFrame([(1.0, 7.0), (None, 9.0)], "target double, x double")
    assert [r["x"] for r in scaling.minmax_scale(df, ["x"]).collect()] == [0.0, 2.0]


def test_repeats_average(spark):
    a = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 4.0)], "card_id string, target double, pred double")
    b = a.withColumn("pred", F.col("pred") + 2)
    got = {r["card_id"]: (r["target"], r["pred"]) for r in blend.repeat_average([a, b]).collect()}
    assert got == {"a": (1.0, 3.0), "b": (None, 5.0)}


def test_stacks_join_by_card(spark):
    a = spark.createDataFrame([("a", 1.0, 2.0)], "card_id string, target double, m double")
    b = spark.createDataFrame([("a", 1.0, 3.0), ("b", None, 4.0)], "card_id string, target double, m double")
    got = {r["card_id"]: r.asDict() for r in blend.stack_join([a, b]).collect()}
    assert got["a"] == {"card_id": "a", "m_0": 2.0, "m_1": 3.0, "target": 1.0}
    assert got["b"]["m_0"] is None and got["b"]["target"] is None


def test_level_two_blends_every_repeat(spark):
    """The ridge of all repeats from one pass equals one ridge per repeat."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(150):
        x = rng.normal(size=2)
        rows.append((f"c{i}", None if i % 5 == 0 else float(x[0] - x[1] + 0.1 * rng.normal()), *map(float, x)))
    stacked = spark.createDataFrame(rows, "card_id string, target double, m_0 double, m_1 double")
    got = {r.card_id: r.pred for r in blend.level2(stacked, {"ridge": 1.0}, repeats=2, k=3).collect()}
    frames = []
    for r in range(2):
        folds = blend.card_folds(stacked, 3, blend.REPEAT_SEED + r).select("card_id", "fold")
        frames.append(oof.oof_ridge(stacked.join(folds, "card_id"), ["m_0", "m_1"], oof.LEVEL2_ALPHA, 3))
    want = {r.card_id: r.pred for r in blend.repeat_average(frames).collect()}
    assert set(got) == set(want) == {f"c{i}" for i in range(150)}
    assert all(got[c] == pytest.approx(want[c], abs=1e-9) for c in want)
    both = blend.level2(stacked, {"ridge": 0.7, "lgb": 0.3}, repeats=1, k=2, maxIter=2)
    assert both.where("pred IS NOT NULL AND NOT isnan(pred)").count() == 150
