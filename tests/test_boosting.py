import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.models import boosting as bo
from cardloom.models import gram, oof
from cardloom.operators import encode


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        x = rng.normal(size=5)
        y = float(np.sin(2 * x[0]) * 2 + (x[1] > 0.3) * x[2] + 0.1 * rng.normal())
        fold = -1 if i % 9 == 0 else i % 3
        rows.append((f"c{i}", None if fold < 0 else y, fold, *map(float, x)))
    df = spark.createDataFrame(rows, "card_id string, target double, fold int, a double, b double, c double, d double, e double")
    return oof.vectors(df, list("abcde"))


PARAMS = bo.Params(trees=25, depth=4, leaves=12, rate=0.3, min_rows=5, patience=6)


def test_as_good_as_the_trees_of_the_library(data):
    ours = bo.oof_histogram(data, oof.VECTOR, 3, PARAMS).cache()
    assert ours.count() == 900 and ours.where("pred IS NULL OR isnan(pred)").count() == 0
    theirs = oof.stack_level1(data, {"pred": oof.gbt(maxIter=25, maxDepth=4, stepSize=0.3)}, 3)
    a, b = (oof.rmse(x.where("target IS NOT NULL")).first()["rmse"] for x in (ours, theirs))
    assert a <= b


def plain_tree(bins, gap, rows, p):
    """The first tree, grown row by row over Python lists, as {row: value}."""
    nodes, leaves = {0: list(rows)}, 1
    level = [0]
    score = lambda g, n: bo._score(g, n, p)
    parent = {}
    for _ in range(p.depth):
        found = []
        for i in level:
            g, n = sum(gap[r] for r in nodes[i]), len(nodes[i])
            options = []
            for j in range(bins.shape[1]):
                for cut in range(bo.BINS - 1):
                    left = [r for r in nodes[i] if bins[r, j] <= cut]
                    if p.min_rows <= len(left) <= n - p.min_rows:
                        lg = sum(gap[r] for r in left)
                        gain = (score(lg, len(left)) + score(g - lg, n - len(left)) - score(g, n)) / 2
                        options.append((round(float(gain), 9), -j, -cut))
            if options and max(options)[0] > 0:
                found.append((max(options), i))
        level = []
        for (gain, j, cut), i in sorted(found, key=lambda x: (-x[0][0], x[1]))[: p.leaves - leaves]:
            left = [r for r in nodes[i] if bins[r, -j] <= -cut]
            parent[i] = True
            for part in (left, [r for r in nodes[i] if r not in set(left)]):
                nodes[len(nodes)] = part
                level.append(len(nodes) - 1)
            leaves += 1
    out = {}
    for i, part in nodes.items():
        if i not in parent:
            g = sum(gap[r] for r in part)
            value = -p.rate * float(bo._shrunk(g, p.l1) / (len(part) + p.l2))
            out |= {r: value for r in part}
    return out


def test_first_tree_equals_a_plain_one(spark, data):
    p = bo.Params(trees=1, depth=3, leaves=5, rate=0.5, min_rows=8)
    some = data.where("fold >= 0 AND card_id < 'c3'")
    rows = bo.binned(some, oof.VECTOR)
    base, models = bo.train(rows, 3, p)
    table = rows.toPandas()
    bins = np.array([list(b) for b in table.bins])
    for m in range(3):
        kept = [r for r in range(len(table)) if table.fold[r] != m]
        assert base[m] == pytest.approx(table.target[kept].mean())
        want = plain_tree(bins, base[m] - table.target.to_numpy(), kept, p)
        tree = models[m][0]
        got = tree.values(bins)
        assert sum(f < 0 for f in tree.feature) <= 5
        assert all(got[r] == pytest.approx(v, abs=1e-9) for r, v in want.items())


def test_stops_when_the_held_out_error_rises(spark):
    rng = np.random.default_rng(1)
    rows = [(f"c{i}", float(rng.normal()), i % 2, float(rng.normal())) for i in range(200)]
    df = spark.createDataFrame(rows, "card_id string, target double, fold int, x double")
    data = bo.binned(oof.vectors(df, ["x"]), oof.VECTOR)
    _, models = bo.train(data, 2, bo.Params(trees=40, rate=0.5, min_rows=2, patience=3))
    assert all(len(m) < 20 for m in models)


def test_predictions_written_down_change_nothing(spark, data, monkeypatch):
    p = bo.Params(trees=5, depth=2, rate=0.3, row_share=0.7, feature_share=0.6)
    rows = bo.binned(data, oof.VECTOR)
    a = bo.train(rows, 3, p)
    monkeypatch.setattr(bo, "RECENT", 2)
    b = bo.train(rows, 3, p)
    assert [[t.feature for t in m] for m in a[1]] == [[t.feature for t in m] for m in b[1]]
    assert np.allclose([v for m in a[1] for t in m for v in t.value], [v for m in b[1] for t in m for v in t.value])


def test_gram_ridge_is_the_closed_form_for_all_folds_and_repeats(spark):
    rng = np.random.default_rng(9)
    n, d = 300, 12
    x = rng.normal(size=(n, d)) * 10 ** rng.uniform(-2, 3, d) + 10 ** rng.uniform(0, 7, d)
    x[:, 5] = 2 * x[:, 4]  # columns that depend on each other
    y = (x - x.mean(0)) @ rng.normal(size=d) / 50 + rng.normal(size=n)
    folds = rng.integers(-1, 4, (n, 2))
    rows = [(f"c{i}", float(y[i]), *map(int, folds[i]), *map(float, x[i])) for i in range(n)]
    names = [f"x{j}" for j in range(d)]
    df = spark.createDataFrame(rows, ["card_id", "target", "f0", "f1", *names]).repartition(5)
    data = oof.assembled(df, names, ["f0", "f1"])
    grams = gram.fold_grams(data, oof.VECTOR, ["f0", "f1"])
    for r in range(2):
        for held in range(4):
            for alpha in (0.1, 7.0):
                kept = (folds[:, r] >= 0) & (folds[:, r] != held)
                m, my = x[kept].mean(0), y[kept].mean()
                z = x[kept] - m
                want = np.linalg.solve(z.T @ z + alpha * np.eye(d), z.T @ (y[kept] - my))
                beta, intercept = grams.solve(alpha, held, f"f{r}")
                assert np.allclose((x - m) @ beta, (x - m) @ want, atol=1e-5)
                assert intercept == pytest.approx(my - m @ beta, abs=1e-4)
    model = oof.ridge(data, 7.0, grams, "f1")(2)
    beta, intercept = grams.solve(7.0, 2, "f1")
    got = {r.card_id: r.p for r in model.setPredictionCol("p").transform(data).collect()}
    assert np.allclose([got[f"c{i}"] for i in range(n)], x @ beta + intercept)
    assert encode.TEST_FOLD == -1 and F is not None
