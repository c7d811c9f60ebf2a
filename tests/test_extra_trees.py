import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.models import extra_trees as et
from cardloom.models import oof


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(800):
        x = rng.normal(size=5)
        y = float(2 * x[0] + (x[1] > 0) * 1.5 + 0.3 * rng.normal())
        x[4] = np.nan if i % 4 else x[4]
        fold = -1 if i % 8 == 0 else i % 3
        rows.append((f"c{i}", None if fold < 0 else y, fold, [float(v) for v in x]))
    df = spark.createDataFrame(rows, "card_id string, target double, fold int, x array<double>").repartition(5)
    return df.cache()


def plain(x, y, kept, t, p):
    """A tree grown over plain rows: node -> (feature, cut) and leaf -> mean."""
    cuts, means, nodes, level = {}, {0: y[kept].mean()}, {0: kept}, [0]
    for _ in range(p.depth):
        following = []
        for node in level:
            rows, best = nodes[node], (1e-9, 0, None, None)
            s = y[rows] - y[kept].mean()
            features = et.candidates(p, t, node, x.shape[1])
            with np.errstate(all="ignore"):
                low = np.array([np.fmin.reduce(x[rows, j]) for j in features])
                high = np.array([np.fmax.reduce(x[rows, j]) for j in features])
            for j, cut in zip(features, et.thresholds(p, t, node, low, high)):
                right = x[rows, j] > cut
                if min(right.sum(), (~right).sum()) >= p.min_rows:
                    gain = s[right].sum() ** 2 / right.sum() + s[~right].sum() ** 2 / (~right).sum() - s.sum() ** 2 / len(s)
                    assert low[list(features).index(j)] <= cut < high[list(features).index(j)]
                    best = max(best, (gain, -int(j), float(cut), right), key=lambda b: (round(b[0], 8), b[1]))
            if best[3] is None:
                continue
            cuts[node] = -best[1], best[2]
            means.pop(node)
            for part in (rows[~best[3]], rows[best[3]]):
                new = 1 + 2 * len(cuts) - 2 + len(following) % 2
                nodes[new], means[new] = part, y[part].mean()
                following.append(new)
        level = following
    return cuts, means


def test_trees_equal_plain_ones(data):
    p = et.Params(trees=3, depth=4, feature_share=0.6, min_rows=6)
    models = et.train(data, 3, p)
    table = data.where("target IS NOT NULL").toPandas()
    x, y, fold = np.array(table.x.tolist(), float), table.target.to_numpy(), table.fold.to_numpy()
    for m in range(3):
        assert len(models[m]) == 3
        kept = np.flatnonzero(fold != m)
        for i, tree in enumerate(models[m]):
            cuts, means = plain(x, y, kept, i * 3 + m, p)
            assert cuts and {n: (f, c) for n, (f, c) in enumerate(zip(tree.feature, tree.cut)) if f >= 0} == cuts
            assert {n: v for n, v in enumerate(tree.value) if tree.feature[n] < 0} == pytest.approx(means)


def test_blocks_change_nothing(data, monkeypatch):
    p = et.Params(trees=4, depth=3, min_rows=5)
    a = et.train(data, 3, p)
    monkeypatch.setattr(et, "CELLS", 40)
    b = et.train(data, 3, p)
    assert [[(t.feature, t.cut) for t in m] for m in a] == [[(t.feature, t.cut) for t in m] for m in b]


def test_beside_the_forest_of_the_library(spark, data):
    names = list("abcd")
    df = data.select("card_id", "target", "fold", *[F.col("x")[i].alias(c) for i, c in enumerate(names)])
    vectors = oof.vectors(df, names)
    # Random cuts are coarser, so they need more depth than the best ones for the same error.
    p = et.Params(trees=30, depth=10, feature_share=1.0, min_rows=2)
    ours = et.oof_extra(vectors, oof.VECTOR, 3, p).cache()
    assert ours.count() == 800 and ours.where("pred IS NULL OR isnan(pred)").count() == 0
    forest = oof.forest(numTrees=30, maxDepth=6, subsamplingRate=1.0)
    theirs = oof.stack_level1(vectors, {"pred": forest}, 3)
    a, b = (oof.rmse(x.where("target IS NOT NULL")).first()["rmse"] for x in (ours, theirs))
    assert a < 1.15 * b, (a, b)
    low, high = df.agg(F.min("target"), F.max("target")).first()
    assert ours.where(~F.col("pred").between(low, high)).count() == 0


def test_nothing_to_cut(spark):
    schema = "card_id string, target double, fold int, x array<double>"
    empty = spark.createDataFrame([], schema)
    assert et.predict(empty, et.train(empty, 2)).count() == 0
    nan = float("nan")
    same = [(f"c{i}", None if i < 4 else 1.5, -1 if i < 4 else i % 2, [3.0, nan]) for i in range(60)]
    rows = spark.createDataFrame(same, schema)
    models = et.train(rows, 2, et.Params(trees=2))
    assert all(t.feature == [-1] for m in models for t in m)
    assert {r.pred for r in et.predict(rows, models).collect()} == {1.5}
