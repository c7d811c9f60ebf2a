import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.models import blend as bl
from cardloom.models import network as nw
from cardloom.models import oof

SMALL = nw.Params(widths=(12, 6), epochs=25, slices=2, rate=0.03, patience=10)


def test_gradient_is_the_numerical_one():
    rng = np.random.default_rng(4)
    form = nw.shapes(3, nw.Params(widths=(5, 4, 3)))
    flat = nw.first_weights(form, (1, 2)) + rng.normal(size=sum(int(np.prod(s)) for s in form)) * 0.3
    x, y = rng.normal(size=(11, 3)), rng.normal(size=11)
    loss = lambda w: ((nw.forward(x, nw.unpack(w, form))[0] - y) ** 2).sum() / 2
    got = nw.gradient(x, y, nw.unpack(flat, form))
    for i in range(len(flat)):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        assert got[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, rel=1e-4, abs=1e-6)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(600):
        a, b, c = map(float, rng.normal(size=3))
        y = 3 * abs(a) + b + 0.1 * float(rng.normal()) + 7
        fold = -1 if i % 10 == 0 else i % 3
        rows.append((f"c{i}", None if fold < 0 else y, fold, 1000 + 50 * a, b, c))
    df = spark.createDataFrame(rows, "card_id string, target double, fold int, a double, b double, c double")
    return oof.vectors(df.repartition(4), ["a", "b", "c"])


def test_summed_gradients_equal_one_task(data):
    rows = nw.prepared(data, oof.VECTOR, SMALL).where("slice = 1").cache()
    form = nw.shapes(3, SMALL)
    nets = {m: nw.first_weights(form, (1, m)) + 0.1 for m in range(3)}
    scale = nw.scale_of(rows, 3)
    table = rows.toPandas()
    x = (np.array(table.x.tolist()) - scale.x_mean) / scale.x_std
    y = (table.target.to_numpy() - scale.y_mean) / scale.y_std
    got = nw._step(rows, nets, form, scale)
    for m in range(3):
        kept = table.fold.to_numpy() != m
        want = nw.gradient(x[kept], y[kept], nw.unpack(nets[m], form)) / kept.sum()
        assert np.allclose(got[m], want)


def test_learns_what_a_line_cannot_and_blends(data):
    out = nw.oof_network(data, oof.VECTOR, 3, SMALL).cache()
    assert out.count() == 600 and out.where("nn IS NULL OR isnan(nn)").count() == 0
    line = oof.stack_level1(data, {"ridge": oof.ridge(data, 0.1), "lgb": oof.gbt(maxIter=3, maxDepth=3)}, 3)
    both = out.join(line.select("card_id", "ridge", "lgb"), "card_id")
    known = both.where("target IS NOT NULL")
    net, ridge = (oof.rmse(known, p=c).first()["rmse"] for c in ("nn", "ridge"))
    assert net < 0.6 * ridge
    blended = bl.blend(both)
    gap = F.abs(F.col("pred") - (0.3 * F.col("ridge") + 0.6 * F.col("nn") + 0.1 * F.col("lgb")))
    assert blended.agg(F.max(gap)).first()[0] < 1e-9
    assert oof.rmse(blended.where("target IS NOT NULL")).first()["rmse"] < ridge


def test_nothing_to_learn_from(spark):
    schema = "card_id string, target double, fold int, a double"
    p = nw.Params(widths=(2,), epochs=2, slices=2)
    unknown = spark.createDataFrame([("t", None, -1, 1.0)], schema)
    assert [r.nn for r in nw.oof_network(oof.vectors(unknown, ["a"]), oof.VECTOR, 2, p).collect()] == [None]
    same = spark.createDataFrame([(f"c{i}", 2.0, i % 2, 1.0) for i in range(20)] + [("t", None, -1, 1.0)], schema)
    out = nw.oof_network(oof.vectors(same, ["a"]), oof.VECTOR, 2, p).collect()
    assert len(out) == 21 and all(abs(r.nn - 2.0) < 0.2 for r in out)
