import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.models import boosting, oof
from cardloom.models import ordered as od


def place(card, seed=0):
    return int(hashlib.md5(f"{card}:{seed}".encode()).hexdigest()[:8], 16)


def level(card, prefixes=od.PREFIXES, seed=0):
    return sum(place(card, seed) >= 1 << (32 - prefixes + j) for j in range(1, prefixes))


@pytest.fixture(scope="module")
def cards(spark):
    rng = np.random.default_rng(5)
    effect = {f"k{i}": float(rng.normal() * 2) for i in range(40)}
    rows = []
    for i in range(900):
        a, b = map(float, rng.normal(size=2))
        kind = None if i % 31 == 0 else "k0" if i % 3 == 0 else f"k{int(rng.integers(40))}"
        y = effect.get(kind, 0.0) + (a > 0.2) * b + 0.2 * float(rng.normal())
        fold = -1 if i % 9 == 0 else i % 4
        rows.append((f"c{i}", None if fold < 0 else y, fold, a, b, kind))
    return spark.createDataFrame(
        rows, "card_id string, target double, fold int, a double, b double, kind string"
    ).repartition(4).cache()


def test_levels_double(spark):
    df = spark.range(4000).select(F.concat(F.lit("c"), "id").alias("card_id"))
    found = {r[0]: r[1] for r in df.select("card_id", od.level_of(F.col("card_id"))).collect()}
    assert all(found[c] == level(c) for c in found)
    sizes = np.bincount(list(found.values()), minlength=od.PREFIXES)
    assert len(sizes) == od.PREFIXES and 1800 < sizes[-1] < 2200 and 900 < sizes[-2] < 1100


def test_statistics_equal_plain_sums_without_the_own_target(cards):
    k = 4
    got = {r.card_id: r for r in od.ordered_statistics(cards, ["kind"], k).collect()}
    rows = cards.collect()
    assert len(got) == len(rows)
    for r in rows:
        own = level(r.card_id)
        assert got[r.card_id]["__level"] == own
        for m in range(k):
            outside = r.target is None or r.fold == m
            top = od.PREFIXES if outside else own
            told = [x for x in rows if x.target is not None and x.fold != m and level(x.card_id) < top]
            above = [x for x in rows if x.target is not None and x.fold != m and level(x.card_id) > 0]
            prior = np.mean([x.target for x in (told if top else above)])
            mine = [x.target for x in told if x.kind == r.kind]
            assert r.card_id not in {x.card_id for x in told}
            want = (sum(mine) + od.CENTER * prior) / (len(mine) + od.CENTER)
            assert got[r.card_id]["kind_ts"][m] == pytest.approx(want)


def test_own_target_changes_nothing_a_card_is_told(cards):
    moved = cards.withColumn("target", F.when(F.col("card_id") == "c10", F.lit(1e6)).otherwise(F.col("target")))
    a, b = ({r.card_id: r.kind_ts for r in od.ordered_statistics(x, ["kind"], 4).collect()} for x in (cards, moved))
    assert a["c10"] == pytest.approx(b["c10"])
    assert any(a[c] != pytest.approx(b[c]) for c in a)
    fold = cards.where("card_id = 'c10'").first()["fold"]
    # The model of its fold is told nothing of it, whichever card asks.
    assert all(a[c][fold] == pytest.approx(b[c][fold]) for c in a)


def inputs(df):
    return oof.assembled(df, ["a", "b"]).join(df.select("card_id", "kind"), "card_id")


def test_first_tree_equals_a_plain_one(cards):
    p = od.Params(trees=1, depth=2, rate=0.5, prefixes=5)
    rows = od.binned(inputs(cards), oof.VECTOR, ["kind"], 4, p)
    base = od.first_values(rows, 4, p.prefixes)
    _, models = od.train(rows, 4, 1, p)
    table = rows.where("target IS NOT NULL").toPandas()
    bins = np.array([list(b) for b in table.bins])
    y, lv = table.target.to_numpy(), table.level.to_numpy()
    for m in range(4):
        kept = np.flatnonzero(table.fold.to_numpy() != m)
        gap = base[m, lv[kept]] - y[kept]
        nodes = [np.arange(len(kept))]
        cuts = []
        for _ in range(p.depth):
            options = []
            for j in (0, 1, 2 + m):
                for cut in range(boosting.BINS - 1):
                    gain = 0.0
                    right = bins[kept, j] > cut
                    if right.all() or not right.any():
                        continue
                    for part in nodes:
                        for side, sign in ((part, -1), (part[right[part]], 1), (part[~right[part]], 1)):
                            gain += sign * gap[side].sum() ** 2 / (len(side) + p.l2)
                    options.append((round(gain, 8), -j, -cut))
            _, j, cut = max(options)
            cuts.append((-j, -cut))
            right = bins[kept, -j] > -cut
            nodes = [x for part in nodes for x in (part[~right[part]], part[right[part]])]
        if not models[m]:
            continue  # one tree did not help the held-out fold
        tree = models[m][0]
        assert tree.cuts == cuts
        for v in range(1, p.prefixes + 1):
            for leaf, part in enumerate(nodes):
                seen = kept[part][lv[kept][part] < v]
                g = (base[m, v] - y[seen]).sum()
                assert tree.values[v, leaf] == pytest.approx(-p.rate * g / (len(seen) + p.l2))
        assert (tree.values[0] == 0).all()
    assert any(models)


def test_better_than_boosting_that_cannot_read_the_category(cards, monkeypatch):
    p = od.Params(trees=8, depth=3, rate=0.4, patience=6)
    data = inputs(cards)
    ours = od.oof_ordered(data, oof.VECTOR, ["kind"], 4, p).cache()
    assert ours.count() == 900 and ours.where("pred IS NULL OR isnan(pred)").count() == 0
    plain = boosting.oof_histogram(data, oof.VECTOR, 4, boosting.Params(trees=8, depth=3, rate=0.4, min_rows=5))
    a, b = (oof.rmse(x.where("target IS NOT NULL")).first()["rmse"] for x in (ours, plain))
    assert a < 0.8 * b
    monkeypatch.setattr(od, "RECENT", 3)
    monkeypatch.setattr(od, "CELLS", 1 << 10)  # features in several passes
    again = od.oof_ordered(data, oof.VECTOR, ["kind"], 4, p).withColumnRenamed("pred", "again")
    gap = ours.join(again, "card_id").agg(F.max(F.abs(F.col("pred") - F.col("again"))).alias("gap")).first()["gap"]
    assert gap < 1e-9


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "card_id string, target double, fold int, a double, kind string")
    data = oof.assembled(empty, ["a"]).join(empty.select("card_id", "kind"), "card_id")
    assert od.oof_ordered(data, oof.VECTOR, ["kind"], 3).count() == 0
    same = spark.createDataFrame(
        [(f"c{i}", None if i < 3 else 2.5, -1 if i < 3 else i % 2, 1.0, None) for i in range(40)],
        "card_id string, target double, fold int, a double, kind string",
    )
    data = oof.assembled(same, ["a"]).join(same.select("card_id", "kind"), "card_id")
    out = od.oof_ordered(data, oof.VECTOR, ["kind"], 2, od.Params(trees=3)).collect()
    assert len(out) == 40 and all(r.pred == pytest.approx(2.5) for r in out)


def test_rows_look_statistics_up(spark, cards):
    told = od.ordered_statistics(cards, ["kind"], 4)
    # No loop over a category's sums for every row and model.
    assert "lambda" not in told._jdf.queryExecution().optimizedPlan().toString()
    # A category of no train card is told the priors.
    extra = spark.createDataFrame([("new", None, -1, 0.0, 0.0, "unseen")], cards.schema)
    got = od.ordered_statistics(cards.unionByName(extra), ["kind"], 4).where("card_id = 'new'").first()
    known = [r for r in cards.collect() if r.target is not None]
    for m in range(4):
        assert got.kind_ts[m] == pytest.approx(np.mean([r.target for r in known if r.fold != m]))
