"""The scoring jobs on a small feature table, and a second run into the same folder."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardloom.models import oof
from cardloom.operators import cleaning, profiles
from cardloom.plans import scoring
from cardloom.sources import staging
from cardloom.sources import tpch_cards as X


@pytest.fixture(scope="module")
def features(spark):
    rows = spark.range(240).select(
        F.concat(F.lit("C_"), "id").alias("card_id"),
        F.when(F.col("id") % 6 == 0, None)
        .otherwise((F.col("id") * 37 % 101) / 20 - 2)
        .cast("double")
        .alias("target"),
        *[(F.col("id") * k % 101).cast("double").alias(f"x{k}") for k in (37, 11, 7, 3)],
    )
    return staging.staged(cleaning.flag_outliers(rows), "features")


@pytest.fixture()
def settings(tmp_path):
    return scoring.Settings(
        as_of="2001-09-01",
        out=str(tmp_path / "job"),
        keep=(3, 2),
        folds=3,
        boosting=dict(maxIter=4, maxDepth=3),
        forest=dict(numTrees=5, maxDepth=3),
        network=dict(widths=(4,), epochs=2, slices=1),
    )


def test_fast_path(spark, features, settings):
    out = scoring.fast_scores(features, settings)
    assert out.count() == 240 and out.filter("pred IS NULL OR isnan(pred)").count() == 0
    rmse = staging.stage_read(spark, f"{settings.out}/single-model-rmse")
    known = out.filter("target IS NOT NULL")
    spread = known.agg(F.stddev_pop("target")).first()[0]
    assert rmse.count() == 3 and rmse.first()["mean_rmse"] < spread
    assert oof.rmse(known).first()["rmse"] < spread
    assert spark.read.csv(f"{settings.out}/single-model", header=True).count() == 40

    # A second run reads the finished stages and writes the same scores.
    files = sorted((settings.out, p.name, p.stat().st_mtime) for p in Path(settings.out).glob("s*/part-*.parquet"))
    again = scoring.fast_scores(features, settings)
    assert sorted(again.collect()) == sorted(out.collect())
    assert files == sorted((settings.out, p.name, p.stat().st_mtime) for p in Path(settings.out).glob("s*/part-*.parquet")) != []
    # Other cards, or another number of folds, are scored anew.
    some = features.where("card_id < 'C_2'")
    assert scoring.fast_scores(some, settings).count() == some.count() < 240
    other = scoring.fast_scores(some, replace(settings, folds=2))
    assert other.where("target IS NOT NULL").select("fold").distinct().count() == 2
    assert (staging.finished(spark, f"{settings.out}/selected-fast")) is True
    scoring.clean_up(spark, settings)
    assert not staging.finished(spark, f"{settings.out}/_work")


def test_stacks_have_their_learners(features, settings):
    folds = [scoring.stack(features, 40, settings, f"s{e}", bool(e)) for e in (0, 1)]
    plain, more = (set(f.columns) - {"card_id", "target", "fold"} for f in folds)
    assert more - plain == {"extra"} and len(more) == 8
    for f in folds:
        assert f.count() == 240
        assert f.select(*[F.count(c) for c in more & set(f.columns)]).first()[0] == 240


def test_blend_takes_all_three_learners(features, settings):
    stacks = [
        staging.staged(features.select("card_id", "target", *[(F.col(c) / n).alias(m) for m, c in (("m1", "x37"), ("m2", "x11"))]), "stack")
        for n in (50, 20)
    ]
    first = {r.card_id: r.pred for r in scoring.blend_stacks(stacks, settings).collect()}
    assert len(first) == 240 and all(abs(v) < 100 for v in first.values())
    # The network has most of the weight, so another one, which makes the stage anew, gives another blend.
    other = replace(settings, network=dict(widths=(6,), epochs=4, slices=1, rate=0.05))
    again = {r.card_id: r.pred for r in scoring.blend_stacks(stacks, other).collect()}
    assert sum(abs(again[c] - first[c]) > 1e-6 for c in first) > 200


def stamps(out):
    return {p.name: p.stat().st_mtime for p in Path(out).iterdir() if p.is_dir()}


def test_feature_job_makes_again_only_what_changed(spark, sample, tmp_path):
    """The whole feature job over the sample, then with another day: parts that do not read
    the day are kept, and equal inputs and settings make nothing again."""
    tables = X.train_cards(spark, sample), X.test_cards(spark, sample), X.hist_log(spark, sample), X.new_log(spark, sample)
    settings = scoring.Settings(X.AS_OF, str(tmp_path / "job"), X.HOLIDAYS, X.NEW_HOLIDAYS, X.QUARTER_STARTS)
    made = scoring.build_features(*tables, settings)
    cards = X.cards(spark, sample).count()
    assert {n: df.count() for n, df in made.items()} == dict.fromkeys(made, cards)
    base, amounts = (set(made[n].columns) for n in ("base", "amounts"))
    assert len(amounts) > len(base) > 1000 and "hist_monthlag-6purchase_amount_skew" in base
    assert {f"hist_month{lo}{hi}_amountprice_skew" for lo, hi in scoring.AMOUNT_RANGES} <= amounts - base
    alone = profiles.lag_profile(tables[2], -2, X.AS_OF, X.HOLIDAYS)
    column = "hist_monthlag-2installments_skew"
    assert made["base"].join(alone.select("card_id", F.col(f"`{column}`").alias("x")), "card_id").where(
        f"abs(`{column}` - x) > 1e-9 OR (`{column}` IS NULL) <> (x IS NULL)"
    ).count() == 0

    before = stamps(settings.out)
    scoring.build_features(*tables, settings)
    assert stamps(settings.out) == before
    scoring.build_features(*tables, replace(settings, as_of="2001-10-01"))
    after = stamps(settings.out)
    assert set(before) == set(after)
    again = {n for n in after if after[n] != before[n]}
    assert {"cards", "part-hist", "part-ranges", "base", "amounts"} <= again
    assert not {"hist", "new", "part-quarters", "part-monthly"} & again
