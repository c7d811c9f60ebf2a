"""Joining level-1 stacks, blending and the final score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.models import network
from cardloom.models.gram import fold_grams
from cardloom.models.oof import BOOSTED, LEVEL2_ALPHA, VECTOR, assembled, gbt, ridge, stack_level1, vectors
from cardloom.models.scaling import minmax_scale, model_inputs
from cardloom.operators.cleaning import fill_zero
from cardloom.operators.folds import card_folds
from cardloom.sources.staging import staged

WEIGHTS = {"ridge": 0.3, "nn": 0.6, "lgb": 0.1}
REPEAT_SEED = 10835
REPEATS = 3
MODEL_FOLDS = 6


def stack_join(stacks: Sequence[DataFrame]) -> DataFrame:
    """The stacks side by side on card_id, model columns as ``<model>_<stack>``.
    The target is taken from whichever stack has it."""
    renamed = []
    for i, s in enumerate(stacks):
        models = [c for c in s.columns if c not in ("card_id", "target", "fold")]
        renamed.append(
            s.select(
                "card_id",
                F.col("target").alias(f"__target_{i}"),
                *[F.col(f"`{m}`").alias(f"{m}_{i}") for m in models],
            )
        )
    joined = reduce(lambda a, b: a.join(b, "card_id", "full"), renamed)
    targets = [f"__target_{i}" for i in range(len(stacks))]
    return joined.withColumn("target", F.coalesce(*targets)).drop(*targets)


def model_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("card_id", "target", "fold", "outliers")]


def align_test_predictions(test: DataFrame, stacked: DataFrame) -> DataFrame:
    """Test predictions in the terms of the test cards, matched by id."""
    return test.select("card_id").join(stacked.drop("target", "fold"), "card_id", "left")


def stack_features(stacks: Sequence[DataFrame]) -> DataFrame:
    """card_id, target and all model columns, missing ones 0, scaled to 0..1."""
    joined = stack_join(stacks)
    models = model_columns(joined)
    return minmax_scale(fill_zero(joined, models), models)


def blend(df: DataFrame, weights: Mapping[str, float] = WEIGHTS, name: str = "pred") -> DataFrame:
    return df.withColumn(name, sum((F.col(m) * w for m, w in weights.items()), F.lit(0.0)))


def repeat_average(frames: Sequence[DataFrame], column: str = "pred") -> DataFrame:
    """Mean over repeated runs, per card."""
    union = reduce(DataFrame.unionByName, [f.select("card_id", "target", column) for f in frames])
    return union.groupBy("card_id").agg(
        F.max("target").alias("target"), F.avg(column).alias(column)
    )


def level2(
    stacked: DataFrame,
    weights: Mapping[str, float],
    repeats: int = REPEATS,
    k: int = MODEL_FOLDS,
    net: network.Params = network.Params(widths=network.LEVEL2_WIDTHS, patience=18),
    **boosting,
) -> DataFrame:
    """Ridge, a network and boosted trees over the stacked predictions, blended, averaged
    over reshuffled folds. ``weights`` names those of 'ridge', 'nn' and 'lgb' that take part."""
    features = model_columns(stacked)
    named = [f"fold_{r}" for r in range(repeats)]
    for r, name in enumerate(named):
        folds = card_folds(stacked, k, REPEAT_SEED + r)
        stacked = stacked.join(folds.select("card_id", F.col("fold").alias(name)), "card_id")
    data = staged(assembled(stacked, features, named), "vectors")
    # Every repeat and fold of the ridge comes from this one pass.
    grams = fold_grams(data, VECTOR, named) if "ridge" in weights else None
    frames = []
    for name in named:
        rows = data.withColumn("fold", F.col(name)).drop(*named)
        learners = {"lgb": gbt(**(BOOSTED["lgb"] | dict(maxDepth=3) | boosting))}
        if grams is not None:
            learners["ridge"] = ridge(data, LEVEL2_ALPHA, grams, name)
        frame = stack_level1(rows, {m: learners[m] for m in weights if m != "nn"}, k)
        if "nn" in weights:
            found = network.oof_network(rows, VECTOR, k, net)
            frame = frame.join(found.select("card_id", "nn"), "card_id")
        frames.append(blend(frame, weights))
    return repeat_average(frames)


def score_single(
    selected: DataFrame, features: Sequence[str], k: int = MODEL_FOLDS, seed: int = 120, **boosting
) -> tuple[DataFrame, DataFrame]:
    """The fast path: one boosted model. Returns the out-of-fold table and
    card_id, target with the test cards' scores."""
    folds = card_folds(selected, k, seed).select("card_id", "fold")
    data = vectors(model_inputs(selected, features).join(folds, "card_id"), features)
    oof = stack_level1(data, {"pred": gbt(**(BOOSTED["lgb2"] | boosting))}, k)
    scores = oof.filter(F.col("target").isNull()).select("card_id", F.col("pred").alias("target"))
    return oof, scores
