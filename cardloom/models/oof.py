"""Out-of-fold training. Input tables hold card_id, target, fold and features;
train cards have a fold from 0, test cards fold -1 and no target."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml.base import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.models.gram import Grams, fold_grams
from cardloom.operators.cleaning import nan_pred_to_zero
from cardloom.operators.encode import TEST_FOLD
from cardloom.sources.staging import staged

VECTOR = "__features"
HELD = "__held"
# An estimator, or an estimator or finished model per fold.
Learner = Estimator | Callable[[int], Estimator | Model]

# Model slots as (depth, trees, step, row share, column share). The boosted
# slots differ in depth, step and sampling.
BOOSTED = {
    "xgb": dict(maxDepth=8, maxIter=100, stepSize=0.02, subsamplingRate=0.8, featureSubsetStrategy="0.1"),
    "lgb": dict(maxDepth=5, maxIter=100, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8"),
    "lgb2": dict(maxDepth=7, maxIter=100, stepSize=0.05, subsamplingRate=0.9855, featureSubsetStrategy="0.5665"),
    "cat": dict(maxDepth=10, maxIter=70, stepSize=0.025, subsamplingRate=1.0, featureSubsetStrategy="all"),
}
FOREST = dict(numTrees=500, maxDepth=6, subsamplingRate=0.623, featureSubsetStrategy="0.5")
LEVEL1_ALPHA = 0.1
LEVEL2_ALPHA = 1.0


def assembled(df: DataFrame, features: Sequence[str], folds: Sequence[str] = ("fold",)) -> DataFrame:
    """card_id, target, the fold columns and one feature vector."""
    named = df.selectExpr(
        "card_id", "target", *folds, *[f"cast(`{f}` AS double) AS `{f}`" for f in features]
    )
    made = VectorAssembler(inputCols=list(features), outputCol=VECTOR).transform(named)
    return made.select("card_id", "target", *folds, VECTOR)


def vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Staged card_id, target, fold and one feature vector, laid out by fold so a
    fold is read without scanning the others."""
    # By fold and some of the rows, so that a fold is a few files and not one per task.
    rows = assembled(df, features)
    rows = rows.repartition("fold", F.pmod(F.xxhash64("card_id"), F.lit(8)))
    return staged(rows, "vectors", partition_by=["fold"])


def gbt(seed: int = 459, **params) -> Estimator:
    """Boosted trees that watch the held-out fold and stop when it gets worse."""
    return GBTRegressor(
        featuresCol=VECTOR,
        labelCol="target",
        seed=seed,
        validationIndicatorCol=HELD,
        **params,
    )


def forest(seed: int = 131, **params) -> Estimator:
    return RandomForestRegressor(
        featuresCol=VECTOR, labelCol="target", seed=seed, **(FOREST | params)
    )


def ridge(
    data: DataFrame, alpha: float, grams: Grams | None = None, fold: str = "fold"
) -> Callable[[int], Model]:
    """Ridge per fold, from Gram statistics of all folds: one pass over the rows, or none where
    ``grams`` of an earlier one are given. The penalty is on the plain coefficients."""
    grams = grams or fold_grams(data, VECTOR, (fold,))
    return lambda held: grams.model(data.sparkSession, alpha, held, fold).setFeaturesCol(VECTOR)


def _fit(learner: Learner, data: DataFrame, fold: int) -> Model:
    estimator = learner if isinstance(learner, Estimator) else learner(fold)
    if isinstance(estimator, Model):
        return estimator
    train = data.filter(F.col("fold") != TEST_FOLD)
    if estimator.hasParam("validationIndicatorCol") and estimator.isSet("validationIndicatorCol"):
        return estimator.fit(train.withColumn(HELD, F.col("fold") == fold))
    return estimator.fit(train.filter(F.col("fold") != fold))


def _predict(model: Model, df: DataFrame, name: str) -> DataFrame:
    return nan_pred_to_zero(model.setPredictionCol(name).transform(df), name)


def stack_level1(data: DataFrame, learners: Mapping[str, Learner], k: int) -> DataFrame:
    """card_id, target, fold and one prediction column per learner, from staged
    `vectors`. Each train card is predicted by the models that never saw its
    fold; a test card gets the average over the folds. All models run over the
    same rows, so no predictions have to be joined."""
    parts = []
    test = data.filter(F.col("fold") == TEST_FOLD)
    for fold in range(k):
        part = data.filter(F.col("fold") == fold)
        for name, learner in learners.items():
            model = _fit(learner, data, fold)
            part = _predict(model, part, name)
            test = _predict(model, test, f"__{name}_{fold}")
        parts.append(part)
    averages = {
        name: sum((F.col(f"__{name}_{f}") for f in range(k)), F.lit(0.0)) / k for name in learners
    }
    parts.append(test.withColumns(averages))
    columns = ["card_id", "target", "fold", *learners]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def oof_predict(df: DataFrame, features: Sequence[str], learner: Learner, k: int, name: str = "pred") -> DataFrame:
    return stack_level1(vectors(df, features), {name: learner}, k)


def oof_gbt(df: DataFrame, features: Sequence[str], k: int = 6, name: str = "pred", **params) -> DataFrame:
    return oof_predict(df, features, gbt(**(BOOSTED["lgb"] | params)), k, name)


def oof_forest(df: DataFrame, features: Sequence[str], k: int = 6, name: str = "pred", **params) -> DataFrame:
    return oof_predict(df, features, forest(**params), k, name)


def oof_ridge(
    df: DataFrame, features: Sequence[str], alpha: float = LEVEL1_ALPHA, k: int = 6, name: str = "pred"
) -> DataFrame:
    data = vectors(df, features)
    return stack_level1(data, {name: ridge(data, alpha)}, k)


def rmse(df: DataFrame, y: str = "target", p: str = "pred") -> DataFrame:
    """One row; cards without a target do not count."""
    return df.agg(F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), F.lit(2)))).alias("rmse"))


def fold_rmse(df: DataFrame, y: str = "target", p: str = "pred") -> DataFrame:
    """Per fold, with the mean over the folds beside it."""
    per_fold = (
        df.filter(F.col(y).isNotNull())
        .groupBy("fold")
        .agg(F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), F.lit(2)))).alias("rmse"))
    )
    return per_fold.withColumn("mean_rmse", per_fold.agg(F.avg("rmse")).scalar())
