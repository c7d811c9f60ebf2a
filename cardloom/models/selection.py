"""Choosing features by the importance boosted trees give them."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.models.oof import VECTOR, _fit, gbt, vectors
from cardloom.models.scaling import model_inputs
from cardloom.operators.columns import feature_names
from cardloom.operators.encode import TEST_FOLD
from cardloom.sources.staging import staged

KEEP = (1000, 500, 300)
SELECTION_SEED = 120
SELECTION_FOLDS = (0, 1)
# Models fitted at the same time; each keeps its rows in the executors' storage memory or on their disks.
FITS = 2
IMPORTANCE = pa.schema([("feature", pa.string()), ("fold", pa.int32()), ("share", pa.float64())])


def feature_importance(
    data: DataFrame, features: Sequence[str], estimator: Estimator, fold: int
) -> DataFrame:
    """feature, fold, importance: log1p of the share of the gain, one row per
    feature, from the model that leaves ``fold`` out."""
    model = _fit(estimator, data, fold)
    shares = model.featureImportances.toArray()
    rows = [{"feature": f, "fold": fold, "share": float(s)} for f, s in zip(features, shares)]
    # From Arrow the few rows are a local table; as a list they would start Python workers.
    df = data.sparkSession.createDataFrame(pa.Table.from_pylist(rows, IMPORTANCE))
    return df.select("feature", "fold", F.log1p("share").alias("importance"))


def concat_columns(importances: Sequence[DataFrame]) -> DataFrame:
    """The importances of the folds side by side, ``importance<fold>``."""
    out = None
    for i, df in enumerate(importances):
        side = df.select("feature", F.col("importance").alias(f"importance{i}"))
        out = side if out is None else out.join(side, "feature")
    return out


def top_k_features(importances: DataFrame, k: int) -> DataFrame:
    """The k features with the largest importance over the folds; a tie goes by
    name."""
    return (
        importances.groupBy("feature")
        .agg(F.sum("importance").alias("feature_sum"))
        .orderBy(F.desc("feature_sum"), "feature")
        .limit(k)
    )


def sliced(data: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Staged ``vectors`` of the features at these positions, in this order. The rows stay
    where they lie, so nothing is shuffled."""
    slicer = VectorSlicer(inputCol="__all", outputCol=VECTOR, indices=list(positions))
    rows = slicer.transform(data.withColumnRenamed(VECTOR, "__all"))
    return staged(rows.select(*data.columns), "vectors", partition_by=["fold"])


def select_by_importance(
    df: DataFrame,
    keep: Sequence[int] = KEEP,
    folds: Sequence[int] = SELECTION_FOLDS,
    estimator: Estimator | None = None,
) -> DataFrame:
    """Keep the best features, in passes of falling size. ``df`` has card_id,
    outliers, target, fold and the features. The rows are laid out once, for the first
    pass; a later one cuts its vectors out of those of the pass before. The models of a
    pass are fitted at the same time, at most ``FITS`` of them."""
    features = [f for f in feature_names(df) if f != "fold"]
    estimator = estimator or gbt(maxDepth=7, maxIter=100, stepSize=0.05)
    # A model is fitted on train cards only.
    data = vectors(model_inputs(df, features).filter(F.col("fold") != TEST_FOLD), features)
    with ThreadPool(max(1, min(FITS, len(folds)))) as pool:
        for i, size in enumerate(keep):

            @inheritable_thread_target(df.sparkSession)
            def importance(fold: int) -> DataFrame:
                own = estimator.copy() if isinstance(estimator, Estimator) else estimator
                return feature_importance(data, features, own, fold)

            per_fold = pool.map(importance, folds)
            ranked = per_fold[0]
            for other in per_fold[1:]:
                ranked = ranked.unionByName(other)
            best = [r["feature"] for r in top_k_features(ranked, size).collect()]
            if i + 1 < len(keep):
                data = sliced(data, [features.index(f) for f in best])
            features = best
    return df.select("card_id", "outliers", "target", *[f"`{f}`" for f in features])
