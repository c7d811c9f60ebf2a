"""Ridge from Gram statistics: sums of products of all columns, by fold.

One pass over the rows gives X'X, X'y and the counts of every fold, for any number of fold
columns at once. The statistics of a training set are the total less those of the fold
held out, so every fold, penalty and repeat after that is a small linear solve. Tasks
add up their rows as matrices; the sums are shuffled by matrix row and added there. Only
folds x features^2 numbers come to the driver.

Products are of distances from a pivot near the means, so columns with a large offset keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows whose mean is the pivot; it changes rounding, not results.
PIVOT_ROWS = 1_000
SUMS = "which int, fold int, line int, sums array<double>"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy().reshape(len(x), -1)


def _task_sums(folds: Sequence[str], pivot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            rows = np.column_stack([_matrix(batch), batch.column("target").to_numpy()]) - pivot
            rows = np.column_stack([np.ones(len(rows)), rows])
            for which, name in enumerate(folds):
                fold = batch.column(name).to_numpy()
                for f in np.unique(fold[fold >= 0]):
                    part = rows[fold == f]
                    key = which, int(f)
                    total[key] = total.get(key, 0) + part.T @ part
        for (which, fold), sums in total.items():
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([which] * n, pa.int32()),
                    pa.array([fold] * n, pa.int32()),
                    pa.array(np.arange(n, dtype=np.int32)),
                    pa.array(list(sums), pa.list_(pa.float64())),
                ],
                ["which", "fold", "line", "sums"],
            )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int, int], np.ndarray] = {}
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("which", "fold", "line")))
        for key, sums in zip(keys, batch.column("sums")):
            total[key] = total.get(key, 0) + sums.values.to_numpy()
    if total:
        which, fold, line = zip(*total)
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(c, pa.int32()) for c in (which, fold, line)),
                pa.array(list(total.values()), pa.list_(pa.float64())),
            ],
            ["which", "fold", "line", "sums"],
        )


@dataclass(frozen=True)
class Grams:
    """Per fold column and fold the sums of products of (1, x - pivot, y - pivot)."""

    pivot: np.ndarray
    sums: dict[str, dict[int, np.ndarray]]

    def solve(self, alpha: float, held: int | None, fold: str = "fold") -> tuple[np.ndarray, float]:
        """Coefficients and intercept (free of penalty) fitted on all folds but ``held``."""
        kept = [s for f, s in self.sums[fold].items() if f != held]
        if not kept:
            raise ValueError(f"no rows to fit outside fold {held}")
        t = sum(kept)
        n, sx, sy = t[0, 0], t[0, 1:-1], t[0, -1]
        xx = t[1:-1, 1:-1] - np.outer(sx, sx) / n
        xy = t[1:-1, -1] - sx * sy / n
        # With a small penalty the columns may depend on each other; the shortest solution then.
        beta = np.linalg.lstsq(xx + alpha * np.eye(len(xy)), xy, rcond=None)[0]
        return beta, float(sy / n + self.pivot[-1] - beta @ (sx / n + self.pivot[:-1]))

    def model(self, spark, alpha: float, held: int | None, fold: str = "fold") -> LinearRegressionModel:
        """As a fitted model, whose predictions stay in the JVM."""
        beta, intercept = self.solve(alpha, held, fold)
        values = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, len(beta))
        for i, b in enumerate(beta):
            values[i] = float(b)
        vector = spark.sparkContext._jvm.org.apache.spark.ml.linalg.Vectors.dense(values)
        made = spark.sparkContext._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
            f"gramRidge_{fold}_{held}", vector, intercept
        )
        return LinearRegressionModel(made)


def fold_grams(data: DataFrame, vector: str, folds: Sequence[str] = ("fold",)) -> Grams:
    """From rows with a vector column, ``target`` and fold columns. Rows without a target, and
    per fold column those with a negative fold, are left out; values must be finite. The rows are
    read twice, so what takes joins or shuffles to make should be a stage."""
    rows = data.where("target IS NOT NULL").select(
        *folds, F.col("target").cast("double").alias("target"), vector_to_array(vector).alias("x")
    )
    first = rows.limit(PIVOT_ROWS).toArrow()
    if not first.num_rows:
        raise ValueError("no row has a target")
    x = first.column("x").combine_chunks().flatten().to_numpy().reshape(first.num_rows, -1)
    pivot = np.append(x.mean(axis=0), first.column("target").to_numpy().mean())
    found = (
        rows.mapInArrow(_task_sums(folds, pivot), SUMS)
        .repartition("which", "fold", "line")
        .mapInArrow(_added, SUMS)
        .collect()
    )
    sums: dict[str, dict[int, np.ndarray]] = {name: {} for name in folds}
    for r in found:
        made = sums[folds[r["which"]]].setdefault(r["fold"], np.zeros((len(pivot) + 1,) * 2))
        made[r["line"]] = r["sums"]
    return Grams(pivot, sums)
