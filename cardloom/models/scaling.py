"""Inputs for the regressors: infinities, gaps and scales, fitted on train cards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INF = float("inf")
IS_TRAIN = "target IS NOT NULL"


def column_stats(
    df: DataFrame, features: Sequence[str], aggregates: Mapping[str, str]
) -> dict[str, dict[str, float]]:
    """One row of statistics per feature. ``aggregates`` are SQL texts over {c}.

    The features are turned into rows and grouped by their position, so a
    thousand of them need no more generated code than one, and each task ships
    one partial result per feature.
    """
    values = ", ".join(f"cast(`{f}` AS double)" for f in features)
    exprs = [F.expr(sql.replace("{c}", "v") + f" AS {name}") for name, sql in aggregates.items()]
    found = (
        df.selectExpr(f"posexplode(array({values})) AS (ix, v)").groupBy("ix").agg(*exprs).collect()
    )
    by_position = {r["ix"]: r for r in found}
    empty = dict.fromkeys(aggregates)
    return {
        f: by_position[i].asDict() if i in by_position else empty for i, f in enumerate(features)
    }


def _replace(df: DataFrame, new: Mapping[str, str]) -> DataFrame:
    """Columns by SQL text over {c}, the double value of the old column."""
    return df.selectExpr(
        *[
            f"{new[c].replace('{c}', f'cast(`{c}` AS double)')} AS `{c}`" if c in new else f"`{c}`"
            for c in df.columns
        ]
    )


def replace_infinite(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Train infinities become one beyond the finite range; those of the test
    cards become the end of the train range as it is then."""
    finite = "CASE WHEN abs({c}) < double('inf') THEN {c} END"
    stats = column_stats(
        df.filter(IS_TRAIN),
        features,
        {
            "hi": f"max({finite})",
            "lo": f"min({finite})",
            "has_hi": "max(CASE WHEN {c} = double('inf') THEN 1 ELSE 0 END)",
            "has_lo": "max(CASE WHEN {c} = double('-inf') THEN 1 ELSE 0 END)",
        },
    )
    new = {}
    for f, s in stats.items():
        hi, lo = s["hi"], s["lo"]
        if hi is None:
            # No finite value to lean on.
            new[f] = finite
            continue
        test_hi, test_lo = hi + s["has_hi"], lo - s["has_lo"]
        new[f] = (
            f"CASE WHEN {{c}} = double('inf') THEN if({IS_TRAIN}, {hi + 1.0!r}D, {float(test_hi)!r}D)"
            f" WHEN {{c}} = double('-inf') THEN if({IS_TRAIN}, {lo - 1.0!r}D, {float(test_lo)!r}D)"
            " ELSE {c} END"
        )
    return _replace(df, new)


def impute_train_mean(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """NULL becomes the mean of the train cards; a column without any train value
    stays as it is."""
    stats = column_stats(df.filter(IS_TRAIN), features, {"mean": "avg({c})"})
    return _replace(
        df,
        {f: f"coalesce({{c}}, {s['mean']!r}D)" for f, s in stats.items() if s["mean"] is not None},
    )


def minmax_scale(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """To 0..1 by the range of the train cards; a constant column is only shifted."""
    stats = column_stats(df.filter(IS_TRAIN), features, {"lo": "min({c})", "hi": "max({c})"})
    new = {}
    for f, s in stats.items():
        if s["lo"] is not None:
            width = (s["hi"] - s["lo"]) or 1.0
            new[f] = f"({{c}} - {s['lo']!r}D) / {width!r}D"
    return _replace(df, new)


def standardize(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean imputation, then zero mean and unit population variance, fitted on
    all rows."""
    stats = column_stats(
        df, features, {"mean": "avg({c})", "sd": "stddev_pop({c})", "n": "count({c})", "all": "count(1)"}
    )
    new = {}
    for f, s in stats.items():
        if not s["n"]:
            new[f] = "0D"
            continue
        # Imputed rows sit on the mean, so they only widen the divisor.
        sd = s["sd"] * (s["n"] / s["all"]) ** 0.5 or 1.0
        new[f] = f"(coalesce({{c}}, {s['mean']!r}D) - {s['mean']!r}D) / {sd!r}D"
    return _replace(df, new)


def embed_2d(cards: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two principal components of the standardized card features, their sum and
    their product."""
    scaled = standardize(cards.select("card_id", *[f"`{f}`" for f in features]), features)
    vectors = VectorAssembler(inputCols=list(features), outputCol="__in").transform(scaled)
    model = PCA(k=2, inputCol="__in", outputCol="__out").fit(vectors)
    pair = vector_to_array(F.col("__out"))
    e0, e1 = pair[0], pair[1]
    return model.transform(vectors).select(
        "card_id",
        e0.alias("umap0"),
        e1.alias("umap1"),
        (e0 + e1).alias("umap+umap"),
        (e0 * e1).alias("umap*umap"),
    )


def model_inputs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Finite, gap-free features. A column without any train value becomes 0."""
    df = impute_train_mean(replace_infinite(df, features), features)
    return df.fillna(0.0, [f for f in features])
