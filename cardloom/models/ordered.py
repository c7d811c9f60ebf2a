"""Ordered boosting: no card's gradient or category statistic contains its own target.

The permutation is the order of a hash of the card's id, and its prefixes double: level 0 is the
smallest 1 / 2^(prefixes - 1) of the hash range, each further level as large as all before it.
What a card is told comes from the levels below its own, so a level is a column of the row and
no rank or sort over the cards is needed.

A category becomes its smoothed mean target over the lower levels. Every model keeps one
supporting version per level, trained on the levels below, beside the version trained on all; the
gradient that chooses a cut is that of the version which never saw the card. Trees are symmetric,
one cut for all nodes of a depth. Models of all folds grow in the same passes, and the rows of a
fold are in no statistic, gradient or leaf of its model. Sums are made in tasks by array
arithmetic, added up by Spark; only the chosen cut and the leaves of each model come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.models.boosting import BINS, HISTOGRAMS, RECENT, _bins
from cardloom.sources.staging import staged

PREFIXES = 8
# Rows the prior of a category's statistic is worth.
CENTER = 1.0
# Sums a task holds in one pass; a deeper level takes its features in several passes.
CELLS = 1 << 23


@dataclass(frozen=True)
class Params:
    trees: int = 100
    depth: int = 6
    rate: float = 0.05
    l2: float = 3.0
    patience: int = 20
    seed: int = 459
    prefixes: int = PREFIXES
    center: float = CENTER


def level_of(card: Column, prefixes: int = PREFIXES, seed: int = 0) -> Column:
    """0..prefixes-1 from the id. Hex digits compare like the numbers they stand for."""
    place = F.substring(F.md5(F.concat(card.cast("string"), F.lit(f":{seed}"))), 1, 8)
    bounds = [f"{1 << (32 - prefixes + j):08x}" for j in range(1, prefixes)]
    return reduce(lambda a, b: a + (place >= F.lit(b)).cast("int"), bounds, F.lit(0))


def _below(entries: Column, level: Column, m: int) -> Column:
    """``struct(s, n)`` over the entries of lower levels and of other folds than ``m``."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.filter(entries, lambda e: (e["level"] < level) & (e["fold"] != m)),
        zero,
        lambda a, e: F.struct((a["s"] + e["s"]).alias("s"), (a["n"] + e["n"]).alias("n")),
    )


def ordered_statistics(
    rows: DataFrame, columns: Sequence[str], k: int, prefixes: int = PREFIXES, seed: int = 0, center: float = CENTER
) -> DataFrame:
    """The rows (card_id, target, fold and more) with ``__level`` and per column an array
    ``<column>_ts`` of one statistic per model.

    For model ``m`` it is ``(s + center * prior) / (n + center)`` with sum and count of the targets of
    the same category, a null category being one too, over the cards of lower levels outside fold
    ``m``. A card that model never trains on (of fold ``m``, or without target) is told the sums of all
    levels outside fold ``m``. The prior is the mean target over the same cards whatever their category;
    level 0 takes that of all other levels. Sums are one aggregate for all columns; a category has at
    most ``prefixes * k`` of them, and they meet the rows in a join the optimizer plans.
    """
    rows = rows.withColumn("__level", level_of(F.col("card_id"), prefixes, seed))
    entries = [F.struct(F.lit(-1).alias("ix"), F.lit(None).cast("string").alias("value"))]
    entries += [F.struct(F.lit(i).alias("ix"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)]
    sums = (
        rows.where("target IS NOT NULL")
        .select("fold", "target", "__level", F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.ix", "e.value", "__level", "fold")
        .agg(F.sum("target").alias("s"), F.count("target").alias("n"))
        .groupBy("ix", "value")
        .agg(F.collect_list(F.struct(F.col("__level").alias("level"), "fold", "s", "n")).alias("entries"))
    )
    sums = staged(sums, "ordered-sums")
    whole = sums.where("ix = -1").select("entries").first()  # prefixes x k sums
    told = whole["entries"] if whole else []

    def prior(level: int, m: int) -> float:
        # Level 0 has nothing below it, so it takes what lies above.
        kept = [e for e in told if e["fold"] != m and (e["level"] < level if level else e["level"] > 0)]
        n = sum(e["n"] for e in kept)
        return sum(e["s"] for e in kept) / n if n else 0.0

    levels = range(prefixes + 1)
    known = sums.schema["entries"].dataType
    # Every level and model of a category once: the rows only look theirs up.
    statistic = []
    for j in levels:
        per_model = []
        for m in range(k):
            found = _below(F.col("entries"), F.lit(j), m)
            per_model.append((found["s"] + F.lit(center) * F.lit(prior(j, m))) / (found["n"] + F.lit(center)))
        statistic.append(F.array(*per_model))
    made = staged(sums.where("ix >= 0").select("ix", "value", F.array(*statistic).alias("statistics")), "ordered-statistics")
    # A category of no train card.
    nothing = sums.sparkSession.range(1).select(F.expr("array()").cast(known).alias("entries")).select(F.array(*statistic)).first()[0]
    unseen = F.array(*[F.array(*map(F.lit, per_model)) for per_model in nothing])
    out = rows
    for i, c in enumerate(columns):
        mine = made.where(F.col("ix") == i).select(F.col("value").alias("__value"), F.col("statistics").alias("__statistics"))
        joined = out.join(mine, F.col(f"`{c}`").cast("string").eqNullSafe(F.col("__value")), "left").drop("__value")
        statistics = F.coalesce("__statistics", unseen)
        per_model = []
        for m in range(k):
            outside = F.col("target").isNull() | (F.col("fold") == m)
            level = F.when(outside, F.lit(prefixes)).otherwise(F.col("__level"))
            per_model.append(F.element_at(F.element_at(statistics, level + 1), m + 1))
        out = joined.withColumn(f"{c}_ts", F.array(*per_model)).drop("__statistics")
    return out


def _edges(data: DataFrame, vector: Column, bins: int) -> dict[int, np.ndarray]:
    shares = ", ".join(f"{i / (bins - 1)}D" for i in range(1, bins - 1))
    found = (
        data.where("target IS NOT NULL")
        .select(F.posexplode(vector).alias("ix", "v"))
        .where("NOT isnan(v)")
        .groupBy("ix")
        .agg(F.expr(f"percentile_approx(v, array({shares}), 10000)").alias("edges"))
        .collect()  # features x bins numbers
    )
    return {r["ix"]: np.unique(r["edges"]) for r in found}


def binned(data: DataFrame, vector: str, categories: Sequence[str], k: int, p: Params, bins: int = BINS) -> DataFrame:
    """Staged card_id, target, fold, level and ``bins``: one byte per feature, then per model one
    byte per category. A missing value is in bin 0. ``data`` has the categories as columns."""
    rows = data.select("card_id", F.col("target").cast("double").alias("target"), F.col("fold").cast("int").alias("fold"), vector, *[F.col(f"`{c}`") for c in categories])
    told = ordered_statistics(rows, categories, k, p.prefixes, p.seed, p.center)
    per_model = [F.element_at(f"{c}_ts", m + 1) for m in range(k) for c in categories]
    x = F.concat(vector_to_array(vector), F.array(*per_model).cast("array<double>"))
    told = staged(told.select("card_id", "target", "fold", F.col("__level").alias("level"), x.alias("x")), "ordered-inputs")
    found = _edges(told, F.col("x"), bins)
    kept = ("card_id", "target", "fold", "level")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            values = x.flatten().to_numpy().reshape(len(x), -1) if len(x) else np.zeros((0, 0))
            out = np.zeros(values.shape, np.uint8)
            for j in range(values.shape[1]):
                if j in found:
                    out[:, j] = np.searchsorted(found[j], values[:, j], "left") + 1
            out[np.isnan(values)] = 0
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array([r.tobytes() for r in out], pa.binary())], [*kept, "bins"]
            )

    return staged(told.mapInArrow(run, "card_id string, target double, fold int, level int, bins binary"), "ordered-bins")


@dataclass
class Tree:
    """The cut of every depth as (feature, bin), and per version (levels, then all) the leaves."""

    cuts: list[tuple[int, int]]
    values: np.ndarray | None = None

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        for feature, cut in self.cuts:
            at = at * 2 + (bins[:, feature] > cut)
        return at


def _margins(batch: pa.RecordBatch, bins: np.ndarray, recent: Sequence[Sequence[Tree]], versions: int) -> np.ndarray:
    """Predictions, rows x models x versions, with the trees not yet written down."""
    known = batch.column("margins").flatten().to_numpy().reshape(len(batch), -1, versions).copy()
    for m, trees in enumerate(recent):
        for tree in trees:
            known[:, m] += tree.values[:, tree.leaves(bins)].T
    return known


def _own(m: int, plain: int, categories: int) -> np.ndarray:
    """The columns model ``m`` looks at."""
    first = plain + m * categories
    return np.r_[np.arange(plain), np.arange(first, first + categories)]


def _histograms(recent, growing: Sequence[Tree | None], plain: int, categories: int, versions: int, bins: int, some: slice):
    """Per model and feature the sums of the ordered gradients and the rows of every (node, bin),
    for ``some`` of the columns each model looks at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            rows, y = _bins(batch), batch.column("target").to_numpy()
            fold, level = batch.column("fold").to_numpy(), batch.column("level").to_numpy()
            margins = _margins(batch, rows, recent, versions)
            for m, tree in enumerate(growing):
                if tree is None:
                    continue
                take = np.flatnonzero(fold != m)
                gap = margins[take, m, level[take]] - y[take]
                cols = _own(m, plain, categories)[some]
                nodes = 1 << len(tree.cuts)
                at = tree.leaves(rows[take])
                cell = (np.arange(len(cols)) * nodes + at[:, None]) * bins + rows[take][:, cols]
                size = len(cols) * nodes * bins
                g = np.bincount(cell.ravel(), np.repeat(gap, len(cols)), size)
                n = np.bincount(cell.ravel(), minlength=size)
                total[m] = total.get(m, 0) + np.stack([g, n])
        out = []
        for m, (g, n) in total.items():
            cols = _own(m, plain, categories)[some]
            out += [(m, 0, int(j), a, b) for j, a, b in zip(cols, g.reshape(len(cols), -1), n.reshape(len(cols), -1))]
        columns = list(zip(*out)) or [[]] * 5
        lists = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in columns[:3]), *(pa.array(list(c), lists) for c in columns[3:])],
            ["model", "node", "feature", "g", "n"],
        )

    return run


def _best_cuts(p: Params, bins: int):
    """Histograms of the same (model, feature), added up, to the bin of the largest gain over all nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("model", "feature")))
            for key, g, n in zip(keys, batch.column("g"), batch.column("n")):
                total[key] = total.get(key, 0) + np.stack([g.values.to_numpy(), n.values.to_numpy()])
        out = []
        for (m, j), sums in total.items():
            g, n = sums.reshape(2, -1, bins)
            left_g, left_n = np.cumsum(g, axis=1)[:, :-1], np.cumsum(n, axis=1)[:, :-1]
            all_g, all_n = g.sum(axis=1, keepdims=True), n.sum(axis=1, keepdims=True)
            score = lambda g, n: g**2 / (n + p.l2)
            gain = (score(left_g, left_n) + score(all_g - left_g, all_n - left_n) - score(all_g, all_n)).sum(axis=0)
            gain[(left_n.sum(axis=0) == 0) | (left_n.sum(axis=0) == all_n.sum())] = -1
            out.append((m, j, float(gain.max()), int(gain.argmax())))
        columns = list(zip(*out)) or [[]] * 4
        types = (pa.int32(), pa.int32(), pa.float64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["model", "feature", "gain", "cut"])

    return run


def _leaf_sums(recent, growing: Sequence[Tree | None], versions: int):
    """Per model, version and leaf the gradients of the rows that version is trained on; under
    version -1 the squared error of the held-out rows before this tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        error: dict[int, np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            rows, y = _bins(batch), batch.column("target").to_numpy()
            fold, level = batch.column("fold").to_numpy(), batch.column("level").to_numpy()
            gaps = _margins(batch, rows, recent, versions) - y[:, None, None]
            for m, tree in enumerate(growing):
                if tree is None:
                    continue
                held = fold == m
                error[m] = error.get(m, 0) + np.array([(gaps[held, m, -1] ** 2).sum(), held.sum()])
                leaves, size = tree.leaves(rows), 1 << len(tree.cuts)
                sums = np.zeros((2, versions, size))
                for v in range(1, versions):
                    seen = ~held & (level < v)
                    sums[0, v] = np.bincount(leaves[seen], gaps[seen, m, v], size)
                    sums[1, v] = np.bincount(leaves[seen], minlength=size)
                total[m] = total.get(m, 0) + sums
        out = [(m, -1, 0, float(e[0]), float(e[1])) for m, e in error.items()]
        for m, sums in total.items():
            for v, leaf in zip(*np.nonzero(sums[1])):
                out.append((m, int(v), int(leaf), float(sums[0, v, leaf]), float(sums[1, v, leaf])))
        columns = list(zip(*out)) or [[]] * 5
        types = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["model", "version", "leaf", "g", "n"]
        )

    return run


def _written(rows: DataFrame, recent: Sequence[Sequence[Tree]], versions: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            now = _margins(batch, _bins(batch), recent, versions).reshape(len(batch), -1) if len(batch) else []
            at = batch.schema.get_field_index("margins")
            yield batch.set_column(at, "margins", pa.array(list(now), pa.list_(pa.float64())))

    return staged(rows.mapInArrow(run, rows.schema), "ordered-margins")


def first_values(rows: DataFrame, k: int, prefixes: int) -> np.ndarray:
    """models x versions: the mean target of what each version is trained on; version 0, which is
    trained on nothing, has the mean of the levels above it."""
    sums = rows.where("target IS NOT NULL").groupBy("fold", "level").agg(F.sum("target").alias("s"), F.count("target").alias("n")).collect()
    out = np.zeros((k, prefixes + 1))
    for m in range(k):
        for v in range(prefixes + 1):
            kept = [r for r in sums if r["fold"] != m and (r["level"] < v if v else r["level"] > 0)]
            n = sum(r["n"] for r in kept)
            out[m, v] = sum(r["s"] for r in kept) / n if n else 0.0
    return out


def train(rows: DataFrame, k: int, categories: int, p: Params, bins: int = BINS) -> tuple[np.ndarray, list[list[Tree]]]:
    """Per fold the first values and the trees of the model that never saw it, from ``binned``
    rows. Trees after the one with the smallest held-out error are dropped."""
    versions = p.prefixes + 1
    known = rows.where("target IS NOT NULL")
    first = known.select("bins").first()
    base = first_values(rows, k, p.prefixes)
    if first is None:
        return base, [[] for _ in range(k)]
    plain = len(first["bins"]) - k * categories
    now = known.withColumn("margins", F.array(*[F.lit(float(v)) for v in base.ravel()]))
    models: list[list[Tree]] = [[] for _ in range(k)]
    errors: list[list[float]] = [[] for _ in range(k)]  # before each tree
    open_ = [True] * k
    since = 0
    for number in range(p.trees + 1):
        recent = [trees[since:] for trees in models]
        growing = [Tree([]) if o else None for o in open_]
        rising = list(growing)
        for _ in range(p.depth if number < p.trees else 0):
            nodes = max((1 << len(t.cuts) for t in rising if t is not None), default=1)
            step = max(1, CELLS // (nodes * bins * k))
            chosen = {}
            for at in range(0, plain + categories, step):
                some = slice(at, at + step)
                best = (
                    now.mapInArrow(_histograms(recent, rising, plain, categories, versions, bins, some), HISTOGRAMS)
                    .repartition("model", "feature")
                    .mapInArrow(_best_cuts(p, bins), "model int, feature int, gain double, cut int")
                    .groupBy("model")
                    .agg(F.max(F.struct("gain", (-F.col("feature")).alias("order"), "cut")).alias("best"))
                    .collect()  # one row per model
                )
                for r in best:
                    if r["best"]["gain"] > max(0.0, chosen[r["model"]]["gain"] if r["model"] in chosen else 0.0):
                        chosen[r["model"]] = r["best"]
            for m, tree in enumerate(rising):
                if tree is not None and m in chosen:
                    tree.cuts.append((-chosen[m]["order"], chosen[m]["cut"]))
                else:
                    rising[m] = None
            if not chosen:
                break
        sums = (
            now.mapInArrow(_leaf_sums(recent, growing, versions), "model int, version int, leaf int, g double, n double")
            .groupBy("model", "version", "leaf")
            .agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
            .collect()  # models x versions x leaves
        )
        for m, tree in enumerate(growing):
            if tree is not None:
                tree.values = np.zeros((versions, 1 << len(tree.cuts)))
        for r in sums:
            if r["version"] < 0:
                errors[r["model"]].append(r["g"] / max(1.0, r["n"]))
            else:
                growing[r["model"]].values[r["version"], r["leaf"]] = -p.rate * r["g"] / (r["n"] + p.l2)
        if number == p.trees:
            break
        for m, tree in enumerate(growing):
            if tree is None:
                continue
            models[m].append(tree)
            if len(errors[m]) - 1 - int(np.argmin(errors[m])) >= p.patience or not tree.cuts:
                open_[m] = False
        if not any(open_):
            break
        if number + 1 - since >= RECENT:
            now = _written(now, [trees[since:] for trees in models], versions)
            since = number + 1
    return base, [trees[: int(np.argmin(e))] if e else [] for trees, e in zip(models, errors)]


def predict(rows: DataFrame, base: np.ndarray, models: Sequence[Sequence[Tree]], name: str = "pred") -> DataFrame:
    """card_id, target, fold and the prediction of the version trained on all: for a train card
    that of its fold's model, for the others the mean of all models."""
    models = [list(m) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, fold = _bins(batch), batch.column("fold").to_numpy()
            every = np.empty((len(batch), len(models)))
            for m, trees in enumerate(models):
                every[:, m] = base[m, -1] + sum((t.values[-1, t.leaves(rows)] for t in trees), np.zeros(len(batch)))
            own = every[np.arange(len(batch)), np.maximum(fold, 0)]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("card_id", "target", "fold")), pa.array(np.where(fold >= 0, own, every.mean(axis=1)))],
                ["card_id", "target", "fold", name],
            )

    return rows.mapInArrow(run, f"card_id string, target double, fold int, `{name}` double")


def slot(settings: Mapping[str, object]) -> Params:
    """The parameters of the slot, from the names the library's trees use."""
    return Params(
        trees=int(settings.get("maxIter", Params.trees)),
        depth=int(settings.get("maxDepth", Params.depth)),
        rate=float(settings.get("stepSize", Params.rate)),
        seed=int(settings.get("seed", Params.seed)),
    )


def oof_ordered(
    data: DataFrame, vector: str, categories: Sequence[str], k: int, params: Params = Params(), name: str = "pred", bins: int = BINS
) -> DataFrame:
    """card_id, target, fold and out-of-fold predictions from a feature vector and category columns."""
    rows = binned(data, vector, categories, k, params, bins)
    return predict(rows, *train(rows, k, len(categories), params, bins), name)
