"""Extremely randomised trees, all trees of all folds grown level by level.

A node looks at a random part of the features and draws one threshold for each, uniformly between
the smallest and the largest value its rows have; the best of these cuts is taken. A level is two
passes over the rows: extremes per (tree, node), which meet in one place and become thresholds,
then sums left of every threshold, which meet again and become the best cut. Tasks make both by
array arithmetic; what reaches the driver is bounded by trees, nodes and features, not by rows.
Trees are grown on all rows outside their fold, in blocks small enough for a task's memory.
A missing value goes left of every threshold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.models import walk
from cardloom.sources.staging import staged

# Thresholds of one level that a task holds at once.
CELLS = 1 << 21


@dataclass(frozen=True)
class Params:
    trees: int = 300
    depth: int = 6
    feature_share: float = 0.5
    min_rows: int = 20
    seed: int = 4950


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1. Values above the cut go to ``left`` + 1."""

    fold: int
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def values(self, x: np.ndarray) -> np.ndarray:
        return walk.values(self, x)


def candidates(p: Params, tree: int, node: int, width: int) -> np.ndarray:
    """The features a node looks at, ascending."""
    size = min(width, max(1, round(p.feature_share * width)))
    return np.sort(np.random.default_rng([p.seed, tree, node]).choice(width, size, replace=False))


def thresholds(p: Params, tree: int, node: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low + np.random.default_rng([p.seed, tree, node, 1]).random(len(low)) * (high - low)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy().reshape(len(x), -1)


@dataclass
class _Open:
    """The nodes of one tree that are being cut: their numbers and features, and thresholds."""

    tree: int
    nodes: list[int]
    features: np.ndarray
    cuts: np.ndarray | None = None


def _by_fold(batches: Iterator[pa.RecordBatch], trees: Mapping[int, Tree], level: Sequence[_Open]):
    """Features and targets of the rows outside each fold, with the open nodes of that fold's trees."""
    opened: dict[int, list[_Open]] = {}
    for o in level:
        opened.setdefault(trees[o.tree].fold, []).append(o)
    for x, y, fold, _ in walk.opened(batches, float):
        for m, some in opened.items():
            kept = fold != m
            if kept.any():
                yield np.asfortranarray(x[kept]), y[kept], m, some


def _in_open(x: np.ndarray, tree: Tree, todo: _Open):
    """Of every open node that has rows: its place, their positions and its features, each with place and values."""
    place = {n: i for i, n in enumerate(todo.nodes)}
    for node, at in walk.reached(tree, x):
        if node in place:
            i = place[node]
            yield i, at, ((c, x[:, j][at]) for c, j in enumerate(todo.features[i]))


def _table(rows: list, scalars: int, names: Sequence[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    types = [pa.int32()] * 2 + [pa.float64()] * (scalars - 2) + [pa.list_(pa.float64())] * (len(names) - scalars)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], list(names))


EXTREMES = "tree int, node int, low array<double>, high array<double>"
SUMS = "tree int, node int, s double, n double, ls array<double>, ln array<double>"


def _extremes(trees: Mapping[int, Tree], level: Sequence[_Open]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = {o.tree: np.full(o.features.shape, np.nan) for o in level}
        high = {o.tree: np.full(o.features.shape, np.nan) for o in level}
        for x, _, _, some in _by_fold(batches, trees, level):
            for o in some:
                least, most = low[o.tree], high[o.tree]
                for i, _, values in _in_open(x, trees[o.tree], o):
                    for c, v in values:
                        least[i, c] = np.fmin(least[i, c], np.fmin.reduce(v))
                        most[i, c] = np.fmax(most[i, c], np.fmax.reduce(v))
        rows = [(o.tree, n, a, b) for o in level for n, a, b in zip(o.nodes, low[o.tree], high[o.tree])]
        yield _table(rows, 2, ("tree", "node", "low", "high"))

    return run


def _drawn(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for t, n, a, b in zip(*(batch.column(c) for c in ("tree", "node", "low", "high"))):
                key, a, b = (t.as_py(), n.as_py()), a.values.to_numpy(), b.values.to_numpy()
                known = found.get(key, (a, b))
                found[key] = np.fmin(known[0], a), np.fmax(known[1], b)
        rows = [(*key, thresholds(p, *key, a, b)) for key, (a, b) in found.items()]
        yield _table(rows, 2, ("tree", "node", "cuts"))

    return run


def _sums(trees: Mapping[int, Tree], level: Sequence[_Open], base: Sequence[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {o.tree: np.zeros((2, len(o.nodes))) for o in level}
        left = {o.tree: np.zeros((2, *o.features.shape)) for o in level}
        for x, y, m, some in _by_fold(batches, trees, level):
            gaps = y - base[m]
            for o in some:
                for i, at, values in _in_open(x, trees[o.tree], o):
                    gap = gaps[at]
                    total[o.tree][:, i] += gap.sum(), len(at)
                    for c, v in values:
                        goes = ~(v > o.cuts[i, c])
                        left[o.tree][:, i, c] += gap @ goes, np.count_nonzero(goes)
        rows = [
            (o.tree, node, total[o.tree][0, i], total[o.tree][1, i], left[o.tree][0, i], left[o.tree][1, i])
            for o in level
            for i, node in enumerate(o.nodes)
        ]
        yield _table(rows, 4, ("tree", "node", "s", "n", "ls", "ln"))

    return run


def best_cut(s: float, n: float, ls: np.ndarray, ln: np.ndarray, min_rows: int) -> tuple[float, int]:
    """The gain of the best candidate and its place; a gain of 0 or less is no cut."""
    fits = (ln >= max(1, min_rows)) & (n - ln >= max(1, min_rows))
    if not fits.any():
        return 0.0, 0
    a, b = np.maximum(ln, 1), np.maximum(n - ln, 1)
    gain = np.where(fits, ls**2 / a + (s - ls) ** 2 / b - s**2 / n, -1.0)
    return float(gain.max()), int(gain.argmax())


def _chosen(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            for t, n, s, c, ls, ln in zip(*(batch.column(x) for x in ("tree", "node", "s", "n", "ls", "ln"))):
                parts = [s.as_py(), c.as_py(), ls.values.to_numpy(), ln.values.to_numpy()]
                key = t.as_py(), n.as_py()
                found[key] = [a + b for a, b in zip(found[key], parts)] if key in found else parts
        rows = []
        for key, (s, n, ls, ln) in found.items():
            gain, at = best_cut(s, n, ls, ln, p.min_rows)
            rows.append((*key, gain, float(at), s, n, float(ls[at]), float(ln[at])))
        yield _table(rows, 8, ("tree", "node", "gain", "at", "s", "n", "ls", "ln"))

    return run


def _grow(rows: DataFrame, trees: Mapping[int, Tree], base: Sequence[float], width: int, p: Params) -> None:
    active = {t: [0] for t in trees}
    for depth in range(p.depth):
        level = [
            _Open(t, nodes, np.array([candidates(p, t, n, width) for n in nodes])) for t, nodes in active.items() if nodes
        ]
        if not level:
            return
        drawn = {
            (r["tree"], r["node"]): r["cuts"]
            for r in rows.mapInArrow(_extremes(trees, level), EXTREMES)
            .repartition("tree", "node")
            .mapInArrow(_drawn(p), "tree int, node int, cuts array<double>")
            .collect()  # one row per open node
        }
        for o in level:
            o.cuts = np.array([drawn[o.tree, n] for n in o.nodes], float)
        best = (
            rows.mapInArrow(_sums(trees, level, base), SUMS)
            .repartition("tree", "node")
            .mapInArrow(_chosen(p), "tree int, node int, gain double, at double, s double, n double, ls double, ln double")
            .collect()  # one row per open node
        )
        found = {(r["tree"], r["node"]): r for r in best}
        active = {}
        for o in level:
            tree, active[o.tree] = trees[o.tree], []
            for i, node in enumerate(o.nodes):
                r = found[o.tree, node]
                if not depth:
                    tree.value[0] = base[tree.fold] + (r["s"] / r["n"] if r["n"] else 0.0)
                # Sums in another order leave a trace of a gain in nodes of one value.
                if r["gain"] <= 1e-12 * (1 + r["s"] ** 2):
                    continue
                at, first = int(r["at"]), len(tree.feature)
                tree.feature[node], tree.cut[node] = int(o.features[i, at]), float(o.cuts[i, at])
                tree.left[node] = first
                for s, n in ((r["ls"], r["ln"]), (r["s"] - r["ls"], r["n"] - r["ln"])):
                    tree.feature.append(-1)
                    tree.cut.append(0.0)
                    tree.left.append(0)
                    tree.value.append(base[tree.fold] + s / n)
                active[o.tree] += [first, first + 1]


def unpacked(data: DataFrame, vector: str) -> DataFrame:
    """Staged card_id, target, fold and the features as an array ``x``."""
    rows = data.select(
        "card_id",
        F.col("target").cast("double").alias("target"),
        F.col("fold").cast("int").alias("fold"),
        vector_to_array(vector).alias("x"),
    )
    return staged(rows, "extra-inputs")


def train(rows: DataFrame, k: int, p: Params = Params()) -> list[list[Tree]]:
    """Per fold the trees that never saw it, from ``unpacked`` rows."""
    known = rows.where("target IS NOT NULL")
    first = known.select("x").first()
    if first is None:
        return [[Tree(m)] for m in range(k)]
    width = len(first["x"])
    sums = known.groupBy("fold").agg(F.sum("target").alias("s"), F.count("target").alias("n")).collect()
    base = []
    for m in range(k):
        kept = [r for r in sums if r["fold"] != m]
        base.append(sum(r["s"] for r in kept) / max(1, sum(r["n"] for r in kept)))
    # Number t is tree t // k of fold t % k, so the trees do not depend on the blocks.
    size = max(1, CELLS // ((1 << max(0, p.depth - 1)) * max(1, round(p.feature_share * width))))
    packed = walk.blocks(known, _matrix, "x", "extra-blocks")
    out: list[list[Tree]] = [[] for _ in range(k)]
    for start in range(0, p.trees * k, size):
        block = {t: Tree(t % k) for t in range(start, min(p.trees * k, start + size))}
        _grow(packed, block, base, width, p)
        for t, tree in block.items():
            out[t % k].append(tree)
    return out


def predict(rows: DataFrame, models: Sequence[Sequence[Tree]], name: str = "pred") -> DataFrame:
    """card_id, target, fold and the mean over the trees: for a train card those of its fold, for the
    others those of all folds."""
    models = [list(m) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in walk.joined(batches):
            x, fold = _matrix(batch), batch.column("fold").to_numpy()
            every = np.zeros((len(batch), len(models)))
            for m, trees in enumerate(models):
                # A train card is told by the trees of its own fold alone.
                asked = np.flatnonzero((fold == m) | (fold < 0))
                some = np.asfortranarray(x[asked])
                every[asked, m] = sum(t.values(some) for t in trees) / len(trees)
            own = every[np.arange(len(batch)), np.maximum(fold, 0)]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("card_id", "target", "fold")), pa.array(np.where(fold >= 0, own, every.mean(axis=1)))],
                ["card_id", "target", "fold", name],
            )

    return rows.mapInArrow(run, f"card_id string, target double, fold int, `{name}` double")


def slot(settings: Mapping[str, object]) -> Params:
    """The parameters of the slot, from the names the library's forests use."""
    share = settings.get("featureSubsetStrategy", Params.feature_share)
    return Params(
        trees=int(settings.get("numTrees", Params.trees)),
        depth=int(settings.get("maxDepth", Params.depth)),
        feature_share=1.0 if share == "all" else float(share),
        min_rows=int(settings.get("minInstancesPerNode", Params.min_rows)),
        seed=int(settings.get("seed", Params.seed)),
    )


def oof_extra(data: DataFrame, vector: str, k: int, params: Params = Params(), name: str = "pred") -> DataFrame:
    """card_id, target, fold and out-of-fold predictions of staged ``vectors``."""
    rows = unpacked(data, vector)
    return predict(rows, train(rows, k, params), name)
