"""Gradient boosting on histograms, for all folds at once.

Features are cut into bins by their quantiles once; a row is then one byte per feature. A tree
grows from sums of gradients and row counts per (node, feature, bin): tasks make them for their
rows with array arithmetic, for the models of all folds in the same pass, Spark shuffles them by
(node, feature) and adds them up where the best cut of that feature is found. Only the best
cut of every node comes to the driver, so neither rows nor histograms do.

A node is cut where the regularised second-order gain is largest (L1 and L2 on leaf values); of
the nodes of a level those with the largest gain are cut first, until the tree has ``leaves``
leaves. The rows of a fold are not trained on by its model; their error is measured in the
pass that begins the next tree, and a model stops once it has not fallen for ``patience`` trees.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.models import walk
from cardloom.sources.staging import staged

BINS = 64
# Trees kept in the tasks' plan; then the predictions so far are written down.
RECENT = 12


@dataclass(frozen=True)
class Params:
    trees: int = 100
    depth: int = 6
    leaves: int = 31
    rate: float = 0.05
    l1: float = 0.1
    l2: float = 1.0
    min_rows: int = 20
    min_gain: float = 0.0
    row_share: float = 1.0
    feature_share: float = 1.0
    patience: int = 20
    seed: int = 459


@dataclass
class Tree:
    """Nodes in arrays: feature and bin of the cut (rows up to it go left), children, value.
    A leaf has feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def values(self, bins: np.ndarray) -> np.ndarray:
        return walk.values(self, bins)


def _shrunk(g: np.ndarray | float, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def _score(g, h, p: Params):
    return _shrunk(g, p.l1) ** 2 / (h + p.l2)


def binned(data: DataFrame, vector: str, bins: int = BINS) -> DataFrame:
    """Staged card_id, target, fold and ``bins``, one byte per feature: how many of the
    feature's quantiles lie below the value. A missing value is in bin 0, left of every cut."""
    shares = ", ".join(f"{k / (bins - 1)}D" for k in range(1, bins - 1))
    edges = (
        data.where("target IS NOT NULL")
        .select(F.posexplode(vector_to_array(vector)).alias("ix", "v"))
        .where("NOT isnan(v)")
        .groupBy("ix")
        .agg(F.expr(f"percentile_approx(v, array({shares}), 10000)").alias("edges"))
        .collect()  # features x bins numbers
    )
    found = {r["ix"]: np.unique(r["edges"]) for r in edges}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            rows = x.flatten().to_numpy().reshape(len(x), -1) if len(x) else np.zeros((0, 0))
            out = np.zeros(rows.shape, np.uint8)
            for j in range(rows.shape[1]):
                if j in found:
                    out[:, j] = np.searchsorted(found[j], rows[:, j], "left") + 1
            out[np.isnan(rows)] = 0
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("card_id", "target", "fold")), pa.array([r.tobytes() for r in out], pa.binary())],
                ["card_id", "target", "fold", "bins"],
            )

    rows = data.select(
        "card_id",
        F.col("target").cast("double").alias("target"),
        F.col("fold").cast("int").alias("fold"),
        vector_to_array(vector).alias("x"),
    )
    return staged(rows.mapInArrow(run, "card_id string, target double, fold int, bins binary"), "binned")


def _bins(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column("bins")
    wide = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    _, ends, data = col.buffers()
    ends = np.frombuffer(ends, wide)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].reshape(len(col), -1)


def _margins(record: Mapping[str, pa.Scalar], x: np.ndarray, base: Sequence[float], recent: Sequence[Sequence[Tree]]) -> np.ndarray:
    """Predictions of every model, models x rows of a block, with the trees not yet written down."""
    if "margins" in record:
        known = np.frombuffer(record["margins"].as_buffer()).reshape(len(base), -1).copy()
    else:
        known = np.repeat(np.array(base, float)[:, None], len(x), axis=1)
    for m, trees in enumerate(recent):
        for tree in trees:
            known[m] += tree.values(x)
    return known


HISTOGRAMS = "model int, node int, feature int, g array<double>, n array<double>"


def _chosen(record: Mapping[str, pa.Scalar], n: int, share: float, salt: str) -> np.ndarray:
    if share >= 1:
        return np.ones(n, bool)
    low = int(share * 2**32)
    return np.array([zlib.crc32(f"{salt}:{c}".encode()) < low for c in record["card_id"].as_py()])


def _histograms(
    base: Sequence[float],
    recent: Sequence[Sequence[Tree]],
    growing: Sequence[Tree | None],
    active: Sequence[Sequence[int]],
    p: Params,
    number: int,
    bins: int,
):
    """Per model, active node and feature the sums of gradients and the rows of every bin, and,
    under feature -1, the squared error of the model's held-out rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        error: dict[int, np.ndarray] = {}
        used: dict[int, np.ndarray] = {}
        for rows, y, fold, record in walk.opened(batches, np.uint8):
            margins, width = _margins(record, rows, base, recent), rows.shape[1]
            chosen = _chosen(record, len(rows), p.row_share, f"row{p.seed}:{number}")
            for m, tree in enumerate(growing):
                if tree is None:
                    continue
                gap = margins[m] - y
                held = fold == m
                error[m] = error.get(m, 0) + np.array([(gap[held] ** 2).sum(), held.sum()])
                if m not in used:
                    some = [
                        j
                        for j in range(width)
                        if zlib.crc32(f"col{p.seed}:{number}:{m}:{j}".encode()) < p.feature_share * 2**32
                    ]
                    used[m] = np.array(some or [number % width])
                place = {node: i for i, node in enumerate(active[m])}
                at = np.full(len(rows), -1)
                for node, some in walk.reached(tree, rows):
                    if node in place:
                        at[some] = place[node]
                take = np.flatnonzero(~held & chosen & (at >= 0))
                if not len(take):
                    continue
                cols, size = used[m], len(active[m]) * bins
                if m not in total:
                    total[m] = np.zeros((2, len(active[m]), len(cols), bins))
                first, gap = at[take] * bins, gap[take]
                for i, j in enumerate(cols):
                    cell = first + rows[:, j][take]
                    total[m][0, :, i] += np.bincount(cell, gap, size).reshape(-1, bins)
                    total[m][1, :, i] += np.bincount(cell, minlength=size).reshape(-1, bins)
        out = []
        for m, (g, n) in total.items():
            for i, (gs, ns) in enumerate(zip(g, n)):
                out += [(m, active[m][i], int(j), a, b) for j, a, b in zip(used[m], gs, ns)]
        out += [(m, -1, -1, e[:1], e[1:]) for m, e in error.items()]
        columns = list(zip(*out)) or [[]] * 5
        lists = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in columns[:3]), *(pa.array(list(c), lists) for c in columns[3:])],
            ["model", "node", "feature", "g", "n"],
        )

    return run


CUTS = "model int, node int, gain double, feature int, cut int, left_g double, left_n double, g double, n double"


def _best_cuts(p: Params):
    """Histograms of the same (model, node, feature), added up, to their best cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("model", "node", "feature")))
            for key, g, n in zip(keys, batch.column("g"), batch.column("n")):
                total[key] = total.get(key, 0) + np.stack([g.values.to_numpy(), n.values.to_numpy()])
        out = []
        for (m, node, j), sums in total.items():
            g, n = sums[0].sum(), sums[1].sum()
            best = (-1.0, j, 0, 0.0, 0.0)
            if node >= 0:
                left_g, left_n = np.cumsum(sums, axis=1)[:, :-1]
                right_g, right_n = g - left_g, n - left_n
                gain = (_score(left_g, left_n, p) + _score(right_g, right_n, p) - _score(g, n, p)) / 2
                gain[(left_n < p.min_rows) | (right_n < p.min_rows)] = -1
                k = int(gain.argmax())
                best = (float(gain[k]), j, k, float(left_g[k]), float(left_n[k]))
            out.append((m, node, *best, float(g), float(n)))
        columns = list(zip(*out)) or [[]] * 9
        whole = {"model", "node", "feature", "cut"}
        names = [c.split()[0] for c in CUTS.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if x in whole else pa.float64()) for x, c in zip(names, columns)], names
        )

    return run


def _level(rows: DataFrame, base, recent, growing, active, p: Params, number: int, bins: int) -> dict:
    """``(model, node) -> best cut``; node -1 has the held-out error."""
    best = (
        rows.mapInArrow(_histograms(base, recent, growing, active, p, number, bins), HISTOGRAMS)
        .repartition("model", "node", "feature")
        .mapInArrow(_best_cuts(p), CUTS)
        .groupBy("model", "node")
        .agg(F.max(F.struct("gain", (-F.col("feature")).alias("order"), "feature", "cut", "left_g", "left_n", "g", "n")).alias("best"))
        .collect()  # one row per open node
    )
    return {(r["model"], r["node"]): r["best"] for r in best}


def _written(blocks: DataFrame, base: Sequence[float], recent: Sequence[Sequence[Tree]]) -> DataFrame:
    kept = [c for c in blocks.columns if c != "margins"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _, _, record in walk.opened(batches, np.uint8):
            margins = pa.array([_margins(record, x, base, recent).tobytes()], pa.binary())
            same = [pa.array([record[c].as_py()], record[c].type) for c in kept]
            yield pa.RecordBatch.from_arrays([*same, margins], [*kept, "margins"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.select(*kept).schema)
    return staged(blocks.mapInArrow(run, f"{types}, margins binary"), "margins")


def train(rows: DataFrame, k: int, p: Params, bins: int = BINS) -> tuple[list[float], list[list[Tree]]]:
    """Per fold the first prediction and the trees of the model that never saw it, from ``binned``
    rows. Trees after the one with the smallest held-out error are dropped."""
    stats = {
        r["fold"]: (r["n"], r["s"])
        for r in rows.where("target IS NOT NULL")
        .groupBy("fold")
        .agg(F.count("target").alias("n"), F.sum("target").alias("s"))
        .collect()
    }
    base = []
    for m in range(k):
        kept = [v for f, v in stats.items() if f != m]
        base.append(sum(s for _, s in kept) / max(1, sum(n for n, _ in kept)))
    now = walk.blocks(rows, _bins, "bins", "bin-blocks", cards=p.row_share < 1)
    models: list[list[Tree]] = [[] for _ in range(k)]
    errors: list[list[float]] = [[] for _ in range(k)]  # before each tree
    open_ = [m in stats for m in range(k)]
    since = 0
    for number in range(p.trees + 1):
        recent = [trees[since:] for trees in models]
        growing: list[Tree | None] = [Tree() if o else None for o in open_]
        active: list[list[int]] = [[0] if o else [] for o in open_]
        for depth in range(p.depth):
            if not any(active):
                break
            last = number == p.trees  # one more pass, for the error of the last tree
            best = _level(now, base, recent, growing, active, p, number, bins)
            if not depth:
                for m, tree in enumerate(growing):
                    if tree is not None and (m, -1) in best:
                        errors[m].append(best[m, -1]["g"] / max(1.0, best[m, -1]["n"]))
                        least = int(np.argmin(errors[m]))
                        if len(errors[m]) - 1 - least >= p.patience:
                            open_[m], growing[m], active[m] = False, None, []
            if last:
                break
            for m, tree in enumerate(growing):
                found = sorted(((best[m, i]["gain"], -i) for i in active[m] if (m, i) in best), reverse=True)
                room = p.leaves - sum(f < 0 for f in tree.feature) if tree else 0
                if tree and not depth and (m, 0) in best:
                    tree.value[0] = -p.rate * float(_shrunk(best[m, 0]["g"], p.l1) / (best[m, 0]["n"] + p.l2))
                active[m] = []
                for gain, i in found[: max(0, room)]:
                    if gain <= p.min_gain:
                        break
                    b, first = best[m, -i], len(tree.feature)
                    tree.feature[-i], tree.cut[-i], tree.left[-i] = b["feature"], b["cut"], first
                    for g, n in ((b["left_g"], b["left_n"]), (b["g"] - b["left_g"], b["n"] - b["left_n"])):
                        tree.feature.append(-1)
                        tree.cut.append(0)
                        tree.left.append(0)
                        tree.value.append(-p.rate * float(_shrunk(g, p.l1) / (n + p.l2)))
                    active[m] += [first, first + 1]
        if number == p.trees or not any(open_):
            break
        for m, tree in enumerate(growing):
            if tree is not None:
                models[m].append(tree)
        if max(len(t) for t in models) - since >= RECENT:
            now = _written(now, base, [trees[since:] for trees in models])
            since = max(len(t) for t in models)
            # Models that stopped earlier have no later trees, so one mark serves all.
    return base, [trees[: int(np.argmin(e))] if e else [] for trees, e in zip(models, errors)]


def predict(rows: DataFrame, base: Sequence[float], models: Sequence[Sequence[Tree]], name: str = "pred") -> DataFrame:
    """card_id, target, fold and the prediction: for a train card that of its fold's model, for
    the others the mean of all models."""
    base, models = list(base), [list(m) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in walk.joined(batches):
            rows, fold = _bins(batch), batch.column("fold").to_numpy()
            every = np.zeros((len(batch), len(base)))
            for m, trees in enumerate(models):
                # A train card is told by its own fold's model alone.
                asked = np.flatnonzero((fold == m) | (fold < 0))
                some = np.asfortranarray(rows[asked])
                every[asked, m] = base[m] + sum((t.values(some) for t in trees), np.zeros(len(asked)))
            own = every[np.arange(len(batch)), np.maximum(fold, 0)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("card_id", "target", "fold")), pa.array(np.where(fold >= 0, own, every.mean(axis=1)))],
                ["card_id", "target", "fold", name],
            )

    return rows.mapInArrow(run, f"card_id string, target double, fold int, `{name}` double")


def slot(settings: Mapping[str, object]) -> Params:
    """The parameters of a boosted slot, from the names the library's trees use."""
    share = settings.get("featureSubsetStrategy", "all")
    return Params(
        trees=int(settings.get("maxIter", Params.trees)),
        depth=int(settings.get("maxDepth", Params.depth)),
        rate=float(settings.get("stepSize", Params.rate)),
        row_share=float(settings.get("subsamplingRate", 1.0)),
        feature_share=1.0 if share == "all" else float(share),
        min_rows=int(settings.get("minInstancesPerNode", Params.min_rows)),
        seed=int(settings.get("seed", Params.seed)),
    )


def slots(
    data: DataFrame, vector: str, k: int, params: Mapping[str, Params], bins: int = BINS
) -> DataFrame:
    """card_id and one column of out-of-fold predictions per name, over rows binned once."""
    rows = binned(data, vector, bins)
    out = None
    for name, p in params.items():
        found = predict(rows, *train(rows, k, p, bins), name).select("card_id", name)
        out = found if out is None else out.join(found, "card_id")
    return out


def oof_histogram(
    data: DataFrame, vector: str, k: int, params: Params = Params(), name: str = "pred", bins: int = BINS
) -> DataFrame:
    """card_id, target, fold and out-of-fold predictions of staged ``vectors``."""
    rows = binned(data, vector, bins)
    return predict(rows, *train(rows, k, params, bins), name)
