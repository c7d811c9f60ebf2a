"""A dense regression network, trained for all folds at once by sums of gradients.

Layers are linear with a leaky slope of its own for every unit (PReLU). A step passes over one slice
of the rows, chosen by a hash of the card: tasks add up the gradients of every fold's network
over their rows outside that fold, Spark adds the tasks' vectors up chunk by chunk, and the driver,
which holds nothing but the networks, takes an Adam step. After an epoch one more pass measures
every network on its held-out fold; the step is halved when that error stalls, training stops
when it stalls for longer, and the best weights are kept.

Inputs and target are standardised over the rows with a target, a missing value being the mean.
Statistics of batches would need a pass per layer, so there is no batch normalisation; weight
decay and the stop take the place of dropout.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.sources.staging import staged

# Weights per summed vector.
CHUNK = 4_096
# The hidden layers of the first and of the second level.
LEVEL1_WIDTHS = (1024, 256, 128, 64)
LEVEL2_WIDTHS = (512, 128, 64, 32)


@dataclass(frozen=True)
class Params:
    widths: tuple[int, ...] = (128, 32, 16)
    epochs: int = 50
    slices: int = 4
    rate: float = 0.01
    least_rate: float = 0.0001
    decay: float = 1e-4
    stall: int = 6
    patience: int = 15
    seed: int = 326


def shapes(inputs: int, p: Params) -> list[tuple[int, ...]]:
    """Per hidden layer its weights, bias and slopes, then the output's weights and bias."""
    out: list[tuple[int, ...]] = []
    for width in p.widths:
        out += [(inputs, width), (width,), (width,)]
        inputs = width
    return [*out, (inputs, 1), (1,)]


def unpack(flat: np.ndarray, form: Sequence[tuple[int, ...]]) -> list[np.ndarray]:
    out, at = [], 0
    for shape in form:
        size = int(np.prod(shape))
        out.append(flat[at : at + size].reshape(shape))
        at += size
    return out


def first_weights(form: Sequence[tuple[int, ...]], seed: Sequence[int]) -> np.ndarray:
    """Normal weights of variance 2 / inputs, no bias, slopes of a quarter; the output begins at 0."""
    rng, parts = np.random.default_rng(list(seed)), []
    for i, shape in enumerate(form):
        if i >= len(form) - 2:
            parts.append(np.zeros(shape))
        elif len(shape) == 2:
            parts.append(rng.normal(0, np.sqrt(2 / shape[0]), shape))
        else:
            parts.append(np.full(shape, 0.25 if i % 3 == 2 else 0.0))
    return np.concatenate([part.ravel() for part in parts])


def forward(x: np.ndarray, weights: Sequence[np.ndarray]) -> tuple[np.ndarray, list]:
    seen = []
    for i in range(0, len(weights) - 2, 3):
        w, b, slope = weights[i : i + 3]
        z = x @ w + b
        seen.append((x, z))
        x = np.where(z > 0, z, z * slope)
    return (x @ weights[-2] + weights[-1])[:, 0], [*seen, (x, None)]


def gradient(x: np.ndarray, y: np.ndarray, weights: Sequence[np.ndarray]) -> np.ndarray:
    """Of half the sum of squared errors, flat."""
    out, seen = forward(x, weights)
    back = (out - y)[:, None]
    grads = [back.sum(axis=0), seen[-1][0].T @ back]  # from the last weight to the first
    back = back @ weights[-2].T
    for i in range(len(weights) - 5, -1, -3):
        w, _, slope = weights[i : i + 3]
        x, z = seen[i // 3]
        grads.append((back * np.minimum(z, 0)).sum(axis=0))
        back = back * np.where(z > 0, 1.0, slope)
        grads += [back.sum(axis=0), x.T @ back]
        back = back @ w.T
    return np.concatenate([g.ravel() for g in reversed(grads)])


@dataclass(frozen=True)
class Scale:
    """Mean and spread of every input and of the target."""

    x_mean: np.ndarray
    x_std: np.ndarray
    y_mean: float
    y_std: float

    def inputs(self, batch: pa.RecordBatch) -> np.ndarray:
        x = batch.column("x")
        z = (x.flatten().to_numpy().reshape(len(x), -1) - self.x_mean) / self.x_std
        return np.where(np.isnan(z), 0.0, z)


def scale_of(rows: DataFrame, width: int) -> Scale:
    spread = lambda c: [F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")]
    per_input = rows.select(F.posexplode("x").alias("ix", "v")).where("NOT isnan(v)").groupBy("ix").agg(*spread("v"))
    mean, std = np.zeros(width), np.ones(width)
    for r in per_input.collect():  # one row per feature
        mean[r["ix"]], std[r["ix"]] = r["mean"], r["std"] or 1.0
    target = rows.agg(*spread("target")).first()
    return Scale(mean, std, float(target["mean"]), float(target["std"] or 1.0))


def prepared(data: DataFrame, vector: str, p: Params) -> DataFrame:
    """Staged card_id, target, fold and inputs ``x``, laid out by slice."""
    cut = F.when(F.col("target").isNull(), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(F.col("card_id"), F.lit(p.seed)), F.lit(p.slices)).cast("int")
    )
    rows = data.select(
        "card_id",
        F.col("target").cast("double").alias("target"),
        F.col("fold").cast("int").alias("fold"),
        vector_to_array(vector).alias("x"),
        cut.alias("slice"),
    )
    return staged(rows, "network-inputs", partition_by=["slice"])


def _gradients(nets: Mapping[int, np.ndarray], form, scale: Scale):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {m: np.zeros(len(flat)) for m, flat in nets.items()}
        seen = dict.fromkeys(nets, 0)
        weights = {m: unpack(flat, form) for m, flat in nets.items()}
        for batch in batches:
            if not len(batch):
                continue
            x, fold = scale.inputs(batch), batch.column("fold").to_numpy()
            y = (batch.column("target").to_numpy() - scale.y_mean) / scale.y_std
            for m in nets:
                kept = fold != m
                total[m] += gradient(x[kept], y[kept], weights[m])
                seen[m] += int(kept.sum())
        for m, flat in total.items():
            if seen[m]:
                parts = [flat[i : i + CHUNK] for i in range(0, len(flat), CHUNK)]
                yield _vectors([(m, i, seen[m], part) for i, part in enumerate(parts)])

    return run


def _vectors(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["model", "chunk", "n", "g"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int], list] = {}
    for batch in batches:
        for m, i, n, g in zip(*(batch.column(c) for c in ("model", "chunk", "n", "g"))):
            key, g = (m.as_py(), i.as_py()), g.values.to_numpy()
            known = total.get(key, [0, 0.0])
            total[key] = [known[0] + n.as_py(), known[1] + g]
    yield _vectors([(*key, n, g) for key, (n, g) in total.items()])


def _step(rows: DataFrame, nets: Mapping[int, np.ndarray], form, scale: Scale) -> dict[int, np.ndarray]:
    """The mean gradient of every network over these rows outside its fold."""
    schema = "model int, chunk int, n long, g array<double>"
    found = (
        rows.mapInArrow(_gradients(nets, form, scale), schema)
        .repartition("model", "chunk")
        .mapInArrow(_added, schema)
        .orderBy("model", "chunk")
        .toArrow()  # as many numbers as the networks have
    )
    parts: dict[int, list[np.ndarray]] = {}
    for m, n, g in zip(*(found.column(c) for c in ("model", "n", "g"))):
        parts.setdefault(m.as_py(), []).append(g.values.to_numpy() / n.as_py())
    return {m: np.concatenate(p) for m, p in parts.items()}


def _held_out(rows: DataFrame, nets: Mapping[int, np.ndarray], form, scale: Scale) -> dict[int, float]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {m: np.zeros(2) for m in nets}
        for batch in batches:
            if not len(batch):
                continue
            x, fold = scale.inputs(batch), batch.column("fold").to_numpy()
            y = (batch.column("target").to_numpy() - scale.y_mean) / scale.y_std
            for m, flat in nets.items():
                held = fold == m
                gap = forward(x[held], unpack(flat, form))[0] - y[held]
                sums[m] += [(gap**2).sum(), held.sum()]
        columns = [list(sums), [float(s[0]) for s in sums.values()], [float(s[1]) for s in sums.values()]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.float64()))], ["model", "e", "n"]
        )

    found = rows.mapInArrow(run, "model int, e double, n double").groupBy("model").agg(F.sum("e").alias("e"), F.sum("n").alias("n"))
    return {r["model"]: r["e"] / r["n"] for r in found.collect() if r["n"]}


def train(rows: DataFrame, k: int, p: Params = Params()) -> tuple[Scale | None, list[np.ndarray]]:
    """The scale and, per fold, the flat weights of the network that never saw it, from
    ``prepared`` rows. Without a row that has a target there is no scale."""
    known = rows.where("slice >= 0")
    first = known.select("x").first()
    if first is None:
        return None, []
    scale = scale_of(known, len(first["x"]))
    form = shapes(len(first["x"]), p)
    nets = {m: first_weights(form, (p.seed, m)) for m in range(k)}
    best, least = dict(nets), _held_out(known, nets, form, scale)
    # A fold without rows is no one's measure, so its network stays as it is.
    open_ = set(least)
    since, waited, rate = dict.fromkeys(nets, 0), dict.fromkeys(nets, 0), dict.fromkeys(nets, p.rate)
    mean, square = ({m: np.zeros_like(flat) for m, flat in nets.items()} for _ in range(2))
    steps = 0
    for _ in range(p.epochs):
        for part in range(p.slices):
            now = {m: nets[m] for m in sorted(open_)}
            steps += 1
            for m, g in _step(known.where(F.col("slice") == part), now, form, scale).items():
                g = g + p.decay * nets[m]
                mean[m] = 0.9 * mean[m] + 0.1 * g
                square[m] = 0.999 * square[m] + 0.001 * g * g
                up, down = mean[m] / (1 - 0.9**steps), np.sqrt(square[m] / (1 - 0.999**steps)) + 1e-7
                nets[m] = nets[m] - rate[m] * up / down
        for m, e in _held_out(known, {m: nets[m] for m in sorted(open_)}, form, scale).items():
            if e < least[m]:
                best[m], least[m], since[m], waited[m] = nets[m], e, 0, 0
                continue
            since[m], waited[m] = since[m] + 1, waited[m] + 1
            if waited[m] >= p.stall:
                rate[m], waited[m] = max(p.least_rate, rate[m] / 2), 0
            if since[m] >= p.patience:
                open_.discard(m)
        if not open_:
            break
    return scale, [best[m] for m in range(k)]


def predict(rows: DataFrame, scale: Scale | None, nets: Sequence[np.ndarray], p: Params, name: str = "nn") -> DataFrame:
    """card_id, target, fold and the prediction: for a train card that of its fold's network, for
    the others the mean of all. Without a trained network it is null."""
    schema = f"card_id string, target double, fold int, `{name}` double"
    if scale is None:
        return rows.select("card_id", "target", "fold", F.lit(None).cast("double").alias(name))
    form = shapes(len(scale.x_mean), p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [unpack(flat, form) for flat in nets]
        for batch in batches:
            if not len(batch):
                continue
            x, fold = scale.inputs(batch), batch.column("fold").to_numpy()
            every = np.stack([forward(x, w)[0] for w in weights], axis=1) * scale.y_std + scale.y_mean
            own = every[np.arange(len(batch)), np.maximum(fold, 0)]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("card_id", "target", "fold")), pa.array(np.where(fold >= 0, own, every.mean(axis=1)))],
                ["card_id", "target", "fold", name],
            )

    return rows.mapInArrow(run, schema)


def oof_network(data: DataFrame, vector: str, k: int, params: Params = Params(), name: str = "nn") -> DataFrame:
    """card_id, target, fold and out-of-fold predictions of staged ``vectors``."""
    rows = prepared(data, vector, params)
    return predict(rows, *train(rows, k, params), params, name)
