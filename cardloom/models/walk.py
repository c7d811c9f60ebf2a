"""Rows of large Arrow batches walked down a tree node by node, not row by row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.sources.staging import staged

# Rows taken together, so that a call of array code has enough of them.
ROWS = 1 << 15
# Bytes of features in a block at most.
BLOCK = 1 << 21
# Levels on which a node's rows are a mask over all rows; below, they are positions.
MASKED = 5


def joined(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in batches of at least ``rows`` but for the last; none is empty."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if len(batch):
            kept.append(batch)
        if sum(map(len, kept)) >= rows:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
            kept = []
    if kept:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()


def reached(tree, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The leaves of ``tree`` that any of the rows of ``x`` (best in Fortran order) come to, and the
    positions of these rows, ascending. A value above the cut goes right, any other left."""
    todo = [(0, 0, np.ones(len(x), bool))]
    while todo:
        node, level, at = todo.pop()
        j = tree.feature[node]
        if at.dtype == bool and (j < 0 or level >= MASKED):
            at = np.flatnonzero(at)
        if j < 0:
            if len(at):
                yield node, at
        elif at.dtype == bool:
            right = x[:, j] > tree.cut[node]
            right &= at
            todo += [(tree.left[node], level + 1, at ^ right), (tree.left[node] + 1, level + 1, right)]
        elif len(at):
            goes = x[:, j][at] > tree.cut[node]
            todo += [(tree.left[node], level + 1, at[~goes]), (tree.left[node] + 1, level + 1, at[goes])]


def values(tree, x: np.ndarray) -> np.ndarray:
    """The value of every row's leaf."""
    out = np.zeros(len(x))
    for node, at in reached(tree, x):
        out[at] = tree.value[node]
    return out


def blocks(
    rows: DataFrame, matrix: Callable[[pa.RecordBatch], np.ndarray], column: str, name: str, cards: bool = False
) -> DataFrame:
    """Staged target, fold and the features made by ``matrix`` from ``column``, a block of rows per record: a
    pass then moves arrays and not row after row. With ``cards`` also the card_ids. Rows without target are left out."""
    more = ["card_id"] if cards else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined(batches):
            x = matrix(batch)
            size = max(1, min(len(x), BLOCK // max(1, x[:1].nbytes)))
            for start in range(0, len(x), size):
                part = batch.slice(start, size)
                made = [part.column(c).to_numpy().tobytes() for c in ("target", "fold")]
                made.append(x[start : start + size].tobytes("F"))
                ids = [pa.array([part.column(c).to_pylist()], pa.list_(pa.string())) for c in more]
                yield pa.RecordBatch.from_arrays([*(pa.array([b], pa.binary()) for b in made), *ids], ["target", "fold", "x", *more])

    known = rows.where("target IS NOT NULL").select("target", F.col("fold").cast("int").alias("fold"), column, *more)
    schema = ", ".join(["target binary, fold binary, x binary", *(f"{c} array<string>" for c in more)])
    return staged(known.mapInArrow(run, schema), name)


def opened(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, dict]]:
    """Features (Fortran order, ``kind``), targets and folds of each block, and its record."""
    for batch in batches:
        for i in range(len(batch)):
            record = {c: batch.column(c)[i] for c in batch.schema.names}
            y, fold, x = (
                np.frombuffer(record[c].as_buffer(), t) for c, t in (("target", float), ("fold", np.int32), ("x", kind))
            )
            yield x.reshape((len(y), -1), order="F"), y, fold, record
