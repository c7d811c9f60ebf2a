"""Vector codes: vectors cut into parts, each part named by its nearest codebook entry.

The codebooks are trained by Lloyd's rounds over all vectors, in whole numbers, so the
result does not depend on how the rows lie. Spark partitions the vectors; a round is one
pass of tasks that send their sums per entry, which Spark adds up; only sums (entries x
components) come to the driver.

Inside a task the parts of a batch and the entries of the codebook each form a tree of
bounding boxes: leaves in the order of interleaved coordinate bits, every node the box of
its two children. Both trees are walked together from their roots. Of the pairs (node of
parts, node of entries) those are dropped whose smallest possible distance exceeds the
largest possible one of another pair of the same node of parts. A node left with one
entry is assigned as a whole, its sum being the difference of two cached running sums. Leaves
with several entries left compute their distances in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import staged

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
LEAF = 8
# Whole numbers up to this size are handled in 64 bits, larger ones as Python's.
NARROW = 1 << 26
LIMB = 32
# Differences of components held at once.
AT_ONCE = 1 << 22


def _order(points: np.ndarray) -> np.ndarray:
    """The order of points along a curve that interleaves the bits of their coordinates."""
    n, width = points.shape
    bits = max(1, min(16, 62 // width))
    low, high = points.min(axis=0), points.max(axis=0)
    size = np.array([max(1, int(h) - int(l)) for l, h in zip(low, high)], points.dtype)
    cell = ((points - low) * ((1 << bits) - 1) // size).astype(np.int64)
    key = np.zeros(n, np.int64)
    for b in reversed(range(bits)):
        for d in range(min(width, 62)):
            key = (key << 1) | ((cell[:, d] >> b) & 1)
    return np.argsort(key, kind="stable")


class _Tree:
    """Boxes over ordered points, ``leaf`` of them in a leaf; ``low[k]`` and ``high[k]``
    hold the 2^k boxes of level k. Points are repeated at the end to fill the last leaves."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = _order(points)
        self.points = points[self.order]
        leaves = -(-len(points) // leaf)
        self.depth = max(0, (leaves - 1).bit_length())
        at = np.minimum(np.arange(leaf << self.depth), len(points) - 1)
        boxes = self.points[at].reshape(-1, leaf, points.shape[1])
        self.low, self.high = [boxes.min(axis=1)], [boxes.max(axis=1)]
        for _ in range(self.depth):
            self.low.insert(0, np.minimum(self.low[0][::2], self.low[0][1::2]))
            self.high.insert(0, np.maximum(self.high[0][::2], self.high[0][1::2]))


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sum of the squared larger ends."""
    return _squares(np.maximum(low, high))


def _squares(gap: np.ndarray) -> np.ndarray:
    """Sum of squares along the last axis."""
    return np.einsum("...i,...i->...", gap, gap)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(entry of each point, sums of the points of each entry, counts)``, by a walk
    down both trees. Of entries equally near the one with the lowest index is taken."""
    n, width = points.shape
    # Equal entries tie everywhere; the first of them stands for all.
    known: dict[tuple, int] = {}
    for i, e in enumerate(map(tuple, entries.tolist())):
        known.setdefault(e, i)
    kept = np.array(list(known.values()))
    near, far = _Tree(points, LEAF), _Tree(entries[kept], 1)
    index = kept[far.order]
    total = np.zeros((n + 1, width), points.dtype)
    total[1:] = np.cumsum(near.points, axis=0)
    found = np.zeros(n, np.int64)
    sums, counts = np.zeros((len(entries), width), points.dtype), np.zeros(len(entries), np.int64)

    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs, those of one node together
    p = q = 0  # levels of the two trees
    while len(a):
        gap = np.maximum(near.low[p][a] - far.high[q][b], far.low[q][b] - near.high[p][a])
        least = _spread(np.zeros_like(gap), gap)
        most = _spread(near.high[p][a] - far.low[q][b], far.high[q][b] - near.low[p][a])
        first = np.flatnonzero(np.diff(a, prepend=-1))
        size = np.diff(first, append=len(a))
        keep = least <= np.repeat(np.minimum.reduceat(most, first), size)
        if q == far.depth:  # the boxes that only fill up the last level repeat an entry
            keep &= b < len(index)
        a, b = a[keep], b[keep]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        size = np.diff(first, append=len(a))
        if q == far.depth:
            sure = size == 1
            for node, entry in zip(a[first[sure]], b[first[sure]]):
                begin = min(n, int(node) * (LEAF << (near.depth - p)))
                end = min(n, (int(node) + 1) * (LEAF << (near.depth - p)))
                i = index[entry]
                found[begin:end] = i
                sums[i] += total[end] - total[begin]
                counts[i] += end - begin
            open_ = np.repeat(~sure, size)
            a, b = a[open_], b[open_]
            if p == near.depth:
                break
        if p < near.depth:
            a = np.stack([2 * a, 2 * a + 1], axis=1)
            b = np.stack([b, b], axis=1)
            p += 1
        else:
            a, b = a[:, None], b[:, None]
        if q < far.depth:
            a = np.concatenate([a, a], axis=1)
            b = np.concatenate([2 * b, 2 * b + 1], axis=1)
            q += 1
        a, b = a.ravel(), b.ravel()
        by_node = np.argsort(a, kind="stable")
        a, b = a[by_node], b[by_node]
        inside = a * (LEAF << (near.depth - p)) < n  # nodes of nothing but filling
        a, b = a[inside], b[inside]

    # Leaves with several entries left, a bounded number of differences at once.
    many = max(1, AT_ONCE // (LEAF * width * max(1, len(index))))
    for leaves in np.split(np.unique(a), range(many, len(np.unique(a)), many)):
        if not len(leaves):
            break
        begin, end = np.searchsorted(a, leaves[0]), np.searchsorted(a, leaves[-1], "right")
        x, y = a[begin:end], b[begin:end]
        first = np.flatnonzero(np.diff(x, prepend=-1))
        size = np.diff(first, append=len(x))
        at = x[:, None] * LEAF + np.arange(LEAF)
        away = _squares(near.points[np.minimum(at, n - 1)] - far.points[y][:, None, :])
        best = np.minimum.reduceat(away, first, axis=0)
        name = np.where(away == np.repeat(best, size, axis=0), index[y][:, None], len(entries))
        name = np.minimum.reduceat(name, first, axis=0)
        at = at[first]
        at, name = at[at < n], name[at < n]
        found[at] = name
        np.add.at(sums, name, near.points[at])
        np.add.at(counts, name, 1)
    out = np.empty(n, np.int64)
    out[near.order] = found
    return out, sums, counts


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(256 x), exact for every finite double."""
    if not len(values) or np.abs(values).max() < NARROW / SCALE:
        return np.floor(values.astype(np.float64) * SCALE).astype(np.int64)
    big = [int(x) * SCALE if abs(x) >= 2**53 else math.floor(x * SCALE) for x in values.tolist()]
    return np.array(big, object)


def _batches(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple]:
    """``(batch, which rows have dim components, their whole numbers by part)``; the
    components are filled up with zeros to a multiple of the number of parts."""
    for batch in batches:
        lists = batch.column("vector")
        good = lists.value_lengths().to_numpy(zero_copy_only=False) == dim
        flat = lists.filter(pa.array(good)).flatten().to_numpy()
        rows, width = int(good.sum()), -(-dim // PARTS)
        numbers = np.zeros((rows, width * PARTS), np.int64)
        whole = _whole(flat)
        if whole.dtype == object:
            numbers = numbers.astype(object)
        numbers[:, :dim] = whole.reshape(rows, dim)
        yield batch, good, numbers.reshape(rows, PARTS, width)


def _typed(points: np.ndarray, entries: list) -> tuple[np.ndarray, np.ndarray]:
    wide = points.dtype == object or max((abs(x) for e in entries for x in e), default=0) >= NARROW
    kind = object if wide else np.int64
    return points.astype(kind), np.array(entries, kind)


def _sums(books: list, dim: int):
    """``(part, entry, place, limb, value)``: sums of the parts of each entry in limbs of
    32 bits, so that adding many never overflows; place -1 counts the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for _, _, numbers in _batches(batches, dim):
            if not len(numbers):
                continue
            for part, book in enumerate(books):
                _, sums, counts = nearest(*_typed(numbers[:, part], book))
                for entry in np.flatnonzero(counts):
                    for place, x in enumerate([counts[entry], *sums[entry]], -1):
                        key = part, int(entry), place
                        total[key] = total.get(key, 0) + int(x)
        rows = []
        for key, x in total.items():
            sign, x, limb = (-1 if x < 0 else 1), abs(x), 0
            while x:
                rows.append((*key, limb, sign * (x & ((1 << LIMB) - 1))))
                x, limb = x >> LIMB, limb + 1
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "limb", "value"]
        )

    return run


def _coded(books: list, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, good, numbers in _batches(batches, dim):
            found = np.zeros((len(numbers), PARTS), np.int64)
            error = np.zeros(len(numbers), object)
            for part, book in enumerate(books):
                if len(numbers):
                    points, entries = _typed(numbers[:, part], book)
                    found[:, part], _, _ = nearest(points, entries)
                    gap = points - entries[found[:, part]]
                    error += _squares(gap).astype(object)
            codes = np.full(len(good), None, object)
            errors = np.full(len(good), None, object)
            codes[good] = ["".join(f"{i:02x}" for i in row) for row in found.tolist()]
            errors[good] = [int(e) if e < 1 << 63 else None for e in error]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array(codes, pa.string()),
                    pa.array(errors, pa.int64()),
                ],
                ["vec_id", "label", "code", "error"],
            )

    return run


def usable(vector: Column) -> Column:
    """Not null, and no component null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def train(rows: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, list]:
    """``(components, codebooks)``: a list of entries, lists of whole numbers, for each
    part. They start as the parts of the ``entries`` smallest ``vec_id`` (of equal ones
    the smaller vector first, null ids last). ``rows(vec_id, vector)`` are usable."""
    first = (
        rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    )
    if not first:
        return 0, []
    dim = len(first[0]["vector"])
    width = -(-dim // PARTS)
    books: list[list[list[int]]] = [[] for _ in range(PARTS)]
    for row in first:
        if len(row["vector"]) == dim:
            numbers = [int(x) for x in _whole(np.array(row["vector"], np.float64))]
            numbers += [0] * (width * PARTS - dim)
            for part, book in enumerate(books):
                book.append(numbers[part * width : (part + 1) * width])
    for _ in range(rounds):
        found = (
            rows.select("vector")
            .mapInArrow(_sums(books, dim), "part long, entry long, place long, limb long, value long")
            .groupBy("part", "entry", "place", "limb")
            .agg(F.sum("value").alias("value"))
            .collect()  # at most entries x components x limbs
        )
        total: dict[tuple[int, int, int], int] = {}
        for r in found:
            key = r["part"], r["entry"], r["place"]
            total[key] = total.get(key, 0) + (r["value"] << (LIMB * r["limb"]))
        for (part, entry, place), count in total.items():
            if place == -1:
                books[part][entry] = [
                    total.get((part, entry, k), 0) // count for k in range(width)
                ]
    return dim, books


def digest_text(books: list) -> str:
    """All whole numbers by part, entry and place, with commas between."""
    return ",".join(str(x) for book in books for entry in book for x in entry)


def encode(rows: DataFrame, dim: int, books: list) -> DataFrame:
    """``vec_id, label, code, error`` of usable ``rows(vec_id, label, vector)``."""
    return rows.select("vec_id", "label", "vector").mapInArrow(
        _coded(books, dim), "vec_id long, label long, code string, error long"
    )


def vector_codes(
    vectors: DataFrame,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable row.

    A row is left out if its vector is null or holds a component that is null or not
    finite. ``code`` has two hex digits per part (``entries`` is at most 256), ``error``
    is the sum of the squared distances, ``label_error`` that of all rows with an equal
    label, null being one. A component x is the whole number floor(256 x).

    The number of components is that of the vector with the smallest id; a vector of
    another length stays, with a null code and error. Components that 16 does not divide
    are filled up with zeros. A sum that no long holds is null in ``error`` and not
    counted in ``label_error``. Repeated rows come out as often as they came in; ids may be null. An
    empty table, or one without a usable vector, gives no rows. Other columns are not read.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").alias("vector"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
    ).where(usable(F.col("vector")))
    dim, books = train(rows, entries, rounds)
    codes = staged(encode(rows, dim, books), "vector_codes")
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.withColumnRenamed("label", "of")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id",
        "code",
        "error",
        "label_error",
        F.sha2(F.lit(digest_text(books)), 256).alias("codebooks_sha256"),
    )
