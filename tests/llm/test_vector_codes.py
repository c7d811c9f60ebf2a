import hashlib
import math
import random

import numpy as np
import pytest

from cardloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error int"


def plain(rows, entries=64, rounds=2):
    """The same by comparing every part with every entry."""
    kept = [
        (i, v, lab)
        for i, v, lab in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(kept[0][1])
    width = -(-dim // 16)

    def parts(v):
        n = [int(x) * 256 if abs(x) >= 2**53 else math.floor(x * 256) for x in v]
        n += [0] * (width * 16 - dim)
        return [n[p * width : (p + 1) * width] for p in range(16)]

    cut = [parts(v) if len(v) == dim else None for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries] if c] for p in range(16)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            of = [[] for _ in book]
            for c in cut:
                if c:
                    of[best(c[p], book)[1]].append(c[p])
            books[p] = [[sum(x) // len(g) for x in zip(*g)] if g else e for g, e in zip(of, book)]
    out, label = [], {}
    for (i, _, lab), c in zip(kept, cut):
        found = [best(c[p], books[p]) for p in range(16)] if c else None
        error = sum(d for d, _ in found) if found else None
        if error is not None and error >= 1 << 63:
            error = None
        out.append([i, "".join(f"{k:02x}" for _, k in found) if found else None, error, lab])
        if error is not None:
            label[lab] = label.get(lab, 0) + error
    text = ",".join(str(x) for b in books for e in b for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return [(i, c, e, label.get(lab), sha) for i, c, e, lab in out]


def same(spark, rows, entries=64, rounds=2):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = vc.vector_codes(frame, entries, rounds).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows, entries, rounds), key=str)


def test_against_comparing_everything(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(64)], rng.choice([1, 2, None])) for i in range(900)]
    same(spark, rows)
    # ties: few different values, repeated vectors, and entries that are equal
    few = [(i // 2, [rng.choice([0.0, 0.25, -0.25]) for _ in range(32)], 3) for i in range(300)]
    same(spark, few)


def test_odd_vectors(spark):
    rng = random.Random(6)
    usual = [(i, [rng.gauss(0, 1) for _ in range(20)], i % 2) for i in range(40)]
    odd = [
        (100, None, 1),
        (101, [None] * 20, 1),
        (102, [float("nan")] * 20, 1),
        (103, [float("inf")] * 20, 1),
        (104, [0.5] * 3, 7),
        (105, [], 7),
        (None, [0.5] * 20, None),
        (3, [0.5] * 20, 1),
        (106, [1e30, -1e30] * 10, 8),
        (107, [1e6 + 0.3] * 20, 8),
    ]
    same(spark, usual + odd, entries=8)
    same(spark, usual[:3])
    assert vc.vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []
    none = spark.createDataFrame([(1, None, 1, "x", 1)], SCHEMA)
    assert vc.vector_codes(none).collect() == []


@pytest.mark.parametrize("n, entries, width", [(1, 1, 1), (17, 3, 2), (1000, 64, 4), (257, 5, 70)])
def test_walk_of_both_trees(n, entries, width):
    rng = np.random.default_rng(n)
    points = np.concatenate(
        [rng.integers(-40, 40, (n, width)), rng.integers(-3, 3, (n, width)) + 500]
    )
    book = np.concatenate([rng.integers(-40, 40, (entries, width)), points[-1:], points[-1:]])
    found, sums, counts = vc.nearest(points, book)
    away = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    assert (found == away.argmin(axis=1)).all()
    assert (counts == np.bincount(found, minlength=len(book))).all()
    assert all((sums[k] == points[found == k].sum(axis=0)).all() for k in range(len(book)))


def test_nodes_are_assigned_whole():
    """Where clusters lie far apart no leaf is compared point by point."""
    rng = np.random.default_rng(1)
    points = (rng.integers(0, 4, (64, 16, 3)) + np.arange(64)[:, None, None] * 1000).reshape(-1, 3)
    book = np.arange(64)[:, None] * 1000 + np.zeros((64, 3), np.int64)
    found, _, counts = vc.nearest(points, book)
    assert (found == np.repeat(np.arange(64), 16)).all() and (counts == 16).all()
