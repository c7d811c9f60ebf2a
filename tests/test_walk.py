import numpy as np
import pyarrow as pa
import pytest

from cardloom.models import boosting, extra_trees, walk


def grown(make, rng, depth, width, cut):
    """A tree whose nodes are cut at random, and not all to the same depth."""
    tree, level = make(), [0]
    for _ in range(depth):
        following = []
        for node in level:
            if node and rng.random() < 0.2:
                continue
            tree.feature[node], tree.cut[node] = int(rng.integers(width)), cut()
            tree.left[node] = len(tree.feature)
            for _ in range(2):
                following.append(len(tree.feature))
                tree.feature.append(-1), tree.cut.append(0), tree.left.append(0)
                tree.value.append(float(rng.normal()))
        level = following
    return tree


def leaf(tree, row):
    node = 0
    while tree.feature[node] >= 0:
        node = tree.left[node] + bool(row[tree.feature[node]] > tree.cut[node])
    return node


@pytest.mark.parametrize("depth", [0, 2, 5, 6, 9])
def test_walk_equals_row_by_row(depth):
    rng = np.random.default_rng(depth)
    x = rng.normal(size=(700, 4))
    x[::7, 1], x[5], x[6] = np.nan, np.inf, -np.inf
    bins = rng.integers(0, 64, (700, 4)).astype(np.uint8)
    for rows, tree in (
        (x, grown(lambda: extra_trees.Tree(0), rng, depth, 4, lambda: float(rng.normal()))),
        (bins, grown(boosting.Tree, rng, depth, 4, lambda: int(rng.integers(64)))),
    ):
        want = [leaf(tree, r) for r in rows]
        for order in (rows, np.asfortranarray(rows)):
            found = dict(walk.reached(tree, order))
            assert {n: list(at) for n, at in found.items()} == {n: [i for i, w in enumerate(want) if w == n] for n in set(want)}
            assert list(tree.values(order)) == [tree.value[n] for n in want]
    assert len(tree.values(bins[:0])) == 0


def test_joined_keeps_rows_and_order():
    sizes = [3, 0, 4, 1, 9, 0]
    batches = [pa.RecordBatch.from_arrays([pa.array([f"{k}.{i}" for i in range(n)], pa.string())], ["c"]) for k, n in enumerate(sizes)]
    out = list(walk.joined(iter(batches), 6))
    assert [len(b) for b in out] == [7, 10]
    assert [v for b in out for v in b.column("c").to_pylist()] == [f"{k}.{i}" for k, n in enumerate(sizes) for i in range(n)]
    assert list(walk.joined(iter(batches[1:2]))) == []


def test_a_pass_moves_blocks_and_not_rows(spark):
    rows = [(f"c{i}", None if i % 10 == 0 else float(i), -1 if i % 10 == 0 else i % 3, [i / 2, float("nan")]) for i in range(5000)]
    df = spark.createDataFrame(rows, "card_id string, target double, fold long, x array<double>").repartition(2)
    blocks = walk.blocks(df, extra_trees._matrix, "x", "test-blocks", cards=True)
    assert blocks.count() <= 2
    back = {}
    for x, y, fold, record in walk.opened(blocks.toArrow().to_batches(), float):
        assert x.flags.f_contiguous
        back |= {c: (t, f, r[0], bool(np.isnan(r[1]))) for c, t, f, r in zip(record["card_id"].as_py(), y, fold, x)}
    assert back == {c: (t, f, x[0], True) for c, t, f, x in rows if t is not None}


def test_blocks_of_wide_rows_are_bounded(spark):
    wide = walk.BLOCK // 8 // 20
    df = spark.range(90, numPartitions=1).selectExpr(
        "cast(id AS double) AS target", "cast(id % 2 AS int) AS fold", f"transform(sequence(1, {wide}), i -> cast(i + id AS double)) AS x"
    )
    blocks = walk.blocks(df, extra_trees._matrix, "x", "test-wide")
    found = list(walk.opened(blocks.toArrow().to_batches(), float))
    assert len(found) >= 5 and all(x.nbytes <= walk.BLOCK for x, *_ in found)
    assert sorted(t for _, y, *_ in found for t in y) == list(range(90))
    assert all((x == y[:, None] + np.arange(1, wide + 1)).all() for x, y, *_ in found)
