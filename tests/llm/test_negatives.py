"""Hard negatives against all inner products."""

import math
import random

import pytest

from shelfcast.llm import box_tree


def clip(score):
    return min(max(score, -(2**63)), 2**63 - 1)


def plain(rows, every, positives, negatives):
    """``rows``: (id, vector, label); sorted result rows."""
    whole = [
        (i, [math.floor(256 * x) for x in v], lab)
        for i, v, lab in rows
        if i is not None and lab is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (a, va, la) in enumerate(whole):
        if a % every:
            continue
        scored = sorted(
            (-clip(sum(x * y for x, y in zip(va, vb))), b, lb)
            for m, (b, vb, lb) in enumerate(whole)
            if m != n
        )
        for s, p, _ in [h for h in scored if h[2] == la][:positives]:
            ps = -s
            apt = [h for h in scored if h[2] != la and 30 * ps <= -100 * h[0] <= 90 * ps]
            out += [(a, p, r, b, ps, -t) for r, (t, b, _) in enumerate(apt[:negatives], 1)]
    return sorted(out)


def got(spark, rows, every, positives=5, negatives=10, **sizes):
    frame = spark.createDataFrame(
        [(i, v, lab, "u", 1, None) for i, v, lab in rows],
        "vec_id long, embedding array<float>, label int, uid string, shard int, vec string",
    )
    mined = box_tree.mine_negatives(
        frame, anchor_every=every, positives=positives, negatives=negatives, **sizes
    )
    return sorted(map(tuple, mined.collect()))


@pytest.mark.parametrize("sizes", [{}, {"leaf_rows": 3, "shard_rows": 25}])
def test_random_vectors_with_ties_copies_and_a_common_vector(spark, sizes):
    rng = random.Random(5)
    rows = [(i, [round(rng.gauss(0, 1)) / 4 for _ in range(5)], rng.randrange(3)) for i in range(160)]
    rows += [(i, rows[3][1], i % 3) for i in range(160, 230)] + [(8, rows[8][1], 1)]
    rows += [(0, [0.0] * 5, 0), (-8, [1.0] * 5, 2)]
    assert got(spark, rows, 8, **sizes) == plain(rows, 8, 5, 10)


def test_clustered_vectors_are_searched_in_few_leaves(spark):
    rng = random.Random(11)
    centres = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(6)]
    rows = [
        (i, [c + rng.gauss(0, 0.05) for c in centres[i % 6]], i % 12 // 6) for i in range(400)
    ]
    assert got(spark, rows, 10, leaf_rows=8, shard_rows=64) == plain(rows, 10, 5, 10)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [inf, 0.0], 1), (4, [nan], 1),
        (5, [], 1), (None, [1.0], 1), (10, [1.0], None), (20, [1.0, 2.0, 3.0], 1), (6, [0.5, 1.0], 2),
        (7, [-0.004, 0.004, 100.0], 2), (30, [2.0], 2), (40, [], 2),
    ]
    sizes = {"leaf_rows": 1, "shard_rows": 2}
    assert got(spark, rows, 10, **sizes) == plain(rows, 10, 5, 10)
    assert got(spark, rows[:1], 10) == []
    assert got(spark, [], 10) == []


def test_huge_components_are_exact(spark):
    rng = random.Random(3)
    vec = lambda: [float(rng.randint(-8, 8)) * 2.0 ** rng.choice([0, 20, 30]) for _ in range(3)]
    rows = [(i, vec(), i % 3) for i in range(50)]
    rows += [(100, [3e38, 1.0, 0.0], 0), (101, [-3e38, 1.0, 0.0], 1), (102, [2e38, 0.0, 0.0], 1), (103, [1.0, 0.0, 0.0], 0)]
    assert got(spark, rows, 4, 3, 4, leaf_rows=4, shard_rows=10) == plain(rows, 4, 3, 4)


def test_boxes_spare_leaves():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    centres = rng.normal(size=(16, 8))
    rows = np.floor(256 * (np.repeat(centres, 64, axis=0) + 0.02 * rng.normal(size=(1024, 8))))
    table = pa.table(
        {"vec_id": np.arange(1024), "uid": np.arange(1024), "label": np.zeros(1024, int), "vec": list(rows)}
    )
    tree = box_tree.Tree(box_tree.pack_leaves(0, table, 16))
    opened, leaf = [], tree.leaf
    tree.leaf = lambda n: opened.append(n) or leaf(n)
    window = {"request": 0, "low": -(2**63), "high": 2**63 - 1, "floor": None, "floor_id": None}
    wanted = box_tree.Wanted([window], 5)
    tree.search(rows[100], 100, 0, True, wanted)
    scores = rows @ rows[100]
    scores[100] = -np.inf
    assert [-s for s, _, _ in wanted.best[0]] == sorted(scores, reverse=True)[:5]
    assert len(opened) < 16  # of 64
