"""Top-k against all inner products."""

import math
import random

import pytest

from shelfcast.llm import block_topk


def plain(rows, every, top):
    """``rows``: (id, vector); the results of each query row as sorted tuples."""
    whole = [
        (i, v, [math.floor(64 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (q, _, a) in enumerate(whole):
        if q % every:
            continue
        scores = [
            (-min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), c)
            for m, (c, _, b) in enumerate(whole)
            if m != n
        ]
        for rank, (score, c) in enumerate(sorted(scores)[:top], 1):
            out.append((q, rank, c, -score))
    return sorted(out)


def got(spark, rows, every, top, **sizes):
    frame = spark.createDataFrame(
        [(i, v, "r", 1) for i, v in rows], "vec_id long, embedding array<float>, uid string, shard int"
    )
    return sorted(map(tuple, block_topk.top_products(frame, query_every=every, top=top, **sizes).collect()))


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 4, "shard_rows": 20, "cell_queries": 3}])
def test_random_vectors_with_ties_and_copies(spark, sizes):
    rng = random.Random(7)
    rows = [(i, [round(rng.gauss(0, 1)) / 4 for _ in range(6)]) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(150, 190)] + [(5, rows[5][1])]
    rows += [(0, [0.0] * 6), (-5, [1.0] * 6)]
    assert got(spark, rows, 5, 4, **sizes) == plain(rows, 5, 4)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [inf, 0.0]), (4, [nan]), (5, []),
        (None, [1.0]), (10, [1.0]), (20, [1.0, 2.0, 3.0]), (7, [-0.004, 0.004, 100.0]),
    ]
    sizes = {"block_rows": 1, "shard_rows": 2, "cell_queries": 1}
    assert got(spark, rows, 10, 20, **sizes) == plain(rows, 10, 20)
    assert got(spark, rows[:1], 10, 20) == []
    assert got(spark, [], 10, 20) == []


def test_huge_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-8, 8)) * 2.0 ** rng.choice([0, 20, 30]) for _ in range(3)]) for i in range(40)]
    rows += [(100, [3e38, 1.0, 0.0]), (101, [-3e38, 1.0, 0.0])]
    sizes = {"block_rows": 4, "shard_rows": 10, "cell_queries": 4}
    assert got(spark, rows, 4, 5, **sizes) == plain(rows, 4, 5)
