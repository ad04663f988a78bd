"""Codes and codebooks against plain Lloyd rounds."""

import math
import random

import pytest

from shelfcast.llm import resident_lloyd


def plain(rows, parts, entries, rounds, scale=1024):
    """``rows``: (id, vector, label); sorted (id, label, entries, error), and the codebooks."""
    kept = [
        (i, [math.floor(scale * x) for x in v], lab)
        for i, v, lab in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), lab) for i, v, lab in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(v, p):
        gaps = [sum((a - b) ** 2 for a, b in zip(cut(v, p), c)) for c in books[p]]
        return min(zip(gaps, range(len(gaps))))

    for _ in range(rounds):
        found = [[nearest(v, p)[1] for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), f in zip(kept, found) if f[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for i, v, lab in kept:
        near = [nearest(v, p) for p in range(parts)]
        error = min(sum(min(d, 2**63 - 1) for d, _ in near), 2**63 - 1)
        out.append((i, lab, [e for _, e in near], error))
    return out, books


def check(spark, rows, parts=4, entries=6, rounds=4):
    frame = spark.createDataFrame(
        [(i, v, lab, "u", 1, 2) for i, v, lab in rows],
        "vec_id long, embedding array<float>, label int, uid string, entry int, position int",
    )
    coded, books = resident_lloyd.compress(frame, parts=parts, entries=entries, rounds=rounds)
    want, want_books = plain(rows, parts, entries, rounds)
    key = lambda r: tuple(map(str, r))
    got = [(r.vec_id, r.label, r.entries, r.error) for r in coded.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert books == want_books
    errors = {}
    for _, lab, _, error in want:
        errors[lab] = min(errors.get(lab, 0) + error, 2**63 - 1)
    summed = resident_lloyd.label_errors(coded).collect()
    assert len(summed) == len(want) and all(r.label_error == errors[r.label] for r in summed)
    return books


def test_random_vectors_with_ties_and_a_common_vector(spark, monkeypatch):
    monkeypatch.setattr(resident_lloyd, "OWNER_ROWS", 16)
    rng = random.Random(4)
    rows = [(i, [round(rng.gauss(0, 2)) / 8 for _ in range(8)], i % 3) for i in range(200)]
    rows += [(i, rows[9][1], None) for i in range(200, 300)] + [(5, rows[6][1], 1)]
    rows += [(None, rows[7][1], 2), (-4, [0.0] * 8, None)]
    rng.shuffle(rows)
    check(spark, rows)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None, 1)],
        [(3, [], 1), (4, [], None)],
        [(1, [1.0, None], 1), (2, [float("inf")], 1), (3, [1.0, 2.0, 3.0], 1), (4, [0.5], None), (5, [], 2),
         (6, [1.0, 2.0, 3.0, 4.0, 5.0], 2)],
    ],
)
def test_odd_tables(spark, rows):
    check(spark, rows)


def test_huge_components_are_exact(spark):
    rng = random.Random(8)
    vec = lambda: [float(rng.randint(-9, 9)) * 2.0 ** rng.choice([0, 30, 60]) for _ in range(4)]
    rows = [(i, vec(), i % 2) for i in range(40)] + [(90, [2.0**127, 1.0, 0.5, -0.5], 1)]
    check(spark, rows)


def test_only_changed_parts_pass_the_exchange(spark):
    rows = [(i, [float(i % 7), 0.0, float(i % 5), 1.0], 0) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    numbered = frame.selectExpr("vec_id as uid", "cast(embedding as array<double>) as vec")
    books = [[[i] for i in range(7)] for _ in range(4)]
    assigned = resident_lloyd.cut_and_assign(numbered, books, 1)
    assert assigned.where("not moved").count() == 0
    again = resident_lloyd.reassign(resident_lloyd.migrate(assigned), books)
    assert again.where("moved").count() == 0 and again.count() == 240
