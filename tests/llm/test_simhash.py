"""Fingerprints, links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from shelfcast.llm import anchor_simhash as sim


def plain_fingerprint(text, words_each=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    if not words:
        return 0
    shingles = [words[i : i + words_each] for i in range(max(1, len(words) - words_each + 1))]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(pairs, bits=2):
    """Smallest doc_id reachable, by fingerprint."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    values = np.array(fps, np.uint64)
    for f in fps:
        for g in values[np.bitwise_count(values ^ np.uint64(f)) <= bits].tolist():
            root[find(f)] = find(g)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return {f: least.get(find(f)) for f in fps}


TEXTS = ["", " \n", None, "one", "One TWO", "a b c", "A\tb\x0bC", "ÀB éc x y \x1cz w", "a b " * 500]


def test_fingerprints():
    for text in TEXTS:
        for words_each in (1, 3, 5):
            assert sim.fingerprint(text, words_each) == plain_fingerprint(text, words_each)


def test_every_word_has_one_home_and_pairs_meet_there():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    cover = sim.Cover(2)
    anchors, owners, home = cover.anchors(fps)
    assert home.sum() == len(fps)
    homes = dict(zip(owners[home].tolist(), anchors[home].tolist()))
    for _ in range(4):
        shift = [int(rng.integers(64)), int(rng.integers(64))]
        moved = fps ^ np.uint64(1 << shift[0] | 1 << shift[1])
        got, who, _ = cover.anchors(moved)
        reach = set(zip(who.tolist(), got.tolist()))
        assert all((m, homes[f]) in reach for f, m in zip(fps.tolist(), moved.tolist()))


@pytest.mark.parametrize("large_pool", [4, 16_384])
def test_links_connect_what_pairs_connect(spark, monkeypatch, large_pool):
    rng = random.Random(large_pool)
    fps = {0, 1, 7}
    for _ in range(25):  # chains and clouds around centres
        f = rng.getrandbits(64)
        for _ in range(40):
            fps.add(f)
            f ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    pairs = [(i, f) for i, f in enumerate(sorted(fps, key=lambda f: hash((f, 1))))]
    want = plain_components(pairs)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    # the comparing function alone, for the lookup by flipped bits
    monkeypatch.setattr(sim, "LARGE_POOL", large_pool)
    values = np.array(sorted(fps), np.uint64)
    a, b = sim.group_links(values, values[:0], 2)
    grouped = {}
    for x, y in zip(np.concatenate(a).tolist(), np.concatenate(b).tolist()):
        grouped.setdefault(x, set()).add(y)
    assert all(want[x] == want[y] for x in grouped for y in grouped[x])
    assert sum(len(v) for v in grouped.values()) == len(fps) - len(set(want.values()))
    if large_pool > 4:
        marked = spark.createDataFrame([(i, signed(f)) for i, f in pairs], "doc_id long, fp long")
        got = sim.components(marked).collect()
        assert {r.fp % (1 << 64): r.component_id for r in got} == want


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901)], "a long, b long")
    roots = {r.node: r.root for r in sim.connect(edges).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and roots[900] == roots[901] != roots[0]


def test_op8_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    pairs = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    component = plain_components(pairs)
    got = entry.queries()["op8_anchor_simhash"](spark, sf).collect()
    want = sorted((i, f"{f:016x}", component[f]) for i, f in pairs)
    assert sorted(map(tuple, got)) == want


def test_odd_rows(spark, docs_frame):
    pairs = [(5, ""), (3, None), (None, " "), (9, "a b c d"), (9, "a b c d"), (None, "p q r s")]
    docs = docs_frame(pairs)
    got = [tuple(r)[::2] for r in sim.near_duplicates(docs).collect()]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(got, key=key) == sorted(
        [(5, 3), (3, 3), (None, 3), (9, 9), (9, 9), (None, None)], key=key
    )
    kept = sim.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "p q r s"), (3, ""), (9, "a b c d"),
    ]
    assert sim.near_duplicates(docs_frame([])).count() == 0
    assert sim.keep_one(docs_frame([])).count() == 0
