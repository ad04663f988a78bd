"""Language-model scores: base by plain counts, a proper distribution, gains on held-out texts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import hashed_maxent

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)) + [None]


def scores(spark, pairs, docs_frame, held=lambda i: i is None or i % 5 == 0):
    learns = F.pmod("doc_id", F.lit(5)) != 0
    return hashed_maxent.score_documents(docs_frame(pairs), learns).collect()


def check_base(rows, pairs):
    learned = [t for i, t in pairs if i is not None and i % 5]
    counts = Counter(w for t in learned for w in tokens(t))
    whole, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in pairs:
        ws = tokens(t)
        base = sum(math.log10((counts[w] + 0.1) / (whole + 0.1 * (distinct + 1))) for w in ws)
        want.append((str(i), len(ws), sum(counts[w] > 0 for w in ws), whole, round(base, 6)))
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def two_tongues(rng, number, words=40):
    """Texts of one of two vocabularies each; which one shows from the first words on."""
    out = []
    for i in range(number):
        tongue = rng.choice("ab")
        text = " ".join(f"{tongue}{min(int(rng.expovariate(0.1)), 60)}" for _ in range(rng.randint(5, words)))
        out.append((i, text + rng.choice(["", "\n", " XÉ"])))
    return out


@pytest.mark.parametrize("chunk", [1 << 21, 37])
def test_counts_and_held_out_gain(spark, docs_frame, monkeypatch, chunk):
    monkeypatch.setattr(hashed_maxent, "CHUNK_TOKENS", chunk)
    pairs = two_tongues(random.Random(3), 60 if chunk < 100 else 600)
    rows = scores(spark, pairs, docs_frame)
    check_base(rows, pairs)
    if chunk > 100:
        held = [r for r in rows if not r.learned]
        assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_odd_texts(spark, docs_frame, monkeypatch):
    monkeypatch.setattr(hashed_maxent, "SLICE_BYTES", 8)
    pairs = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "one two"), (5, "unseen words"),
        (6, "w" * 50_000), (7, "A a Ä ä 　 \x1f"), (8, "a " * 3_000),
    ]
    check_base(scores(spark, pairs, docs_frame), pairs)


def test_nothing_to_learn_from(spark, docs_frame):
    assert scores(spark, [], docs_frame) == []
    rows = scores(spark, [(5, "a b"), (None, "c")], docs_frame)
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(0, 0, 0.0, 0.0)] * 2


def test_pieces_keep_their_history(monkeypatch):
    """Rows of weights are the same whether a document is cut or not, and start anew in each."""
    docs = [[f"w{i}" for i in range(23)], [], ["x", "y"], ["z"], [f"v{i}" for i in range(9)]]

    def rows(size):
        monkeypatch.setattr(hashed_maxent, "CHUNK_TOKENS", size)
        chunker, out = hashed_maxent.Chunker(0), []
        made = [c for n, d in enumerate(docs) for c in chunker.add(n, n, True, " ".join(d).encode())]
        made += [chunker.chunk()] if chunker.size else []
        for c in made:
            row = dict(zip([x.split()[0] for x in hashed_maxent.CHUNKS.split(", ")], c))
            row["classes"] = np.zeros(len(row["upper"]) // 4, np.int8).tobytes()
            out.append(hashed_maxent.Batch(row).rows)
        return np.concatenate(out, axis=1)

    whole = rows(1_000)
    for size in (1, 2, 3, 5, 8):
        assert np.array_equal(rows(size), whole)


def test_probabilities_of_all_words_add_up(spark):
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(hashed_maxent.BUCKETS + 1, hashed_maxent.CLASSES)).astype(np.float32)
    rows = rng.integers(0, hashed_maxent.BUCKETS, size=(4, 20))
    logs = hashed_maxent.log_probabilities(weights, weights[-1], rows)
    assert np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5)


def test_discarded_tables_are_gone_and_others_stay(spark, tmp_path):
    from shelfcast.durable import settle
    from shelfcast.llm.scratch import discard

    mine, other = settle(spark.range(5), "gone"), settle(spark.range(7), "stays")
    spark.range(3).write.parquet(f"{tmp_path}/given")
    given = spark.read.parquet(f"{tmp_path}/given")
    discard(mine)
    discard(given)  # not below the shared folder
    assert other.count() == 7 and given.count() == 3
    assert not spark.read.format("binaryFile").option("pathGlobFilter", "*").load(
        other.inputFiles()[0].rsplit("/", 2)[0]
    ).where("path like '%gone-%'").count()


def test_gradients_of_equal_rows_are_added_as_numpy_does():
    """Bit by bit what ``reduceat`` gives, over groups of one row up to many."""
    rng = np.random.default_rng(7)
    for sizes in ([1], [9], [1, 2, 3, 7, 8, 9, 10, 200, 1, 1, 2], rng.integers(1, 30, 200), [1] * 50, [8] * 5):
        ends = np.cumsum(sizes)
        values = rng.normal(size=(ends[-1], 33)).astype(np.float32)
        order, starts = rng.permutation(ends[-1]), ends - np.array(sizes)
        want = np.add.reduceat(values[order], starts, axis=0)
        assert np.array_equal(hashed_maxent.group_sums(values, order, starts), want)
