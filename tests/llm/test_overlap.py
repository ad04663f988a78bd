"""Near-dedup by shingle overlap against all pairs."""

import random

import corpus_pipeline
from shelfcast.llm import anchor_simhash, shingle_overlap


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(pairs):
    """Ids that stay: the smallest of each component of pairs at 0.8 or more."""
    sets, root = [plain_set(t) for _, t in pairs], list(range(len(pairs)))
    for i in range(len(pairs)):
        for j in range(i):
            both, all_of = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both >= 0.8 * all_of:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return sorted(min(pairs[i][0] for i in range(len(pairs)) if root[i] == r) for r in set(root))


def variants(rng, n, words):
    """Texts of one kind, with some words changed in each."""
    text, out = [f"w{rng.randrange(900)}" for _ in range(words)], []
    for _ in range(n):
        new = list(text)
        for _ in range(rng.randint(0, words // 60)):
            new[rng.randrange(words)] = f"x{rng.randrange(900)}"
        out.append(" ".join(new))
        if rng.random() < 0.4:
            text = new  # a chain
    return out


def test_stage_keeps_one_of_similar_documents(spark, docs_frame):
    rng = random.Random(4)
    texts = ["", None, "Few words", "few  WORDS", "few words more"]
    for n, words in ((2, 100), (2, 400), (40, 130), (3, 60), (12, 300)):
        texts += variants(rng, n, words)
    # four shared fifths at 0.8 or just below
    base = [f"v{i}" for i in range(204)]
    texts += [" ".join(base), " ".join(base[:-25] + ["z"] * 25), " ".join(base[:-10] + ["y"] * 10)]
    rng.shuffle(texts)
    pairs = list(enumerate(texts))
    stage = dict(corpus_pipeline.STAGES)["near-dedup"]
    docs = docs_frame(pairs)
    got = stage(spark, docs, None)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    want = plain_kept(pairs)
    assert sorted(r.doc_id for r in got.collect()) == want and len(want) < len(pairs) - 40


def test_odd_rows(spark, docs_frame):
    pairs = [(5, ""), (3, None), (None, " "), (9, "a b c d"), (9, "a b c d"), (None, "p q r s")]
    rows = shingle_overlap.keep_one(docs_frame(pairs)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == [(0, "p q r s"), (3, ""), (9, "a b c d")]
    assert shingle_overlap.keep_one(docs_frame([])).count() == 0


def test_texts_that_resemble_each_other(spark, docs_frame):
    """A large group with a common core, similarities from 0.3 to 0.9: what centres leave open."""
    rng = random.Random(9)
    core, texts = [f"w{rng.randrange(900)}" for _ in range(120)], []
    for n in range(160):
        new = list(core)
        for _ in range(rng.randint(2, 8)):
            new[rng.randrange(120)] = f"x{rng.randrange(9000)}"
        texts.append(" ".join(new + [f"t{n}u{i}" for i in range(rng.choice([0, 0, 10, 30]))]))
        if n % 5 == 0:
            texts.append(texts[-1] + f" end{n}")
    pairs = list(enumerate(texts))
    got = sorted(r.doc_id for r in shingle_overlap.keep_one(docs_frame(pairs)).collect())
    assert got == plain_kept(pairs) and 100 < len(got) < 160


def test_long_bands_tell_resemblance_from_likeness(spark):
    """Pairs at 0.85 share a long band, pairs at 0.5 hardly ever; sizes too different never meet."""
    rng, rows = random.Random(2), []
    for n in range(120):
        base = [rng.randrange(1 << 60) for _ in range(200)]
        like = base[:184] + [rng.randrange(1 << 60) for _ in range(16)]  # 184 of 216
        some = base[:134] + [rng.randrange(1 << 60) for _ in range(66)]  # 134 of 266
        for k, hashes in enumerate((base, like, some, base[:150])):  # the last: 0.75, by size alone
            rows.append((4 * n + k, 4 * n + k, shingle_overlap.np.array(sorted(hashes), "<u8").tobytes()))
    sets = spark.createDataFrame(rows, "same long, root long, hashes binary")
    members = shingle_overlap.fine_members(sets)
    met = {(r.a, r.b) for r in shingle_overlap.across(members, 0.8).collect()}
    assert {(4 * n, 4 * n + 1) for n in range(120)} <= met
    assert sum(b % 4 == 2 and a // 4 == b // 4 for a, b in met) <= 6
    assert not any((a % 4, b % 4) == (0, 3) for a, b in met) and all(a // 4 == b // 4 for a, b in met)


def test_stage_links_by_anchors_first(spark, docs_frame, monkeypatch):
    """Fingerprints two bits apart are one component, and overlap goes on from there."""
    core = " ".join(f"c{i} d{i}" for i in range(40))
    # the same shingles in other amounts: the fingerprint follows the repeated part
    tails = [" ".join(f"t{n}u{i}" for i in range(30)) for n in range(3)]
    texts = [(core + " ") * 60 + t for t in tails]
    texts += [texts[2] + " " + " ".join(f"e{i}" for i in range(12)), "alone in the world"]
    pairs = list(enumerate(texts))
    fps = [anchor_simhash.fingerprint(t) for t in texts]
    assert plain_kept(pairs) == [0, 1, 2, 4]  # by overlap alone
    assert (fps[0] ^ fps[1]).bit_count() <= 2 and (fps[0] ^ fps[2]).bit_count() <= 2
    seen, links = [], shingle_overlap.anchor_links
    monkeypatch.setattr(shingle_overlap, "anchor_links", lambda f, bits: seen.append(bits) or links(f, bits))
    stage = dict(corpus_pipeline.STAGES)["near-dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs_frame(pairs), None).collect()) == [0, 4]
    assert seen == [anchor_simhash.MAX_BITS]


def test_rare_shingles_find_every_similar_pair(spark):
    """Groups around a core: all pairs at 0.8 or more meet, by a fifth of the shingles, few others do."""
    rng, sets = random.Random(5), []
    for group in range(4):
        core = [rng.randrange(1 << 60) for _ in range(60)]
        for _ in range(60):
            own = rng.randint(0, 30)
            sets.append({*rng.sample(core, 60 - rng.randint(0, 4)), *(rng.randrange(1 << 60) for _ in range(own))})
    sets += [{7}, {7, 8}, set()]
    rows = [(n, n, shingle_overlap.np.array(sorted(s), "<u8").tobytes()) for n, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "same long, root long, hashes binary").repartition(7)
    members = shingle_overlap.fine_members(frame)
    held = {r.same: r["count"] for r in members.groupBy("same").count().collect()}
    assert all(held.get(n, 0) <= len(s) // 5 + 1 for n, s in enumerate(sets))
    met = {(r.a, r.b) for r in shingle_overlap.across(members, 0.8).collect()}
    pairs = [(i, j) for j in range(len(sets)) for i in range(j) if sets[j]]
    similar = {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert len(similar) > 100 and similar <= met and len(met) < 3 * len(similar)
