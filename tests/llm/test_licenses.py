"""Phrases and template blocks against brute force over every block."""

import random
import re

import __spark_entry__ as entry
from shelfcast.llm import license_join as lic


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def rivalled(label, want, block, templates, threshold):
    """Whether another label's wording explains the block instead."""
    for other, wording in templates:
        theirs = set(plain_words(wording))
        if other != label and len(want & theirs) / len(want) >= threshold - 1e-9:
            if not want - theirs <= block or (want < theirs and theirs - want <= block):
                return True
    return False


def plain_scan(text, templates=lic.TEMPLATES, threshold=lic.THRESHOLD):
    """Every block of every size against every template."""
    words = plain_words(text)
    places = [
        (i, label)
        for phrase, label in lic.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    labels, best = set(), 0.0
    for label, template in templates:
        parts = plain_words(template)
        size = 1
        while size < 2 * len(parts):
            size *= 2
        want = set(parts)
        for start in range(0, len(words), size // 2):
            block = set(words[start : start + size])
            share = len(want & block) / len(want)
            if share >= threshold - 1e-9 and not rivalled(label, want, block, templates, threshold):
                labels.add(label)
                best = max(best, share)
    text_words = " ".join(words)
    noticed = {lb for n, lb in lic.NOTICES.items() if f" {n} " in f" {text_words} "}
    labels |= noticed
    best = 1.0 if noticed else best
    base = {label for _, label in places}
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else best,
    )


def rows_of(df):
    from shelfcast.llm.queries import license_columns

    return [tuple(r) for r in license_columns(df).collect()]


def test_op9_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op9_license_join"](spark, sf).collect()}
    assert got == {d.doc_id: plain_scan(d.text) for d in docs}
    assert any(r[5] != r[4] for r in got.values())


def test_odd_and_partial_notices(spark, docs_frame):
    rng = random.Random(2)
    texts = ["", None, "MIT License mit-LICENSE", "mit licensé", "GENERAL public\nlicense", "license"]
    for _, template in lic.TEMPLATES:
        words = template.split()
        for drop in (0, 1, 2, 5):
            some = [w for w in words if w not in rng.sample(words, min(drop, len(words) - 1))]
            filler = [rng.choice(["the", "of", "é", "lorem", "license"]) for _ in range(rng.randint(0, 90))]
            texts.append(" ".join(filler + some + filler[::-1]))
            rng.shuffle(some)
            texts.append("—".join(some))
    pairs = [*enumerate(texts), (2, texts[2]), (None, texts[8])]
    got = rows_of(lic.scan_licenses(docs_frame(pairs)))
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    want = [(i, *plain_scan(t)) for i, t in pairs]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert rows_of(lic.scan_licenses(docs_frame([]))) == []


def test_creative_commons_labels_are_told_apart(spark, docs_frame):
    long = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    texts = {
        1: ("Licensed under CC BY-NC 4.0", "cc-by-nc"), 2: ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
        3: ("Licensed under CC BY 4.0", "cc-by"), 4: (long.format(""), "cc-by"),
        5: (long.format("-NonCommercial"), "cc-by-nc"), 6: (long.format("-ShareAlike"), "cc-by-sa"),
        7: ("all the rights I reserved", ""), 8: ("All rights reserved.", "reserved"),
    }
    got = lic.scan_licenses(docs_frame([(i, t) for i, (t, _) in texts.items()]))
    assert {r.doc_id: ",".join(r.labels) for r in got.collect()} == {i: w for i, (_, w) in texts.items()}
