"""License scans as an exact set-similarity join.

Documents become overlapping text blocks: for a template of *n* words, windows of the smallest
power of two that is at least 2 n, every half window, so that any stretch of n words lies in one
of them.  A block and a template join if the block holds at least ``threshold`` of the
template's distinct words.  Words are ordered by their frequency over all documents, rarest
first.  A template of *t* words that must share *o* has one of its first t - o + 1 words in the
block (*prefix*), the block has o template words at all (*length*), and from the first shared
word on both sides still have o words (*position*).  What passes is counted exactly.

Templates of different labels may differ in a word or two.  Where another template would join a
template's own block, the template gives its label only if the block has all words that the other
lacks, and not if the other has all of its words and the block has the rest of them too.

Templates are a parameter of bounded size, so their words, prefixes and frequencies are small
whatever the documents are; blocks without any prefix word never leave the task that reads them.

Defined results: a null text counts as empty; every input row gives one result row; nulls and
repeated rows stay; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType,
)

from shelfcast.durable import settle
from shelfcast.llm.arrow import map_lists

#: Share of a template's distinct words that a block must hold.
THRESHOLD = 0.8

#: Fixed phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label and wording of the notices that the join looks for.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a "
     "copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 "
     "International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 "
     "International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)

#: Notices too short for a set of words: they count where they stand word for word.
NOTICES = {"all rights reserved": "reserved"}

#: A-Z to a-z; 0-9, a-z and every byte of other characters as they are; the rest to spaces.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """``(start, label)`` of every place where a phrase's words stand one after the other."""
    out = []
    for phrase, label in phrases.items():
        parts = words_of(phrase)
        last, at = parts[-1], len(parts) - 2
        while True:
            try:
                at = words.index(last, at + 1)
            except ValueError:
                break
            start = at - len(parts) + 1
            if words[start:at] == parts[:-1]:
                out.append((start, label))
    return out


def block_words(template: str) -> int:
    """Words in the blocks that a template is looked for in."""
    return 1 << (2 * len(words_of(template)) - 1).bit_length()


def required(template: str, threshold: float) -> int:
    """Distinct words of a template that a block must hold."""
    return ceil(threshold * len(set(words_of(template))) - 1e-9)


def word_counts(docs: DataFrame, templates) -> Counter:
    """Occurrences over all documents of the templates' words, and of no others."""
    wanted = {w for _, t in templates for w in words_of(t)}

    def start():
        def work(texts: list) -> dict[str, list]:
            counts: Counter = Counter()
            for text in texts:
                words = Counter(words_of(text))
                counts.update({w: words[w] for w in wanted & words.keys()})
            return {"word": [w.decode() for w in counts], "n": list(counts.values())}

        return work

    schema = StructType([StructField("word", StringType()), StructField("n", LongType())])
    counted = map_lists(docs.select("text"), start, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return Counter({r.word.encode(): r.n for r in counted.collect()})  # at most len(wanted) rows


BLOCK = StructType(
    [StructField("size", IntegerType()), StructField("block", LongType()),
     StructField("ranks", ArrayType(IntegerType()))]
)
SCANNED = StructType(
    [StructField("n_words", LongType()), StructField("starts", ArrayType(LongType())),
     StructField("base", ArrayType(StringType())), StructField("noticed", ArrayType(StringType())),
     StructField("blocks", ArrayType(BLOCK))]
)


class Index:
    """Templates as sets of word ranks, rarest word first, with their prefixes."""

    def __init__(self, templates, threshold: float, counts: Counter):
        words = {w for _, t in templates for w in words_of(t)}
        order = sorted(words, key=lambda w: (counts[w], w))
        self.rank = {w: r for r, w in enumerate(order)}
        self.rows = []  # (template, label, size, need, ranks)
        self.prefix: dict[bytes, set[int]] = {}  # word -> block sizes to look at
        self.least: dict[int, int] = {}
        for number, (label, text) in enumerate(templates):
            ranks = sorted({self.rank[w] for w in words_of(text)})
            size, need = block_words(text), required(text, threshold)
            must, bars = self.rivals(number, templates, threshold)
            self.rows.append((number, label, size, need, ranks, must, bars))
            self.least[size] = min(need, self.least.get(size, need))
            for r in ranks[: len(ranks) - need + 1]:
                self.prefix.setdefault(order[r], set()).add(size)

    def rivals(self, number: int, templates, threshold: float) -> tuple[list[int], list[list[int]]]:
        """Ranks that a block must have for a template, and sets of which it must not have all."""
        label, text = templates[number]
        mine, must, bars = set(words_of(text)), set(), []
        for other, wording in templates:
            theirs = set(words_of(wording))
            if other == label or len(mine & theirs) < required(text, threshold):
                continue
            must |= mine - theirs
            if mine < theirs:
                bars.append(sorted(self.rank[w] for w in theirs - mine))
        return sorted(self.rank[w] for w in must), bars

    def blocks(self, words: list[bytes]) -> list[dict]:
        """The blocks that hold a prefix word and enough template words."""
        prefix = self.prefix
        if prefix.keys().isdisjoint(words):
            return []
        wanted = set()
        for i, word in enumerate(words):
            if word in prefix:
                for size in prefix[word]:
                    wanted.update(((size, 2 * i // size), (size, 2 * i // size - 1)))
        out = []
        for size, block in sorted(wanted):
            if block < 0:
                continue
            start = block * size // 2
            ranks = {self.rank[w] for w in words[start : start + size] if w in self.rank}
            if len(ranks) >= self.least[size]:
                out.append({"size": size, "block": block, "ranks": sorted(ranks)})
        return out


def scan_documents(
    docs: DataFrame, index: Index, phrases: dict[str, str], notices: dict[str, str]
) -> DataFrame:
    """``doc_id, n_words, starts, base, noticed, blocks`` for ``doc_id, text`` rows."""

    def start():
        def work(texts: list) -> dict[str, list]:
            out: dict[str, list] = {n: [] for n in SCANNED.names}
            for text in texts:
                words = words_of(text)
                places = phrase_places(words, phrases)
                out["n_words"].append(len(words))
                out["starts"].append([at for at, _ in places])
                out["base"].append(sorted({label for _, label in places}))
                out["noticed"].append(sorted({label for _, label in phrase_places(words, notices)}))
                out["blocks"].append(index.blocks(words))
            return out

        return work

    return map_lists(docs, start, SCANNED, carry=1)


def join_blocks(blocks: DataFrame, index: Index, spark: SparkSession) -> DataFrame:
    """``uid, label, score``: blocks that hold enough of a template, best score of each label."""
    rows = [
        (number, label, size, need, ranks, must, bars, place, rank)
        for number, label, size, need, ranks, must, bars in index.rows
        for place, rank in enumerate(ranks[: len(ranks) - need + 1])
    ]
    prefixes = spark.createDataFrame(
        rows,
        "template int, label string, size int, need int, words array<int>, must array<int>, "
        "bars array<array<int>>, at int, rank int",
    )
    left = blocks.select(
        "uid", "size", "block", "ranks", F.posexplode("ranks").alias("place", "rank")
    )
    # the template side has a row for each prefix word of a template: bounded by the parameter
    met = left.join(F.broadcast(prefixes), ["size", "rank"])
    near = met.where(F.size("ranks") >= F.col("need")).where(
        F.least(F.size("ranks") - F.col("place"), F.size("words") - F.col("at")) >= F.col("need")
    )
    shared = F.size(F.array_intersect("ranks", "words"))
    exact = near.withColumn("shared", shared).where("shared >= need")
    within = lambda ranks: F.size(F.array_except(ranks, "ranks")) == 0
    exact = exact.where(within(F.col("must"))).where(~F.exists("bars", within))
    score = F.col("shared") / F.size("words")
    return exact.groupBy("uid", "label").agg(F.max(score).alias("score"))


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    templates=TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
) -> DataFrame:
    """``doc_id, n_words, starts`` (of phrases) ``, base, labels, score`` for every row.

    ``score`` is 1 where a phrase or notice stands, else the largest share of a template that a joined
    block holds, else 0.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    index = Index(templates, threshold, word_counts(source, templates))
    scanned = scan_documents(source, index, phrases, notices)
    scanned = settle(scanned.withColumn("uid", F.monotonically_increasing_id()), "scanned")
    blocks = scanned.where(F.size("blocks") > 0).select("uid", F.inline("blocks"))
    found = (
        join_blocks(blocks, index, docs.sparkSession)
        .groupBy("uid")
        .agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))  # few labels
    )
    none = F.array().cast("array<string>")
    return scanned.join(found, "uid", "left").select(
        "doc_id",
        "n_words",
        "starts",
        "base",
        F.array_sort(F.array_union(F.array_union("base", "noticed"), F.coalesce("more", none))).alias("labels"),
        F.when(F.size("base") + F.size("noticed") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
