"""Token counts of whole documents, huge ones in overlapping chunks.

A document beyond ``width`` code points is cut into chunks that overlap, the chunks are encoded
apart, on any executor, and the counts are spliced.  A chunk reports its *seams*: the offset of
every word that has white space before it, with the tokens up to there.  No token crosses white
space, so a seam that both neighbours report is a boundary in either encoding and in that of
the whole text; left of it the earlier chunk counts, right of it the later one.  Where an
overlap has no common seam (a run without white space covers it), the document is cut again
with chunks and overlaps four times as wide, until one chunk holds it all.

Defined results: a null text counts as empty (0 bytes, 0 tokens); every input row gives one
result row, so repeated rows and null ids stay; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType,
)

from shelfcast.durable import settle
from shelfcast.llm.arrow import map_lists
from shelfcast.llm.word_ids import word_ids

#: Code points in a chunk, in an overlap, and the factor by which both grow.
WIDTH, OVERLAP, WIDEN = 16_384, 256, 4

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SEAM = StructType([StructField("at", LongType()), StructField("tokens", LongType())])
CHUNK = StructType(
    [StructField("uid", LongType()), StructField("k", IntegerType()),
     StructField("last", IntegerType()), StructField("start", LongType()),
     StructField("chunk", StringType())]
)
COUNTED = StructType(
    [StructField("n_tokens", LongType()), StructField("left", ArrayType(SEAM)),
     StructField("right", ArrayType(SEAM))]
)


def _whole(path: str):
    def start():
        encoder = word_ids(path)

        def work(texts: list) -> dict[str, list]:
            return {"n_tokens": [len(encoder.ids(t)) // 4 if t else 0 for t in texts]}

        return work

    return start


def _cutter(width: int, overlap: int):
    step = width - overlap

    def start():
        def work(uids: list, texts: list) -> dict[str, list]:
            rows = []
            for uid, text in zip(uids, texts):
                last = max(0, -(-(len(text) - width) // step))
                for k in range(last + 1):
                    rows.append((uid, k, last, k * step, text[k * step : k * step + width]))
            return {n: [r[i] for r in rows] for i, n in enumerate(CHUNK.names)}

        return work

    return start


def _chunk_counter(path: str, width: int, overlap: int):
    def start():
        encoder = word_ids(path)

        def work(firsts: list, lasts: list, starts: list, chunks: list) -> dict[str, list]:
            out: dict[str, list] = {n: [] for n in COUNTED.names}
            for k, last, begin, chunk in zip(firsts, lasts, starts, chunks):
                left, right, tokens = [], [], 0
                for place, ids in zip(WORD.finditer(chunk), encoder.words(chunk)):
                    at = place.start()
                    if at and k > 0 and at < overlap:
                        left.append({"at": begin + at, "tokens": tokens})
                    if at and k < last and at >= width - overlap:
                        right.append({"at": begin + at, "tokens": tokens})
                    tokens += len(ids) // 4
                out["n_tokens"].append(tokens)
                out["left"].append(left)
                # of the right seams: the tokens from there on
                out["right"].append([{"at": s["at"], "tokens": tokens - s["tokens"]} for s in right])
            return out

        return work

    return start


def _splice(chunks: DataFrame) -> DataFrame:
    """``uid, n_tokens``; null tokens where some overlap has no common seam."""

    def seams(side: str, overlap) -> DataFrame:
        return chunks.select("uid", overlap.alias("k"), F.explode(side).alias("s")).select(
            "uid", "k", "s.at", F.lit(side).alias("side"), "s.tokens"
        )

    both = seams("right", F.col("k")).unionByName(seams("left", F.col("k") - 1))
    common = (
        both.groupBy("uid", "k", "at")
        .agg(F.sum("tokens").alias("twice"), F.count_distinct("side").alias("sides"))
        .where("sides = 2")
        .groupBy("uid", "k")
        .agg(F.min(F.struct("at", "twice")).alias("seam"))
    )
    parts = chunks.select(
        "uid", "n_tokens", F.lit(1).alias("chunks"), F.lit(0).alias("joined")
    ).unionByName(
        common.select(
            "uid", (-F.col("seam.twice")).alias("n_tokens"),
            F.lit(0).alias("chunks"), F.lit(1).alias("joined"),
        )
    )
    sums = parts.groupBy("uid").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "chunks", "joined")])
    return sums.select(
        "uid", F.when(F.col("joined") == F.col("chunks") - 1, F.col("n_tokens")).alias("n_tokens")
    )


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` with the vocabulary file at ``path``."""
    if not 0 < overlap < width:
        raise ValueError("an overlap must be shorter than a chunk")
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    tokens = StructType([StructField("n_tokens", LongType())])
    short = source.where(F.char_length("text") <= width)
    counted = map_lists(short.select("doc_id", "n_bytes", "text"), _whole(path), tokens, carry=2)

    long = source.where(F.char_length("text") > width)
    long = settle(long.withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    todo = long
    while True:
        cut = map_lists(todo.select("uid", "text"), _cutter(width, overlap), CHUNK)
        dealt = cut.repartition("uid", "k").select("uid", "k", "k", "last", "start", "chunk")
        dealt = dealt.toDF("uid", "k", "first", "last", "start", "chunk")
        chunks = settle(
            map_lists(dealt, _chunk_counter(path, width, overlap), COUNTED, carry=2), "chunks"
        )
        spliced = settle(_splice(chunks), "spliced")
        done = spliced.where("n_tokens is not null")
        counted = counted.unionByName(
            long.join(done, "uid").select("doc_id", "n_bytes", "n_tokens")
        )
        failed = spliced.where("n_tokens is null")
        if failed.isEmpty():
            return counted
        todo = todo.join(failed.select("uid"), "uid", "left_semi")
        width, overlap = width * WIDEN, overlap * WIDEN
