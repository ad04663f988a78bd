"""Near-dedup by fingerprints, where asked for, and the exact overlap of word shingles.

With ``max_bits`` the anchors of ``anchor_simhash`` first link documents whose fingerprints differ
in at most that many bits.  Overlap then has to link only what these components leave apart, and
the components are those of both kinds of links.

Two documents are linked if their sets of shingles have a Jaccard similarity of at least
``similarity``.  Equal sets are one set.  Candidates share one of ``BANDS`` bands of ``ROWS``
MinHash values: a pair at 0.8 is missed with a probability of 0.0004, a closer one less often.
Every candidate that matters for the components is compared on the whole sets, so no pair
below the similarity is linked.

A bucket (documents with a band) is not compared pair by pair: a few centres meet all its
members, and once more centres of its smallest components do.  Sets whose bucket still holds
several components meet by their rarest shingles, and no similar pair of them is missed: of sets
of n shingles all but 0.8 n, and one more, are looked at, in one order for all, rare ones first,
and similar sets share one of these.  Texts that merely resemble each other share the frequent
ones, which are left out, or share them at places behind so many others that the similarity is
out of reach.  How frequent shingles are is counted in a table of fixed size; where several fall
into one place, the order is still the same for all sets.  Pairs across components that share a
rare shingle, at places and with sizes that allow the similarity, are compared.  Comparisons with one centre are dealt out in parts of ``PART`` sets, each with a copy
of the centre.

Defined results: words are those of the fingerprints; a text of fewer words than a shingle is
one shingle, a text without words the empty set, equal to any other; null counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from shelfcast.durable import settle
from shelfcast.llm.anchor_simhash import connect, fingerprint
from shelfcast.llm.anchor_simhash import links as anchor_links
from shelfcast.llm.arrow import map_lists

#: Words in a shingle, least Jaccard similarity of a link, seed of the hash.
SHINGLE_WORDS, SIMILARITY, SEED = 5, 0.8, 42

#: Bands and their MinHash values; shingles that are hashed to all of them at once.
BANDS, ROWS, SHINGLE_BLOCK = 20, 5, 4096

#: Places of the table of shingle counts (a power of two), and those sent in one message.
COUNT_PLACES, COUNT_BLOCK = 1 << 20, 1 << 14

#: Centres of a bucket in a round, rounds with centres, sets in a part.
CENTRES, CENTRE_ROUNDS, PART = 4, 2, 256


def _factors(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    factors = np.random.default_rng(seed).integers(1, 1 << 63, (2, n, 1), np.uint64)
    return factors[0] * np.uint64(2) + np.uint64(1), factors[1]


FACTORS = _factors(SEED, BANDS * ROWS)


def shingles(text: str | None, words_each: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    whole = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    span = min(words_each, len(words))
    starts, ends = (ends - sizes)[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()
    hashes = (xxh64_intdigest(whole[i:j], SEED) for i, j in zip(starts, ends))
    return np.unique(np.fromiter(hashes, "<u8", len(starts)))


def bands(hashes: np.ndarray) -> list[int]:
    """One signed hash for each band of the MinHash values."""
    from xxhash import xxh64_intdigest

    factor, summand = FACTORS
    least = np.full(len(factor), np.iinfo(np.uint64).max, "<u8")
    for low in range(0, len(hashes), SHINGLE_BLOCK):
        here = factor * hashes[None, low : low + SHINGLE_BLOCK] + summand
        least = np.minimum(least, here.min(axis=1))
    raw = least.astype("<u8").reshape(-1, ROWS)
    return [xxh64_intdigest(row.tobytes(), n) - (1 << 63) for n, row in enumerate(raw)]


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def mark(texts: DataFrame, words_each: int, fingerprinted: bool = False) -> DataFrame:
    """``uid, doc_id, same, bands``; ``same`` tells sets of shingles apart.

    ``fingerprinted`` adds ``fp``, the fingerprint of the text as a signed long.
    """
    from xxhash import xxh64_intdigest

    def start():
        def work(values: list) -> dict[str, list]:
            sets = [shingles(t, words_each) for t in values]
            marks = {
                "same": [xxh64_intdigest(s.tobytes(), SEED) - (1 << 63) for s in sets],
                "bands": [bands(s) for s in sets],
            }
            if fingerprinted:
                fps = [fingerprint(t) for t in values]
                marks["fp"] = [v - (1 << 64) if v >> 63 else v for v in fps]
            return marks

        return work

    fields = [StructField("same", LongType()), StructField("bands", ArrayType(LongType()))]
    if fingerprinted:
        fields.append(StructField("fp", LongType()))
    return map_lists(texts.select("uid", "doc_id", "text"), start, StructType(fields), carry=2)


def whole_sets(texts: DataFrame, words_each: int) -> DataFrame:
    """``same, hashes`` from ``same, text``."""

    def start():
        def work(values: list) -> dict[str, list]:
            return {"hashes": [shingles(t, words_each).tobytes() for t in values]}

        return work

    return map_lists(texts, start, StructType([StructField("hashes", BinaryType())]), carry=1)


def count_place(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(COUNT_PLACES - 1)).astype(np.int64)


def shingle_counts(open_sets: DataFrame) -> np.ndarray:
    """How many ``hashes`` of all sets fall into each place of the table.

    Tasks send what they have counted in blocks, which are added up one by one; the table has
    the same size whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNT_PLACES, np.int64)
        for batch in batches:
            for raw in batch.column("hashes"):
                table[count_place(np.frombuffer(raw.as_py(), "<u8"))] += 1  # a set has no shingle twice
        blocks = table.reshape(-1, COUNT_BLOCK)
        held = np.flatnonzero(blocks.any(axis=1))
        data = [pa.compress(blocks[k].tobytes(), "zstd", asbytes=True) for k in held]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(data, pa.binary())], names=["block", "counts"])

    def add(key: tuple, messages: pa.Table) -> pa.Table:
        total = np.zeros(COUNT_BLOCK, np.int64)
        for raw in messages.column("counts"):
            total += np.frombuffer(pa.decompress(raw.as_py(), total.nbytes, "zstd"), np.int64)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "counts": pa.array([total.tobytes()])})

    schema = "block long, counts binary"
    sent = open_sets.select("hashes").mapInArrow(count, schema)
    table = np.zeros((COUNT_PLACES // COUNT_BLOCK, COUNT_BLOCK), np.int64)
    for row in sent.groupBy("block").applyInArrow(add, schema).collect():
        table[row.block] = np.frombuffer(row.counts, np.int64)
    return np.minimum(table.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def rarest(hashes: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest shingles, in order: so many that sets of that similarity share one."""
    number = len(hashes) - int(np.ceil(similarity * len(hashes) - 1e-6)) + 1
    order = np.lexsort((hashes, counts[count_place(hashes)]))
    return hashes[order[:number]]


def fine_members(open_sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``shingle, place, same, root, size`` of the rarest shingles, from ``same, root, hashes``."""
    given = open_sets.sparkSession.sparkContext.broadcast(shingle_counts(open_sets))

    def start():
        def work(values: list) -> dict[str, list]:
            sets = [np.frombuffer(v, "<u8") for v in values]
            rare = [rarest(s, given.value, similarity).view("<i8").tolist() for s in sets]
            return {"size": [len(s) for s in sets], "rare": rare}

        return work

    fields = [StructField("size", LongType()), StructField("rare", ArrayType(LongType()))]
    fine = map_lists(open_sets, start, StructType(fields), carry=2)
    return fine.select(F.posexplode("rare").alias("place", "shingle"), "same", "root", "size")


def across(members: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: pairs of two components with a shingle in common that can be similar.

    Behind the first shingle that two sets share, no more can be shared than either has there.
    """
    several = members.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    shared = settle(members.join(several.where("low < high").select("shingle"), "shingle", "left_semi"), "fine")
    left, right = (
        shared.select("shingle", F.col("same").alias(n), F.col("root").alias(f"root_{n}"),
                      F.col("size").alias(f"size_{n}"), (F.col("size") - F.col("place")).alias(f"left_{n}"))
        for n in ("a", "b")
    )
    few, many = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    needed = similarity / (1 + similarity) * (F.col("size_a") + F.col("size_b")) - 1e-6
    met = left.join(right, "shingle").where("a < b and root_a <> root_b").where(few >= similarity * many)
    return met.where(F.least("left_a", "left_b") >= needed).select("a", "b").distinct()


def linked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``a, b`` whose sets overlap enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, hashes = None, None
        for batch in batches:
            found_a, found_b = [], []
            for a, b, raw in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "hashes"))):
                if b is None:  # comes first in each part
                    centre, hashes = a, np.frombuffer(raw, "<u8")
                    continue
                assert a == centre
                other = np.frombuffer(raw, "<u8")
                few, many = sorted((len(hashes), len(other)))
                if few >= similarity * many and overlap(hashes, other) >= similarity:
                    found_a.append(a)
                    found_b.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"]
            )

    pairs = settle(pairs, "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).cast("long").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts"))
    others = pairs.join(parts, "a").select("a", part.alias("part"), "b")
    others = others.join(sets.withColumnRenamed("same", "b"), "b")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    heads = parts.select("a", each.alias("part"), F.lit(None).cast("long").alias("b"))
    heads = heads.join(sets.withColumnRenamed("same", "a"), "a")
    rows = heads.select("a", "part", "b", "hashes").unionByName(others.select("a", "part", "b", "hashes"))
    dealt = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return dealt.mapInArrow(compare, "a long, b long")


def fingerprint_links(marked: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: the least set of each component of the fingerprints beside its other sets."""
    held = settle(marked.select("fp", "same").distinct(), "held")
    roots = connect(anchor_links(held.select("fp").distinct(), max_bits)).withColumnRenamed("node", "fp")
    rooted = held.join(roots, "fp", "left").select(F.coalesce("root", "fp").alias("root"), "same")
    least = rooted.groupBy("root").agg(F.min("same").alias("a"))
    both = rooted.join(least, "root").select("a", F.col("same").alias("b"))
    return both.where("a <> b").distinct()


def open_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """``band, same, root`` of the bands whose sets the links ``found`` leave in several components."""
    roots = connect(found).withColumnRenamed("node", "same")
    rooted = members.select("band", "same").join(roots, "same", "left")
    rooted = settle(rooted.withColumn("root", F.coalesce("root", "same")), "rooted")
    several = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_bands = several.where("low < high").select("band")
    return settle(rooted.join(open_bands, "band", "left_semi"), "open")


def links(
    rooted: DataFrame, sets: DataFrame, similarity: float, found: DataFrame | None = None
) -> DataFrame:
    """``a, b``: links that connect what the similar pairs of ``band, same, root`` rows connect.

    ``found`` are the links that the roots come from; they are returned as well.
    """
    grouped = found is not None
    if grouped and rooted.isEmpty():
        return found
    for turn in range(CENTRE_ROUNDS + 1):
        if turn < CENTRE_ROUNDS:
            inside = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size"))
            alone = rooted.withColumn("size", F.lit(1))
            sized = rooted.join(inside, ["band", "root"]) if turn or grouped else alone
            sized = settle(sized, "sized")
            order = lambda i: F.struct("size", F.xxhash64("same", F.lit(i)), "same")
            least = [F.min(order(i))["same"] for i in range(CENTRES)]
            centres = settle(
                sized.groupBy("band").agg(F.array_distinct(F.array(*least)).alias("centres")), "centres"
            )
            with_centres = sized.join(centres, "band")
            met = with_centres.select("same", F.explode("centres").alias("a")).where("a <> same")
            pairs = met.select("a", F.col("same").alias("b")).distinct()
            rooted = with_centres.where(~F.array_contains("centres", F.col("same")))
            rooted = rooted.select("band", "same")
        else:
            remaining = settle(rooted.select("same", "root").distinct(), "remaining")
            open_sets = settle(remaining.join(sets, "same").select("same", "root", "hashes"), "open-sets")
            pairs = across(settle(fine_members(open_sets, similarity), "rarest"), similarity)
        new = settle(linked(pairs, sets, similarity), "near")
        found = new if found is None else found.unionByName(new)
        if turn == CENTRE_ROUNDS:
            return found
        rooted = open_members(rooted, found)
        if rooted.isEmpty():
            return found
    return found


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words_each: int = SHINGLE_WORDS, similarity: float = SIMILARITY, max_bits: int | None = None,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, nulls last.

    ``max_bits`` also links fingerprints that differ in at most so many bits.  The row number
    breaks ties, so of repeated rows one stays; all columns are returned.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
        F.struct("*").alias("row"),
    )
    numbered = settle(numbered, "numbered")
    texts = numbered.select("uid", "doc_id", F.col("row")[text_col].alias("text"))
    marked = settle(mark(texts, words_each, max_bits is not None), "marked")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", "bands")
    sets = settle(marked.groupBy("same").agg(F.min(order).alias("first")), "sets")
    banded = sets.select("same", F.explode("first.bands").alias("band"))
    # of buckets with the same members one is enough
    buckets = banded.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("same").alias("least"), F.max("same").alias("most"),
        F.bit_xor(F.xxhash64("same")).alias("mix"),
    ).where("n > 1")
    single = settle(buckets.groupBy("n", "least", "most", "mix").agg(F.min("band").alias("band")), "buckets")
    members = settle(banded.join(single.select("band"), "band", "left_semi"), "members")
    known, rooted = None, members.withColumn("root", F.col("same"))
    if max_bits is not None:
        known = settle(fingerprint_links(marked, max_bits), "known")
        rooted = open_members(members, known)
    chosen = rooted.select("same").distinct().join(sets, "same").select("same", F.col("first.uid").alias("uid"))
    compared = texts.join(chosen, "uid").select("same", "text")
    edges = links(rooted, settle(whole_sets(compared, words_each), "whole"), similarity, known)
    roots = connect(edges).withColumnRenamed("node", "same")
    place = F.struct("first.no_id", "first.doc_id", "first.uid")
    first = (
        sets.join(roots, "same", "left")
        .groupBy(F.coalesce("root", "same"))
        .agg(F.min(place)["uid"].alias("uid"))
    )
    return numbered.join(first.select("uid"), "uid", "left_semi").select("row.*")
