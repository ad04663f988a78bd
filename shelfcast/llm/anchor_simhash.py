"""SimHash near-duplicates through anchors of a covering code.

*Fingerprints.*  64 bits by majority over the XXH64 of word shingles.

*Anchors.*  The perfect binary Golay code of length 23 covers every 23-bit word within radius 3.
Its square on bits 0-45 gives 2**24 anchors.  The nearest code word of either block is a
fingerprint's *home*; the fingerprint also *visits* every anchor whose distance beyond the
radius, summed over the blocks, is at most the threshold.  If two fingerprints differ in at most
that many bits, each block of the one is within radius plus its share of the difference of the
other's home, so the one visits the other's home and the pair is compared there, on all 64 bits.
About 60 rows for each distinct fingerprint, however many documents share it.

*Comparison.*  An anchor's fingerprints are searched breadth first from its homes; what leaves
the task is one link for each fingerprint reached, not all pairs.  In a large group neighbours
are looked up by flipping bits, so the work follows the group's size.  The links become
components by contraction rounds in Spark, written to the shared folder between rounds.

Defined results: null text counts as empty; texts without words have fingerprint 0, linked like
any other; repeated rows and null ids stay, a component's id is the smallest id that is not
null (null if there is none); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfcast.durable import settle
from shelfcast.llm.arrow import map_lists

#: Words in a shingle, differing bits of a link, seed of the hash.
SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42

#: Length, radius and generator polynomial of the Golay code.
LENGTH, RADIUS, GENERATOR = 23, 3, 0b101011100011

#: Shingles whose bits are spread out at once; pool size from which neighbours are looked up.
SHINGLE_BLOCK, LARGE_POOL = 65_536, 16_384

ANCHOR_ROW = pa.schema([("anchor", pa.int32()), ("fp", pa.int64()), ("home", pa.bool_())])
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None, words_each: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, unsigned."""
    from xxhash import xxh64_intdigest

    # of bytes: lower() changes A-Z only, split() splits at space and tab to carriage return
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    span = min(words_each, len(words))
    starts = (ends - sizes)[: len(words) - span + 1]
    counts = np.zeros(64, np.int64)
    for low in range(0, len(starts), SHINGLE_BLOCK):
        here = starts[low : low + SHINGLE_BLOCK].tolist()
        there = ends[low + span - 1 :][: len(here)].tolist()
        hashes = np.array([xxh64_intdigest(whole[i:j], SEED) for i, j in zip(here, there)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """All other columns of ``docs`` and ``fp``, the fingerprint as a signed long."""

    def start():
        def work(texts: list) -> dict[str, list]:
            values = [fingerprint(t, words_each) for t in texts]
            return {"fp": [v - (1 << 64) if v >> 63 else v for v in values]}

        return work

    others = [c for c in docs.columns if c != text_col]
    return map_lists(
        docs.select(*others, text_col), start, StructType([StructField("fp", LongType())]),
        carry=len(others),
    )


class Cover:
    """Homes and visited anchors under the squared Golay code."""

    def __init__(self, max_bits: int):
        def remainder(v: int) -> int:
            for bit in range(LENGTH - 1, 10, -1):
                if v >> bit & 1:
                    v ^= GENERATOR << (bit - 11)
            return v

        unit = [remainder(1 << i) for i in range(LENGTH)]
        #: syndromes of the low 12 and the high 11 bits of a word, which add up
        self.low, self.high = (
            self._sums(unit[first : first + count]) for first, count in ((0, 12), (12, 11))
        )
        #: the error of each syndrome: every word has exactly one of weight 3 or less
        self.error = np.zeros(2048, np.int32)
        for weight in range(1, RADIUS + 1):
            for places in combinations(range(LENGTH), weight):
                at = 0
                for p in places:
                    at ^= unit[p]
                self.error[at] = sum(1 << p for p in places)
        # a code word for each value of the top 12 bits: the rest is their remainder
        top = np.arange(1 << 12, dtype=np.int32) << 11
        code = top ^ self._syndrome(top)
        shift, excess = [], []
        for low in range(0, len(self.error), 64):  # in parts, to need little memory
            far = np.bitwise_count(self.error[low : low + 64, None] ^ code[None, :])
            beyond = np.maximum(far.astype(np.int8) - RADIUS, 0)
            for row in beyond:
                reach = np.flatnonzero(row <= max_bits)
                reach = reach[np.argsort(row[reach], kind="stable")]
                shift.append(code[reach])
                excess.append(row[reach])
        most = max(map(len, shift))
        #: by syndrome: shifts to the code words in reach, the home first, and their excess
        self.shift = np.zeros((len(shift), most), np.int32)
        self.excess = np.full((len(shift), most), max_bits + 1, np.int8)
        for i, (words, over) in enumerate(zip(shift, excess)):
            self.shift[i, : len(words)], self.excess[i, : len(words)] = words, over
        self.max_bits = max_bits

    @staticmethod
    def _sums(units: list[int]) -> np.ndarray:
        values = np.arange(1 << len(units))
        out = np.zeros(len(values), np.int32)
        for i, unit in enumerate(units):
            out ^= np.where(values >> i & 1, unit, 0).astype(np.int32)
        return out

    def _syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.low[words & 4095] ^ self.high[words >> 12]

    def anchors(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(anchor, fp, home)`` arrays for unsigned ``fps``, homes included."""
        mask = np.uint64((1 << LENGTH) - 1)
        blocks = []
        for low in (0, LENGTH):
            v = (fps >> np.uint64(low) & mask).astype(np.int32)
            s = self._syndrome(v)
            nearest = v ^ self.error[s]
            blocks.append(((nearest[:, None] ^ self.shift[s]) >> 11, self.excess[s]))
        (one, over_one), (two, over_two) = blocks
        total = over_one[:, :, None] + over_two[:, None, :]
        row, i, j = np.nonzero(total <= self.max_bits)
        # the top 12 bits of a word of a cyclic code tell it from the others
        return one[row, i] << 12 | two[row, j], fps[row], (i == 0) & (j == 0)


@lru_cache(maxsize=2)
def cover(max_bits: int) -> Cover:
    return Cover(max_bits)


@lru_cache(maxsize=2)
def flips(max_bits: int) -> np.ndarray:
    """All 64-bit words with at most ``max_bits`` ones."""
    ones = [sum(1 << p for p in c) for n in range(max_bits + 1) for c in combinations(range(64), n)]
    return np.array(ones, np.uint64)


def near(front: np.ndarray, pool: np.ndarray, max_bits: int) -> np.ndarray:
    """Which members of the sorted ``pool`` are within ``max_bits`` of some of ``front``."""
    found = np.zeros(len(pool), bool)
    if len(pool) <= LARGE_POOL:
        for low in range(0, len(front), 64):
            part = front[low : low + 64, None] ^ pool[None, :]
            found |= (np.bitwise_count(part) <= max_bits).any(axis=0)
        return found
    for low in range(0, len(front), 64):
        wanted = (front[low : low + 64, None] ^ flips(max_bits)[None, :]).ravel()
        at = np.minimum(np.searchsorted(pool, wanted), len(pool) - 1)
        found[at[pool[at] == wanted]] = True
    return found


def group_links(homes: np.ndarray, visitors: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Links of one anchor that connect all that its homes' pairs connect."""
    homes, visitors = np.sort(homes), np.sort(visitors)
    free, a, b = np.ones(len(homes), bool), [], []
    for seed in range(len(homes)):
        if not free[seed]:
            continue
        free[seed] = False
        front, guests = homes[seed : seed + 1], np.zeros(len(visitors), bool)
        reached = []
        while len(front):
            guests |= near(front, visitors, max_bits)
            new = near(front, homes, max_bits) & free
            free &= ~new
            front = homes[new]
            reached.append(front)
        b += [*reached, visitors[guests]]
        a += [np.full(len(part), homes[seed]) for part in b[len(a) :]]
    return a, b


def _links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int):
    """Links among whole groups: rows sorted by anchor, homes first."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    homes = np.add.reduceat(home.astype(np.int64), starts)
    alone = np.repeat(homes == 1, sizes)
    first = np.repeat(fp[starts], sizes)
    close = alone & (fp != first) & (np.bitwise_count(fp ^ first) <= max_bits)
    a, b = [first[close]], [fp[close]]
    for g in np.flatnonzero(homes > 1).tolist():
        low, middle, high = starts[g], starts[g] + homes[g], starts[g] + sizes[g]
        more = group_links(fp[low:middle], fp[middle:high], max_bits)
        a += more[0]
        b += more[1]
    return np.concatenate(a), np.concatenate(b)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: links that connect what pairs within ``max_bits`` connect; ``fps``: distinct ``fp``."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for low in range(0, len(values), 2000):
                anchor, fp, home = cover(max_bits).anchors(values[low : low + 2000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor, pa.int32()), pa.array(fp.view(np.int64)), pa.array(home)],
                    schema=ANCHOR_ROW,
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[np.ndarray]) -> pa.RecordBatch:
            a, b = _links(*rows, max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=LINK
            )

        rest: list[list[np.ndarray]] = []  # rows of the last anchor, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, fp, home = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            rows = [anchor, fp.view(np.uint64), home]
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if rest and rest[-1][0][-1] != anchor[0]:
                yield out([np.concatenate(c) for c in zip(*rest)])
                rest = []
            if cut:
                yield out([np.concatenate(c) for c in zip(*rest, [c[:cut] for c in rows])])
                rest = []
            rest.append([c[cut:] for c in rows])
        if rest:
            yield out([np.concatenate(c) for c in zip(*rest)])

    rows = fps.select("fp").mapInArrow(spread, "anchor int, fp long, home boolean")
    sorted_rows = rows.repartition("anchor").sortWithinPartitions("anchor", F.desc("home"))
    return sorted_rows.mapInArrow(compare, "a long, b long").distinct()


def connect(edges: DataFrame) -> DataFrame:
    """``node, root``: one root for each component of the links ``a, b``.

    In each round a node takes the neighbour (or itself) that comes first under the round's
    hash, and the links are drawn again between the nodes taken.  The hash makes a constant
    part of the nodes vanish in a round, whatever the shape of the component.
    """
    ways = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ways = settle(ways.where("a <> b").distinct(), "links")
    roots = settle(ways.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct(), "roots")
    turn = 0
    while not ways.isEmpty():
        turn += 1
        rank = lambda c: F.struct(
            F.xxhash64(c, F.lit(turn)).alias("rank"), F.col(c).alias("node")  # noqa: B023
        )
        taken = settle(
            ways.groupBy("a")
            .agg(F.min(rank("b")).alias("of_others"))
            .select("a", F.least(F.col("of_others"), rank("a"))["node"].alias("to")),
            "taken",
        )
        step = lambda c: taken.select(F.col("a").alias(c), F.col("to").alias(f"{c}_to"))  # noqa: E731, B023
        roots = settle(
            roots.join(step("root"), "root", "left").select(
                "node", F.coalesce("root_to", "root").alias("root")
            ),
            "roots",
        )
        drawn = ways.join(step("a"), "a").join(step("b"), "b")
        drawn = drawn.select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        ways = settle(drawn.where("a <> b").distinct(), "links")
    return roots


def components(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, component_id`` from ``doc_id, fp`` rows, one row for each distinct fingerprint."""
    fps = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = connect(links(fps, max_bits)).withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(named, "root").select("fp", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) ``, component_id`` for every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = settle(fingerprints(source, "text", words_each), "marked")
    found = components(marked, max_bits)
    return marked.join(found, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, nulls last.

    The row number breaks ties, so of repeated rows one stays; all columns are returned.
    """
    numbered = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("uid"),
    )
    numbered = settle(numbered.drop("text"), "numbered")
    texts = numbered.select("uid", "doc_id", F.col("row")[text_col].alias("text"))
    marked = settle(fingerprints(texts, "text", words_each), "marked")
    fps = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = connect(links(fps, max_bits)).withColumnRenamed("node", "fp")
    rooted = marked.join(roots, "fp", "left")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    first = rooted.groupBy(F.coalesce("root", "fp")).agg(F.min(order)["uid"].alias("uid"))
    return numbered.join(first.select("uid"), "uid", "left_semi").select("row.*")
