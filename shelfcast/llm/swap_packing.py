"""Best-fit packing of token pieces, mended by exchanges between underfull bins.

Documents become ids with a closing separator; one longer than a bin is cut into full pieces and
a rest.  Pieces are dealt into groups of about ``GROUP_PIECES``, whose number follows the count
of pieces, and each group is packed in one task: best-fit decreasing first, then a local search.
The search takes the emptiest bins as givers.  It moves a document to another underfull bin,
exchanges one for one, two for one or one for two, whenever the sum of squared fills grows, and
a bin that runs empty is gone.  It ends when a group has as few bins as its tokens need, or when
no underfull bin allows another change.  A group wastes less than one bin by itself.

Defined results: a null or empty text is the separator alone; repeated rows are packed each;
null ids stay; other columns are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from shelfcast.durable import settle
from shelfcast.llm.arrow import map_lists
from shelfcast.llm.word_ids import word_ids

#: Tokens in a sequence, pieces in a group.
CAPACITY, GROUP_PIECES = 2048, 10_000

PIECE_FIELDS = [
    StructField("piece", IntegerType()),
    StructField("start", LongType()),
    StructField("length", LongType()),
    StructField("ids_crc32", LongType()),
]
PLACE_FIELDS = [StructField("sequence_id", LongType()), StructField("offset", LongType())]


class _Bins:
    """Bins of piece lengths under a capacity, with the underfull ones indexed by gap."""

    def __init__(self, lengths: Sequence[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.gap: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that has room."""
        open_bins: list[list[int]] = [[] for _ in range(self.capacity + 1)]  # by gap
        gaps = 0  # bit g: some bin has gap g
        for i in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            size = self.lengths[i]
            room = gaps >> size
            if room:
                gap = size + (room & -room).bit_length() - 1
                b = open_bins[gap].pop()
                if not open_bins[gap]:
                    gaps ^= 1 << gap
            else:
                b, gap = len(self.items), self.capacity
                self.items.append([])
                self.gap.append(gap)
            self.items[b].append(i)
            self.gap[b] = gap = gap - size
            if gap:
                open_bins[gap].append(b)
                gaps |= 1 << gap

    def _options(self, items: list[int]) -> list[tuple[int, tuple]]:
        """One piece or two of a bin, for each length that they can have together.

        Equal lengths serve alike, so a bin of many short pieces has few options.
        """
        by_length: dict[int, list[int]] = {}
        for i in items:
            by_length.setdefault(self.lengths[i], []).append(i)
        found = {length: (same[0],) for length, same in by_length.items()}
        pairs: dict[int, tuple] = {}
        for n, (length, same) in enumerate(by_length.items()):
            if len(same) > 1:
                pairs.setdefault(2 * length, tuple(same[:2]))
            for other in list(by_length)[n + 1 :]:
                pairs.setdefault(length + other, (same[0], by_length[other][0]))
        return [*found.items(), *pairs.items()]

    def _offer(self, b: int) -> None:
        """What bin ``b`` may give back, if it is underfull: nothing, one piece or two."""
        self.offers.pop(b, None)
        if self.items[b] and self.gap[b]:
            options = [(0, ()), *self._options(self.items[b])]
            size = np.array([length for length, _ in options])
            self.offers[b] = size, size + self.gap[b], [pieces for _, pieces in options]

    def _table(self):
        """The offers of all underfull bins side by side.

        Pieces of ``size`` in bin ``owner`` can be replaced by anything longer, up to ``top``.
        """
        bins = sorted(self.offers)
        if not bins:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool), []
        back = [pieces for b in bins for pieces in self.offers[b][2]]
        size, top = (np.concatenate([self.offers[b][k] for b in bins]) for k in (0, 1))
        owner = np.repeat(bins, [len(self.offers[b][2]) for b in bins])
        return size, top, owner, np.array([len(pieces) < 2 for pieces in back], bool), back

    def _improve(self, giver: int, table) -> bool:
        """One exchange out of ``giver`` that makes the squared fills grow, if there is one."""
        size, top, owner, few, back = table
        fill = self.capacity - self.gap
        items = self.items[giver]
        gives = self._options(items)
        for length, pieces in sorted(gives, reverse=True):
            fits = (size < length) & (top >= length) & (owner != giver)
            if len(pieces) == 2:  # two for two is not among the moves
                fits &= few
            where = np.flatnonzero(fits)
            if not len(where):
                continue
            gain = length - size[where]
            grows = fill[owner[where]] + gain > fill[giver]
            where, gain = where[grows], gain[grows]
            if not len(where):
                continue
            best = where[np.lexsort((where, top[where] - length, -gain))[0]]
            taker, returned = int(owner[best]), back[best]
            self.items[giver] = [i for i in items if i not in pieces] + list(returned)
            self.items[taker] = [i for i in self.items[taker] if i not in returned] + list(pieces)
            moved = length - int(size[best])
            self.gap[giver] += moved
            self.gap[taker] -= moved
            self._offer(giver)
            self._offer(taker)
            return True
        return False

    def search(self) -> None:
        """Exchanges until no underfull bin has one that makes the squared fills grow."""
        least = -(-sum(self.lengths) // self.capacity)
        self.gap = np.array(self.gap, dtype=np.int64)
        self.offers: dict[int, tuple] = {}
        for b in range(len(self.items)):
            self._offer(b)
        used, changed = len(self.items), True
        while used > least and changed:  # each change makes the squared fills grow, so this ends
            table, changed = self._table(), False
            for giver in np.argsort(-self.gap, kind="stable").tolist():
                if not self.gap[giver] or used <= least:
                    break
                while self.items[giver] and self._improve(giver, table):
                    table, changed = self._table(), True
                    used -= not self.items[giver]


def pack(lengths: Sequence[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins as lists of positions in ``lengths``; each is at most ``capacity``."""
    full = [[i] for i, n in enumerate(lengths) if n == capacity]
    rest = [i for i, n in enumerate(lengths) if n < capacity]
    bins = _Bins([lengths[i] for i in rest], capacity)
    bins.best_fit()
    bins.search()
    return full + [[rest[i] for i in items] for items in bins.items if items]


def cut_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, separator: int = 0,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: what each document is cut into."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    end, size = np.array([separator], "<u4").tobytes(), 4 * capacity

    def start():
        encoder = word_ids(path)

        def work(texts: list) -> dict[str, list]:
            cut = []
            for text in texts:
                ids = (encoder.ids(text) if text else b"") + end
                cut.append([
                    {"piece": k, "start": at // 4, "length": len(ids[at : at + size]) // 4,
                     "ids_crc32": zlib.crc32(ids[at : at + size])}
                    for k, at in enumerate(range(0, len(ids), size))
                ])
            return {"pieces": cut}

        return work

    pieces = StructType([StructField("pieces", ArrayType(StructType(PIECE_FIELDS)))])
    made = map_lists(source, start, pieces, carry=1)
    return made.select("doc_id", F.inline("pieces"))


def pack_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, separator: int = 0, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; the offsets of a sequence have no gaps."""
    pieces = cut_pieces(docs, path, id_col, text_col, capacity, separator)
    pieces = settle(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid", ignore_index=True)
        lengths = group["length"].tolist()
        sequence, offset = [0] * len(group), [0] * len(group)
        first = int(group["grp"].iloc[0]) << 32
        for number, items in enumerate(pack(lengths, capacity)):
            at = 0
            for i in sorted(items):
                sequence[i], offset[i] = first + number, at
                at += lengths[i]
        return group.assign(sequence_id=sequence, offset=offset)[names]

    schema = StructType([pieces.schema["doc_id"]] + PIECE_FIELDS + PLACE_FIELDS)
    names = schema.names
    return dealt.groupBy("grp").applyInPandas(place, schema)
