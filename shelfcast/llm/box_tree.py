"""Hard negatives by best-first search of a sort-tile-recursive R-tree.

Rows are sorted by label, then by tiles of the two dimensions that vary most, and cut by count
into *shards*, so that neither the number of partitions nor a common vector decides a shard's
size.  Inside a shard the rows are tiled again over its own widest dimensions and packed into
leaves; a leaf is one stored row with its minimum bounding box, its labels and its smallest id.
A box gives each coordinate an interval of products with a query and their sum an interval of
scores.

A request asks one anchor for its ``k`` best rows with scores in a window, among rows of its own
label or of the others.  Requests first meet the boxes alone, which says what shards can hold
an answer; the most promising shard is searched first and its kth score spares most others.
Inside a shard a queue gives nodes by falling bound; a node goes unopened if its interval lies
outside every window or strictly below the kth of each (at the kth: if all its ids are larger).
A task holds one shard and at most ``CELL_QUERIES`` anchors.

Defined results: rows whose id, label or vector is null, or whose vector has a null or non-finite
component, take no part; missing components of a shorter vector count as 0; a row is no answer
to itself, other rows with its id are, and each of several anchors with one id has its own
results; a score outside 64 bits is the nearest 64-bit number, in windows too; fewer rows than
asked for are all returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.durable import settle
from shelfcast.llm.whole import finite, floored, matrix

#: Factor of the components; rows in a leaf and a shard; children of a node; anchors in a cell.
SCALE, LEAF_ROWS, SHARD_ROWS, FANOUT, CELL_QUERIES = 256, 64, 8_192, 8, 4_096
#: Boxes that a planning task holds.
CELL_BOXES = 16_384

LONG = np.iinfo(np.int64)

LEAVES = (
    "shard long, leaf int, label_low long, label_high long, least_id long, low array<double>, "
    "high array<double>, ids array<long>, uids array<long>, labels array<long>, flat array<double>"
)
HITS = "uid long, request int, hit_uid long, hit_id long, score long"
REACH = "uid long, shard long, low double, high double"


def clean_rows(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``uid, vec_id, label, vec`` of the rows that take part, written once."""
    source = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.col(vec_col).cast("array<double>").alias("raw"),
    ).where("vec_id is not null and label is not null")
    whole = source.where(finite(F.col("raw"))).select("vec_id", "label", floored(F.col("raw"), scale).alias("vec"))
    return settle(whole.select(F.monotonically_increasing_id().alias("uid"), "*"), "tree-rows")


def _widest(rows: DataFrame, number: int) -> list[int]:
    """The dimensions with the largest variance."""
    spread = (
        rows.select(F.posexplode("vec").alias("dim", "x"))
        .groupBy("dim")
        .agg(F.coalesce(F.var_samp("x"), F.lit(0.0)).alias("v"))
        .orderBy(F.desc("v"), "dim")
        .limit(number)
    )
    return [r.dim for r in spread.collect()]


def tiled(rows: DataFrame, shard_rows: int) -> DataFrame:
    """Rows with their ``shard``: runs of ``shard_rows`` in the order of label, tile, dimension, id."""
    spark = rows.sparkSession
    shards = max(1, -(-rows.count() // shard_rows))
    dims = _widest(rows, 2) + [0, 0]
    first, second = (F.coalesce(F.get("vec", F.lit(d)), F.lit(0.0)) for d in dims[:2])
    slabs = int(np.ceil(np.sqrt(shards)))
    steps = [i / slabs for i in range(1, slabs)]
    cuts = rows.agg(F.percentile_approx(first, steps)).first()[0] if steps else None
    slab = F.lit(0)
    if cuts:
        slab = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= first))
    order = ["label", "slab", "second", "vec_id", "uid"]
    # several ranges a shard: sampled ranges differ in size, counted runs do not
    ranges = max(4 * shards, spark.sparkContext.defaultParallelism)
    ranged = (
        rows.withColumn("slab", slab)
        .withColumn("second", second)
        .repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select("uid", "vec_id", "label", "vec")
        .withColumn("place", F.monotonically_increasing_id())
    )
    return number_runs(settle(ranged, "tree-order"), shard_rows)


def number_runs(ordered: DataFrame, run_rows: int, name: str = "shard") -> DataFrame:
    """Runs of ``run_rows`` consecutive rows; ``place`` is the position as Spark numbers it.

    Its upper bits are the partition and the lower 33 the row there, so a row's global position
    follows from the partitions' row counts, one number a partition.
    """
    part = F.shiftright("place", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    starts = counts.select("part", before.alias("before"))
    row = F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("before")
    numbered = ordered.withColumn("part", part).join(starts, "part")
    return numbered.withColumn(name, F.floor(row / run_rows).cast("long")).drop("part", "before")


def _tiles(rows: np.ndarray, keys: np.ndarray, leaf_rows: int, dims: list[int]) -> np.ndarray:
    """Order of the rows by recursive sorting into slabs, one dimension after the other."""
    order = np.lexsort((keys, rows[:, dims[0]] if dims else np.zeros(len(rows))))
    leaves = -(-len(rows) // leaf_rows)
    if len(dims) < 2 or leaves < 2:
        return order
    slabs = int(np.ceil(leaves ** (1 / len(dims))))
    size = -(-leaves // slabs) * leaf_rows
    parts = [order[i : i + size] for i in range(0, len(order), size)]
    return np.concatenate([p[_tiles(rows[p], keys[p], leaf_rows, dims[1:])] for p in parts])


def pack_leaves(shard: int, table: pa.Table, leaf_rows: int) -> pa.Table:
    """The shard's leaves, label by label in tile order, as rows of ``LEAVES``."""
    rows = matrix(table.column("vec"))
    ids, uids, labels = (table.column(c).to_numpy() for c in ("vec_id", "uid", "label"))
    by_id = np.lexsort((uids, ids))
    rows, ids, uids, labels = rows[by_id], ids[by_id], uids[by_id], labels[by_id]
    rank = np.arange(len(ids))
    wide = np.argsort(-rows.var(axis=0), kind="stable")[:3].tolist() if rows.shape[1] else []
    order = [
        pick[_tiles(rows[pick], rank[pick], leaf_rows, wide)]
        for label in np.unique(labels)
        for pick in [np.flatnonzero(labels == label)]
    ]
    order = np.concatenate(order)
    out = []
    for number, start in enumerate(range(0, len(order), leaf_rows)):
        pick = order[start : start + leaf_rows]
        box, named = rows[pick], labels[pick]
        out.append(
            (
                shard, number, int(named.min()), int(named.max()), int(ids[pick].min()),
                box.min(axis=0), box.max(axis=0), ids[pick], uids[pick], named, box.ravel(),
            )
        )
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out), _types(LEAVES))], names=_names(LEAVES)
    )


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _types(schema: str) -> list[pa.DataType]:
    known = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    known |= {f"array<{k}>": pa.list_(t) for k, t in list(known.items())}
    return [known[c.split()[1]] for c in schema.split(", ")]


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(_names(schema))
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _types(schema))], names=_names(schema)
    )


class Wanted:
    """An anchor's windows, each with the best rows so far and the score that the next must reach."""

    def __init__(self, windows: list[dict], top: int):
        self.top = top
        self.request = [w["request"] for w in windows]
        self.low = [max(w["low"], w["floor"]) if w["floor"] is not None else w["low"] for w in windows]
        self.high = [w["high"] for w in windows]
        # ids up to this one count at the lowest score
        self.last = [
            w["floor_id"] if w["floor"] is not None and w["floor"] >= w["low"] else LONG.max
            for w in windows
        ]
        self.best: list[list[tuple]] = [[] for _ in windows]

    def needs(self, low, high, least_id: int) -> bool:
        """Whether scores from ``low`` to ``high`` with ids from ``least_id`` matter to a window."""
        for bottom, top, last in zip(self.low, self.high, self.last):
            if low <= top and high >= bottom:
                reach = min(high, top)
                if reach > bottom or least_id <= last:
                    return True
        return False

    def take(self, scores: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        for w in range(len(self.best)):
            bottom = self.low[w]
            pick = (scores <= self.high[w]) & ((scores > bottom) | ((scores == bottom) & (ids <= self.last[w])))
            fresh = np.flatnonzero(pick)
            if not len(fresh):
                continue
            best = self.best[w]
            best += [(-int(scores[i]), int(ids[i]), int(uids[i])) for i in fresh]
            best.sort()
            del best[self.top :]
            if len(best) == self.top:
                self.low[w], self.last[w] = -best[-1][0], best[-1][1]


class Tree:
    """Levels of boxes over the leaves of one shard; ``FANOUT`` neighbours share a parent."""

    def __init__(self, leaves: pa.Table):
        leaves = leaves.take(np.argsort(leaves.column("leaf").to_numpy(), kind="stable"))
        low, high = (matrix(leaves.column(c)) for c in ("low", "high"))
        self.width = low.shape[1]
        get = lambda c: leaves.column(c).to_numpy()
        self.levels = [(low, high, get("label_low"), get("label_high"), get("least_id"))]
        while len(self.levels[-1][0]) > 1:
            low, high, first, last, least = self.levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            fold = lambda f, a: f.reduceat(a, cuts, axis=0) if a.size else a[cuts]
            self.levels.append(
                (
                    fold(np.minimum, low), fold(np.maximum, high), np.minimum.reduceat(first, cuts),
                    np.maximum.reduceat(last, cuts), np.minimum.reduceat(least, cuts),
                )
            )
        self.size = float(max(np.abs(self.levels[0][0]).max(initial=0), np.abs(self.levels[0][1]).max(initial=0)))
        lists = [leaves.column(c).combine_chunks() for c in ("ids", "uids", "labels", "flat")]
        self.held = [(a.offsets.to_numpy(), a.values.to_numpy(zero_copy_only=False)) for a in lists]

    def leaf(self, number: int) -> tuple[np.ndarray, ...]:
        ids, uids, labels, flat = (v[o[number] : o[number + 1]] for o, v in self.held)
        return ids, uids, labels, flat.reshape(len(ids), self.width)

    def search(self, query: np.ndarray, uid: int, label: int, same: bool, wanted: Wanted) -> None:
        query = np.pad(query[: self.width], (0, max(0, self.width - len(query))))
        exact = float(np.abs(query).max(initial=0)) * self.size * max(1, self.width) < 2**53
        whole = (lambda a: a) if exact else _whole
        query = whole(query)
        positive, negative = np.maximum(query, 0), np.minimum(query, 0)

        def children(level: int, start: int, stop: int) -> Iterator[tuple]:
            low, high, first, last, least = (a[start:stop] for a in self.levels[level])
            apt = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            low, high = whole(low), whole(high)
            tops, bottoms = high @ positive + low @ negative, low @ positive + high @ negative
            for i in np.flatnonzero(apt).tolist():
                yield clipped(tops[i]), clipped(bottoms[i]), int(least[i]), level, start + i

        queue: list[tuple] = []

        def push(nodes: Iterator[tuple]) -> None:
            for top, bottom, least, level, place in nodes:
                if wanted.needs(bottom, top, least):
                    heapq.heappush(queue, (-top, least, level, place, bottom))

        push(children(len(self.levels) - 1, 0, 1))
        while queue:
            top, least, level, place, bottom = heapq.heappop(queue)
            if not wanted.needs(bottom, -top, least):
                continue
            if level:
                push(children(level - 1, place * FANOUT, (place + 1) * FANOUT))
                continue
            ids, uids, labels, rows = self.leaf(place)
            pick = (labels == label) == same
            pick &= uids != uid
            scores = whole(rows) @ query
            if not exact:
                scores = np.array([clipped(s) for s in scores], dtype=object)
            wanted.take(scores[pick], ids[pick], uids[pick])


def _whole(values: np.ndarray) -> np.ndarray:
    """Python integers, for products beyond a double's whole numbers."""
    return np.vectorize(int, otypes=[object])(values) if values.size else values.astype(object)


def clipped(score) -> int:
    return int(min(max(int(score), LONG.min), LONG.max))


def build_leaves(rows: DataFrame, shard_rows: int, leaf_rows: int) -> DataFrame:
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        return pack_leaves(key[0].as_py(), table, leaf_rows)

    return settle(tiled(rows, shard_rows).groupBy("shard").applyInArrow(pack, LEAVES), "tree-leaves")


def reachable(leaves: DataFrame, anchors: DataFrame, same: bool, shards: int, asked: int) -> DataFrame:
    """``uid, shard, low, high``: shards with a leaf that a window of the anchor can meet.

    ``low`` and ``high`` span the intervals of those leaves.  Boxes and anchors meet in cells of
    bounded size; no vector of the searched rows moves.
    """
    groups = max(1, -(-asked // CELL_QUERIES))
    blocks = max(1, -(-shards // max(1, CELL_BOXES * LEAF_ROWS // SHARD_ROWS)))
    boxes = leaves.select(
        "shard", "label_low", "label_high", "low", "high", F.pmod("shard", F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"),
    )
    asks = anchors.select(
        "uid", "label", "vec", "windows", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int").alias("grp"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
    )

    def meet(key: tuple, boxes: pa.Table, asks: pa.Table) -> pa.Table:
        if not boxes.num_rows or not asks.num_rows:
            return _table(REACH, [])
        low, high = (matrix(boxes.column(c)) for c in ("low", "high"))
        queries = matrix(asks.column("vec").combine_chunks(), low.shape[1])
        shard, first, last = (boxes.column(c).to_numpy() for c in ("shard", "label_low", "label_high"))
        order = np.argsort(shard, kind="stable")
        low, high, shard, first, last = low[order], high[order], shard[order], first[order], last[order]
        cuts = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1))
        out = []
        uids, labels = asks.column("uid").to_numpy(), asks.column("label").to_numpy()
        for query, uid, label, windows in zip(queries, uids, labels, asks.column("windows").to_pylist()):
            positive, negative = np.maximum(query, 0), np.minimum(query, 0)
            tops, bottoms = high @ positive + low @ negative, low @ positive + high @ negative
            slack = 1e-9 * (np.maximum(np.abs(low), np.abs(high)) @ np.abs(query))
            slack[slack < 1e-9 * 2**50] = 0  # exact there
            tops, bottoms = (np.clip(a, -(2.0**63), 2.0**63) for a in (tops + slack, bottoms - slack))
            apt = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            meets = np.zeros(len(tops), bool)
            for w in windows:
                meets |= (tops >= float(w["low"])) & (bottoms <= float(w["high"]))
            apt &= meets
            top = np.maximum.reduceat(np.where(apt, tops, -np.inf), cuts)
            bottom = np.minimum.reduceat(np.where(apt, bottoms, np.inf), cuts)
            for i in np.flatnonzero(np.logical_or.reduceat(apt, cuts)).tolist():
                out.append((int(uid), int(shard[cuts[i]]), float(bottom[i]), float(top[i])))
        return _table(REACH, out)

    cells = boxes.groupBy("block", "grp").cogroup(asks.groupBy("block", "grp"))
    return cells.applyInArrow(meet, REACH)


def search_cells(leaves: DataFrame, anchors: DataFrame, cells: DataFrame, same: bool, top: int, groups: int) -> DataFrame:
    """Hits of every anchor in the shards that ``cells`` (``uid, shard``) names for it."""
    grp = F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")
    asks = cells.select("uid", "shard").join(anchors, "uid").withColumn("grp", grp)
    wanted = asks.select("shard", F.col("grp").alias("cell")).distinct()
    held = leaves.join(wanted, "shard")

    def run(key: tuple, leaves: pa.Table, asks: pa.Table) -> pa.Table:
        if not leaves.num_rows or not asks.num_rows:
            return _table(HITS, [])
        tree, out = Tree(leaves), []
        queries = matrix(asks.column("vec"))
        names = [asks.column(c).to_pylist() for c in ("uid", "label", "windows")]
        for query, uid, label, windows in zip(queries, *names):
            found = Wanted(windows, top)
            tree.search(query, uid, label, same, found)
            for request, best in zip(found.request, found.best):
                out += [(uid, request, u, i, -s) for s, i, u in best]
        return _table(HITS, out)

    return held.groupBy("shard", "cell").cogroup(asks.groupBy("shard", "grp")).applyInArrow(run, HITS)


def answer(leaves: DataFrame, anchors: DataFrame, same: bool, top: int) -> DataFrame:
    """``uid, request, rank, hit_uid, hit_id, score``: the ``top`` best rows of each window.

    ``anchors`` holds ``uid, label, vec, windows`` with ``request, low, high, floor, floor_id``.
    """
    shards = leaves.agg(F.max("shard")).first()[0]
    shards = 0 if shards is None else shards + 1
    asked = anchors.count()
    groups = max(1, -(-asked // CELL_QUERIES))
    reach = settle(reachable(leaves, anchors, same, shards, asked), "tree-reach")
    best = F.max_by("shard", F.struct("high", F.bitwise_not("shard"))).alias("shard")
    first = reach.groupBy("uid").agg(best)
    near = settle(search_cells(leaves, anchors, first, same, top, groups), "tree-near")
    # the kth of each window, where it has k
    order = Window.partitionBy("uid", "request").orderBy(F.desc("score"), "hit_id", "hit_uid")
    kth = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == top)
    kth = kth.groupBy("uid").agg(
        F.map_from_entries(F.collect_list(F.struct("request", F.struct("score", "hit_id")))).alias("kth")
    )
    raised = anchors.join(kth, "uid", "left").withColumn(
        "windows",
        F.transform(
            "windows",
            lambda w: F.struct(
                w["request"].alias("request"), w["low"].alias("low"), w["high"].alias("high"),
                F.try_element_at("kth", w["request"])["score"].alias("floor"),
                F.try_element_at("kth", w["request"])["hit_id"].alias("floor_id"),
            ),
        ),
    ).drop("kth")
    raised = settle(raised, "tree-floors")
    rest = reach.join(first, ["uid", "shard"], "left_anti").join(raised.select("uid", "windows"), "uid")
    meets = lambda w: (
        (F.col("high") >= w["low"]) & (F.col("low") <= w["high"])
        & (w["floor"].isNull() | (F.col("high") >= w["floor"]))
    )
    rest = rest.where(F.exists("windows", meets))
    far = search_cells(leaves, raised, rest, same, top, groups)
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top)


def mine_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    anchor_every: int = 100, scale: int = SCALE, positives: int = 5, negatives: int = 10,
    low_percent: int = 30, high_percent: int = 90, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id divides evenly; their positives are the best rows of their
    label, and a positive's negatives the best rows of other labels whose score lies between the
    two percentages of the positive's.
    """
    rows = clean_rows(vectors, id_col, vec_col, label_col, scale)
    leaves = build_leaves(rows, shard_rows, leaf_rows)
    anchors = rows.where(F.pmod("vec_id", F.lit(anchor_every)) == 0)
    blank = F.lit(None).cast("long")

    def window(request, low, high):
        return F.struct(
            request.cast("int").alias("request"), low.cast("long").alias("low"), high.cast("long").alias("high"),
            blank.alias("floor"), blank.alias("floor_id"),
        )

    every = F.array(window(F.lit(0), F.lit(int(LONG.min)), F.lit(int(LONG.max))))
    asks = settle(anchors.select("uid", "vec_id", "label", "vec", every.alias("windows")), "tree-anchors")
    found = answer(leaves, asks.drop("vec_id"), True, positives)
    found = settle(found.select("uid", "rank", "hit_id", "score"), "tree-positives")
    # whole numbers: low * p <= 100 * n <= high * p, rounded inwards; nothing below a score of 0
    wide = F.col("score").cast("decimal(20,0)")
    ends = F.ceil(wide * low_percent / 100), F.floor(wide * high_percent / 100)
    least, most = (F.greatest(F.least(e, F.lit(int(LONG.max))), F.lit(int(LONG.min))) for e in ends)
    windows = F.sort_array(F.collect_list(window(F.col("rank"), least, most))).alias("windows")
    # a negative score's window has its ends the wrong way round: no row
    second = found.where(least <= most).groupBy("uid").agg(windows)
    asks2 = settle(asks.drop("windows", "vec_id").join(second, "uid"), "tree-requests")
    hits = answer(leaves, asks2, False, negatives)
    named = found.select("uid", F.col("rank").alias("request"), F.col("hit_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        hits.join(named, ["uid", "request"])
        .join(asks.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
        .select(
            "anchor_id", "positive_id", "rank", F.col("hit_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )
