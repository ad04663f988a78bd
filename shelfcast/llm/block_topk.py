"""Exact top-k inner products with block-at-a-time pruning.

Vectors become integers and are sorted so that neighbours agree in their largest components.
Ranges of that order are *shards*, each cut into blocks of consecutive rows.  A block has a
forward index (its rows' components) and the maxima of its terms, a term being a dimension with
a sign; the sum of a query's products with the maxima bounds every score in the block.  A query
takes blocks by falling bound and stops when the next bound is below its kth score.

A query first searches the shard it lies in, which gives a kth score to start from, then meets
every other shard in cells of one shard and one group of queries.  A cell's task holds a shard
and streams the queries, so its memory does not grow with the data.

Defined results: rows whose id or vector is null, or whose vector has a null or non-finite
component, take no part; missing components of a shorter vector count as 0; a query's own row is
no candidate, but other rows with its id are; a score outside 64 bits is the nearest 64-bit
number; fewer candidates than ``k`` are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.durable import settle

#: Factor of the components, rows in a block and a shard, queries in a cell, results of a query.
SCALE, BLOCK_ROWS, SHARD_ROWS, CELL_QUERIES, TOP = 64, 64, 8_192, 4_096, 20

LONG = np.iinfo(np.int64)

NAMES = ["shard", "uid", "vec_id", "is_query", "vec"]
HITS = "query_uid long, query_id long, vec_uid long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, vec`` of the rows that take part; ``vec`` holds whole numbers as doubles."""
    source = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("raw")
    )
    inf = F.lit(float("inf"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    whole = source.where("vec_id is not null and raw is not null").where(finite)
    # double: floor() of Spark gives a long, which a huge component does not fit
    step = lambda x: F.floor(x * scale).cast("double")
    huge = lambda x: F.abs(x * scale) >= 2.0**53  # noqa: E731  a whole number already
    return whole.select(
        "vec_id", F.transform("raw", lambda x: F.when(huge(x), x * scale).otherwise(step(x))).alias("vec")
    )


def _largest(rank: int):
    """The dimension, with its sign, of the component that is ``rank``-th in size."""
    sizes = F.transform("vec", F.abs)
    place = F.array_position(sizes, F.get(F.sort_array(sizes, asc=False), F.lit(rank)))
    return place * F.signum(F.try_element_at("vec", place.cast("int")))


def _long(score) -> int:
    return int(min(max(int(score), LONG.min), LONG.max))


def _matrix(vecs: pa.ListArray) -> np.ndarray:
    """Rows of equal length, padded with 0."""
    lengths = np.diff(vecs.offsets.to_numpy())
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = vecs.flatten().to_numpy()
    return out


class Shard:
    """Blocks of consecutive rows with their forward index and term maxima."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, uids: np.ndarray, block_rows: int):
        self.rows, self.ids, self.uids, self.block_rows = rows, ids, uids, block_rows
        starts = np.arange(0, len(rows), block_rows)
        wide = rows.shape[1] > 0
        self.most = np.maximum.reduceat(rows, starts) if wide else np.zeros((len(starts), 0))
        self.least = np.minimum.reduceat(rows, starts) if wide else np.zeros((len(starts), 0))
        self.size = float(np.abs(rows).max(initial=0))

    def fitted(self, queries: np.ndarray) -> np.ndarray:
        """Queries with as many components as the rows; a row's missing ones are 0."""
        have, want = queries.shape[1], self.rows.shape[1]
        return queries[:, :want] if have >= want else np.pad(queries, ((0, 0), (0, want - have)))

    def search(
        self, query: np.ndarray, own: int, floor: int | None, last_id: int | None, top: int
    ) -> list[tuple]:
        """The ``top`` best ``(score, id, uid)``, all ties broken by id.

        Scores below ``floor`` are left out, and equal ones with an id after ``last_id``: as
        many better ones are known elsewhere.
        """
        floor = None if floor == LONG.min else floor
        exact = float(np.abs(query).max(initial=0)) * self.size * max(1, len(query)) < 2**53
        rows, most, least = self.rows, self.most, self.least
        if not exact:  # whole numbers of any size
            as_int = np.vectorize(int, otypes=[object])
            query = as_int(query) if len(query) else query
            rows, most, least = (as_int(m) if m.size else m for m in (rows, most, least))
        positive, negative = np.maximum(query, 0), np.minimum(query, 0)
        bounds = most @ positive + least @ negative
        order = np.argsort(-bounds, kind="stable")
        best: list[tuple] = []
        for block in order.tolist():
            if floor is not None and bounds[block] < floor:
                break
            low = block * self.block_rows
            scores = rows[low : low + self.block_rows] @ query
            ids, uids = (a[low : low + self.block_rows] for a in (self.ids, self.uids))
            pick = uids != own
            if floor is not None:
                pick &= ((scores > floor) | ((scores == floor) & (ids <= last_id))).astype(bool)
            fresh = np.flatnonzero(pick)
            if not len(fresh):
                continue
            best += [(-_long(scores[i]), int(ids[i]), int(uids[i])) for i in fresh]
            best = sorted(best)[:top]
            if len(best) == top:  # all of them reach the floor, so the last one is the new floor
                floor, last_id = -best[-1][0], best[-1][1]
        return [(-s, i, u) for s, i, u in best]


def _hits(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in HITS.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _load(batches: list[pa.RecordBatch], block_rows: int) -> Shard:
    whole = pa.Table.from_batches(batches).combine_chunks()
    vecs = whole.column("vec").combine_chunks()
    ids, uids = (whole.column(c).to_numpy() for c in ("vec_id", "uid"))
    return Shard(_matrix(vecs), ids, uids, block_rows)


def build_shards(
    vectors: DataFrame, id_col: str, vec_col: str, query_every: int, scale: int, shard_rows: int
) -> DataFrame:
    """``shard, uid, vec_id, is_query, vec``, written in the order of the blocks."""
    clean = quantised(vectors, id_col, vec_col, scale)
    clean = clean.withColumn("is_query", F.pmod("vec_id", F.lit(query_every)) == 0)
    clean = settle(clean.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    shards = max(1, -(-clean.count() // shard_rows))
    ranged = (
        clean.withColumn("first", F.coalesce(_largest(0), F.lit(0.0)))
        .withColumn("second", F.coalesce(_largest(1), F.lit(0.0)))
        .repartitionByRange(shards, "first", "second", "uid")
        .sortWithinPartitions("first", "second", "uid")
        .select("uid", "vec_id", "is_query", "vec")
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        for batch in batches:
            first = pa.array(np.full(batch.num_rows, shard), pa.int64())
            yield pa.RecordBatch.from_arrays([first, *batch.columns], names=NAMES)

    numbered = ranged.mapInArrow(
        number, "shard long, uid long, vec_id long, is_query boolean, vec array<double>"
    )
    return settle(numbered.withColumn("place", F.monotonically_increasing_id()), "shards")


def _own_shard(shards: DataFrame, block_rows: int, top: int) -> DataFrame:
    """Hits of every query in the shard that it lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            shard = _load(rows, block_rows)
            asks = np.flatnonzero(pa.Table.from_batches(rows).column("is_query").to_numpy())
            found = []
            for i in asks.tolist():
                own, name = int(shard.uids[i]), int(shard.ids[i])
                hits = shard.search(shard.rows[i], own, None, None, top)
                found += [(own, name, u, v, s) for s, v, u in hits]
            return _hits(found)

        rest: list[pa.RecordBatch] = []
        for batch in batches:
            column = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                part = batch.slice(low, high - low)
                if rest and part.num_rows and rest[-1].column(0)[0] != part.column(0)[0]:
                    yield out(rest)
                    rest = []
                if part.num_rows:
                    rest.append(part)
        if rest:
            yield out(rest)

    ordered = shards.repartition("shard").sortWithinPartitions("shard", "place")
    return ordered.select(*NAMES).mapInArrow(run, HITS)


def _other_shards(
    shards: DataFrame, floors: DataFrame, block_rows: int, cell_queries: int, top: int
) -> DataFrame:
    """Hits of every query in all shards but its own, from its floor upwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows, shard = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "grp", "kind")])
            changes = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            cuts = [0, *changes.tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                part, here = batch.slice(low, high - low), tuple(keys[:2, low].tolist())
                if here != cell:
                    cell, rows, shard = here, [], None
                if keys[2, low] == 0:
                    rows.append(part)
                    continue
                if shard is None:
                    if not rows:  # a range without rows
                        continue
                    shard = _load(rows, block_rows)
                found = []
                queries = shard.fitted(_matrix(part.column("vec")))
                names = [part.column(c).to_pylist() for c in ("uid", "vec_id", "floor", "last_id")]
                for query, own, name, floor, last_id in zip(queries, *names):
                    hits = shard.search(query, own, floor, last_id, top)
                    found += [(own, name, u, v, s) for s, v, u in hits]
                yield _hits(found)

    queries = shards.where("is_query").join(floors, "uid", "left")
    groups = max(1, -(-shards.where("is_query").count() // cell_queries))
    last = shards.agg(F.max("shard")).first()[0]
    if last is None:
        last = 0

    def upto(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n).cast("long")))

    held = shards.select(
        "shard", upto(groups - 1).alias("grp"), F.lit(0).alias("kind"), "place", "uid", "vec_id",
        "vec", *[F.lit(None).cast("long").alias(c) for c in ("floor", "last_id")],
    )
    asked = queries.select(
        F.col("shard").alias("lies_in"), upto(last).alias("shard"),
        F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("long").alias("grp"), F.lit(1).alias("kind"),
        "place", "uid", "vec_id", "vec", "floor", "last_id",
    ).where("lies_in <> shard")
    cells = held.unionByName(asked.drop("lies_in")).repartition("shard", "grp")
    return cells.sortWithinPartitions("shard", "grp", "kind", "place").mapInArrow(run, HITS)


def top_products(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", query_every: int = 20,
    scale: int = SCALE, top: int = TOP, block_rows: int = BLOCK_ROWS,
    shard_rows: int = SHARD_ROWS, cell_queries: int = CELL_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``top`` of each row whose id divides evenly."""
    shards = build_shards(vectors, id_col, vec_col, query_every, scale, shard_rows)
    near = settle(_own_shard(shards, block_rows, top), "own-hits")
    worst = F.max_by(F.struct("score", "vec_id"), F.struct(F.bitwise_not("score"), "vec_id"))
    floors = (
        near.groupBy(F.col("query_uid").alias("uid"))
        .agg(F.when(F.count(F.lit(1)) == top, worst).alias("last"))
        .select("uid", F.col("last.score").alias("floor"), F.col("last.vec_id").alias("last_id"))
    )
    far = _other_shards(shards, floors, block_rows, cell_queries, top)
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "vec_uid")
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
