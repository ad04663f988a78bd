"""Codes of vectors by product quantisation, with Lloyd rounds whose members stay where they are.

Vectors become whole numbers and are cut into parts; each part position has a codebook.  A part
is a member of its nearest entry and lies with the owner ``(position, entry, salt)``; an entry
has as many salts as its members need, so that a common vector does not fill one owner.  A round

* lets the owners add up their resident members, which gives the entries,
* lets every member look for its nearest entry, where it lies, and
* moves only the parts whose entry changed to their new owners.

Each round's members are written once; those that stay are read from where they were written,
and only the others pass the exchange.  What reaches the driver is the codebooks and one row an
entry, both bounded by the parameters and the width of a vector.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped, a
null id or label is kept; components that a vector lacks against the longest one, rounded up to a
multiple of the parts, count as 0; fewer rows than entries make a shorter codebook, no rows no
result; whole numbers are exact at any size, and errors outside 64 bits are the nearest 64-bit
number; each of several rows with one id has its own code (for the first codebook they are taken
in order of their vectors).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.durable import settle
from shelfcast.llm.whole import finite, floored, matrix

#: Factor of the components, parts of a vector, entries of a codebook, rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Members that an owner is meant for.
OWNER_ROWS = 2_048

LONG = np.iinfo(np.int64)

MEMBERS = "uid long, position int, entry int, moved boolean, distance long, part array<double>"
SUMS = "position int, entry int, n long, sums array<string>"
MEANS = "position int, entry int, mean array<string>"

#: ``codebooks[position][entry]`` is a list of Python integers.
Codebooks = list[list[list[int]]]


def _arrow(schema: str) -> pa.Schema:
    known = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    known |= {"array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, known[kind]) for name, kind in (c.split() for c in schema.split(", "))])


class Nearest:
    """The nearest entry of one codebook, ties to the lower index, with the squared distance."""

    def __init__(self, entries: list[list[int]]):
        self.whole = np.array(entries, object).reshape(len(entries), len(entries[0]) if entries else 0)
        self.top = max((abs(x) for e in entries for x in e), default=0)
        self.plain = self.whole.astype(float) if self.top < 2**53 else None
        self.norms = None if self.plain is None else (self.plain**2).sum(axis=1)

    def find(self, parts: np.ndarray) -> tuple[np.ndarray, list[int]]:
        width = max(1, parts.shape[1])
        sizes = np.abs(parts).max(axis=1, initial=0)
        exact = (sizes + float(self.top)) ** 2 * width < 2**53
        entry, distance = np.zeros(len(parts), np.int32), np.zeros(len(parts), object)
        if exact.any():  # whole numbers that doubles hold: products are exact
            near = parts[exact]
            gaps = (near**2).sum(axis=1)[:, None] - 2 * (near @ self.plain.T) + self.norms
            best = gaps.argmin(axis=1)
            entry[exact], distance[exact] = best, gaps[np.arange(len(near)), best].astype(np.int64)
        for i in np.flatnonzero(~exact).tolist():
            gap = ((self.whole - np.array([int(x) for x in parts[i]], object)) ** 2).sum(axis=1)
            gap = gap.tolist()
            entry[i] = min(range(len(gap)), key=gap.__getitem__)
            distance[i] = gap[entry[i]]
        return entry, [min(int(d), int(LONG.max)) for d in distance]


def _members(uid, position, entry, moved, distance, parts: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(len(parts) + 1, dtype=np.int32) * parts.shape[1]
    columns = [uid, position, entry, moved, distance, pa.ListArray.from_arrays(offsets, parts.ravel())]
    schema = _arrow(MEMBERS)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)],
        names=schema.names,
    )


def cut_and_assign(rows: DataFrame, codebooks: Codebooks, width: int) -> DataFrame:
    """Every part of ``uid, vec`` with its nearest entry; all of them have to move."""
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [Nearest(c) for c in codebooks]
        for batch in batches:
            whole = matrix(batch.column("vec"), parts * width)
            for position in range(parts):
                mine = np.ascontiguousarray(whole[:, position * width : (position + 1) * width])
                entry, distance = near[position].find(mine)
                place = np.full(len(mine), position, np.int32)
                yield _members(batch.column("uid"), place, entry, np.ones(len(mine), bool), distance, mine)

    return rows.select("uid", "vec").mapInArrow(run, MEMBERS)


def reassign(members: DataFrame, codebooks: Codebooks) -> DataFrame:
    """Members where they lie, each with its nearest entry now and whether that is another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [Nearest(c) for c in codebooks]
        for batch in batches:
            uid, place, old = (batch.column(c).to_numpy() for c in ("uid", "position", "entry"))
            parts = matrix(batch.column("part"))
            for position in np.unique(place).tolist():
                pick = place == position
                entry, distance = near[position].find(parts[pick])
                yield _members(uid[pick], place[pick], entry, entry != old[pick], distance, parts[pick])

    return members.select("uid", "position", "entry", "part").mapInArrow(run, MEMBERS)


def migrate(assigned: DataFrame) -> DataFrame:
    """Members with their owners: those whose entry changed pass an exchange, the others none."""
    sizes = assigned.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("held"))
    salts = sizes.select("position", "entry", F.ceil(F.col("held") / OWNER_ROWS).alias("salts"))
    moving = (
        assigned.where("moved")
        .join(salts, ["position", "entry"])
        .withColumn("salt", F.pmod(F.xxhash64("uid"), "salts"))
        .repartition("position", "entry", "salt")
    )
    return assigned.where("not moved").unionByName(moving.drop("salts", "salt"))


def resident_means(members: DataFrame) -> DataFrame:
    """``position, entry, mean``: owners' sums of what they hold, joined per entry, floored means."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("position", "entry")])
            parts = matrix(batch.column("part"))
            order = np.lexsort(keys[::-1])
            keys, parts = keys[:, order], parts[order]
            starts = np.flatnonzero((np.diff(keys, axis=1, prepend=keys[:, :1] - 1) != 0).any(axis=0))
            small = np.abs(parts).max(initial=0) < 2**31
            whole = parts.astype(np.int64) if small else np.vectorize(int, otypes=[object])(parts)
            totals = np.add.reduceat(whole, starts, axis=0) if whole.shape[1] else whole[starts]
            counts = np.diff(starts, append=len(parts))
            for key, n, total in zip(keys[:, starts].T.tolist(), counts.tolist(), totals.tolist()):
                held = sums.setdefault(tuple(key), [0, [0] * len(total)])
                held[0] += n
                held[1] = [a + b for a, b in zip(held[1], total)]
        rows = [(p, e, n, [str(x) for x in total]) for (p, e), (n, total) in sorted(sums.items())]
        schema = _arrow(SUMS)
        columns = list(zip(*rows)) or [()] * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, schema.types)]
        yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def mean(key: tuple, sums: pa.Table) -> pa.Table:
        count = sum(sums.column("n").to_pylist())
        lists = [[int(x) for x in s] for s in sums.column("sums").to_pylist()]
        means = [str(sum(column) // count) for column in zip(*lists)]
        row = {"position": [key[0].as_py()], "entry": [key[1].as_py()], "mean": [means]}
        return pa.table(row, _arrow(MEANS))

    partial = members.select("position", "entry", "part").mapInArrow(add, SUMS)
    return partial.groupBy("position", "entry").applyInArrow(mean, MEANS)


def first_codebooks(rows: DataFrame, entries: int, parts: int, width: int) -> Codebooks:
    """The parts of the rows with the smallest ids: ``entries`` rows at most come to the driver."""
    least = rows.orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).select("vec").collect()
    whole = [[int(x) for x in r.vec] + [0] * (parts * width - len(r.vec)) for r in least]
    return [[v[p * width : (p + 1) * width] for v in whole] for p in range(parts)]


def digest(codebooks: Codebooks) -> str:
    text = ",".join(str(x) for book in codebooks for entry in book for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def _long(total: Column) -> Column:
    return F.least(total, F.lit(int(LONG.max))).cast("long")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, entries, error`` of every row that takes part, and the final codebooks."""
    source = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.col(vec_col).cast("array<double>").alias("raw"),
    )
    kept = source.where(finite(F.col("raw"))).select("vec_id", "label", floored(F.col("raw"), scale).alias("vec"))
    rows = settle(kept.select(F.monotonically_increasing_id().alias("uid"), "*"), "lloyd-rows")
    longest = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    width = -(-longest // parts)
    codebooks = first_codebooks(rows, entries, parts, width)
    assigned = settle(cut_and_assign(rows, codebooks, width), "lloyd-members")
    for _ in range(rounds):
        members = migrate(assigned)
        for r in resident_means(members).collect():  # a row an entry
            codebooks[r.position][r.entry] = [int(x) for x in r.mean]
        assigned = settle(reassign(members, codebooks), "lloyd-members")
    at = [F.max(F.when(F.col("position") == p, F.col("entry"))) for p in range(parts)]
    error = _long(F.sum(F.col("distance").cast("decimal(38,0)")))
    codes = assigned.groupBy("uid").agg(F.array(*at).alias("entries"), error.alias("error"))
    return rows.select("uid", "vec_id", "label").join(codes, "uid").drop("uid"), codebooks


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the sum of errors over its label; null labels are one."""
    total = _long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error")
    sums = coded.groupBy(F.col("label").alias("of")).agg(total)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def code_text(entries: Column, digits: int = 2) -> Column:
    return F.array_join(F.transform(entries, lambda e: F.lower(F.lpad(F.hex(e), digits, "0"))), "")
