"""Lineage cuts that survive executor loss, spreading of costly and of repeated rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Scratch folder of a local session that names none, by application.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a scratch folder in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Spark setting: what a statement exchanged is deleted when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What a write in this block exchanges leaves the disks as soon as that write is done.

    Otherwise it stays until the driver happens to collect its garbage, below all later jobs.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several later jobs read the same costly result.  Unlike a cache the
    files outlive any executor, and readers still prune columns and row groups.  Packed tightly,
    because the folder is shared.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Several partitions per core at least, by ``keys``; as many as shuffles have if that is more.

    Without keys the rows are dealt out in turn.

    For rows that cost time rather than bytes (a fit): their size says nothing, so the number is
    given and not left to adaptive coalescing.
    """
    spark = df.sparkSession
    least = 4 * spark.sparkContext.defaultParallelism
    return df.repartition(max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


#: Rows made from one row at once when rows are repeated.
REPEAT_CHUNK = 1024


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its ``times`` column says, without that column.

    A row is unrolled where it is, up to one chunk of copies.  Further copies become chunks of
    their own, which are dealt out evenly over the cluster: a row repeated a billion times
    neither sits in one task nor in one array, and the others are not shuffled for it.
    """
    names = [c for c in df.columns if c != times]

    def unrolled(rows: DataFrame, count: Column) -> DataFrame:
        copies = F.sequence(F.lit(1), count.cast("int"))
        return rows.select(*names, F.explode(copies).alias("_copy")).drop("_copy")

    here = unrolled(df.where(F.col(times) > 0), F.least(F.col(times), F.lit(REPEAT_CHUNK)))
    left = F.col(times) - F.lit(REPEAT_CHUNK).cast("bigint")
    last = F.floor((left - 1) / REPEAT_CHUNK).cast("bigint")
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_chunk")
    chunks = spread(
        df.where(left > 0).select(*names, left.alias("_left"), numbers), [*names, "_chunk"]
    )
    rest = F.col("_left") - F.col("_chunk") * REPEAT_CHUNK
    there = unrolled(chunks, F.least(rest, F.lit(REPEAT_CHUNK)))
    return here.unionByName(there)
