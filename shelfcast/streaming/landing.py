"""Folding arriving files into a stored table with Structured Streaming.

Each micro-batch restates the dates its files contain, by the same rule as the batch replay:
per date the latest file wins.  Only the partitions of those dates are rewritten.

A file day may come as many part files, and those in any number of micro-batches.  So a batch's
rows are first kept beside the table, under the number of the batch, and a date is folded from
everything that has arrived of its file days.  Running a batch again, after a failure, replaces
its own rows and gives the same table, and a file that arrives late never overrides a newer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfcast.functions.text import trim_text_columns
from shelfcast.operators.ingest import FILE_DAY, replay
from shelfcast.sources import published
from shelfcast.sources.tables import read_table, replace_partitions


#: Number of the micro-batch that brought a row.
BATCH = "_batch"


def fold_batch(
    batch: DataFrame, main_path: str, arrived_path: str, batch_id: int, trim: bool = False,
    publish: bool = False,
) -> None:
    """Fold one micro-batch of landing rows into the table at ``main_path``.

    ``arrived_path`` keeps the rows of all batches so far.  A file day that is there replaces
    stored rows of the same file day; stored rows of other file days take part as they are.
    The folder can be emptied whenever no file day is half arrived.  Partitions of the table are
    read and replaced in place: the storage must commit a dynamic partition overwrite at once, or
    readers must wait for it.  With ``publish`` the table is a published one, which asks neither.
    """
    spark = batch.sparkSession
    rows = trim_text_columns(batch) if trim else batch
    replace_partitions(
        rows.withColumn(BATCH, F.lit(batch_id).cast("long")), arrived_path, [BATCH, "date"]
    )
    whole = T.StructType([*rows.schema.fields, T.StructField(BATCH, T.LongType())])
    arrived = read_table(spark, arrived_path, whole)
    mine = arrived.where(F.col(BATCH) == batch_id)
    # Calendar dates and file dates: both sets are bounded by the calendar.
    days = F.broadcast(mine.select(F.col("date").alias("_day")).distinct())
    # The span of the batch prunes the stored partitions before the exact match.
    first, last = (mine.agg(f("date")).scalar() for f in (F.min, F.max))

    def of_these_days(table: DataFrame) -> DataFrame:
        near = table.where(F.col("date").isNull() | F.col("date").between(first, last))
        return near.join(days, F.col("date").eqNullSafe(F.col("_day")), "left_semi")

    here = of_these_days(arrived).drop(BATCH)
    files = F.broadcast(arrived.select(FILE_DAY).distinct())
    base = published.latest(spark, main_path) if publish else None
    if publish:
        main = published.read(spark, main_path, rows.schema, base)
    else:
        main = read_table(spark, main_path, rows.schema)
    stored = of_these_days(main).join(files, FILE_DAY, "left_anti")
    folded = replay(stored.select(*rows.columns).unionByName(here.select(*rows.columns)))
    if publish:
        published.publish(folded, main_path, ["date"], base, note=f"batch {batch_id}")
    else:
        replace_partitions(folded, main_path, ["date"])


def fold_arriving_files(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType,
    main_path: str,
    checkpoint: str,
    trim: bool = False,
    max_files_per_batch: int = 1000,
    publish: bool = False,
) -> StreamingQuery:
    """Fold everything that has arrived and stop; run again for what arrives later.

    ``checkpoint`` is a folder every executor can reach; the arrived rows are kept beside it,
    in ``<checkpoint>-arrived``.
    """
    arriving = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .parquet(landing_path)
    )

    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, main_path, f"{checkpoint}-arrived", batch_id, trim, publish)

    return (
        arriving.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
