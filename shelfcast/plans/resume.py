"""Batch runs that continue where a lost one stopped.

The folder of a run holds its tables: ``results``, one row per finished series, is the ledger; models,
forecasts and comparisons lie beside it.  A start scans the sales once, for the series without a
finished row, and works them off in chunks.  A chunk's results are appended after its other
tables, so a series with a result has all its rows, and one without has none that count: every row
carries the number of its attempt, and readers follow the attempt of the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import weekly
from shelfcast.plans import batch
from shelfcast.schemas import METRICS, SERIES
from shelfcast.sources import tables

CHUNKS = 8

RESULTS = T.StructType(
    [T.StructField(c, T.DoubleType() if c in METRICS else T.StringType()) for c in batch.RESULT_COLUMNS]
    + [T.StructField("attempt", T.IntegerType())]
)
ATTEMPTS = T.StructType(
    [T.StructField("attempt", T.IntegerType()), T.StructField("series", T.LongType())]
)
#: Frames of a run that are kept beside its results.
KEPT = ("models", "forecast", "comparison")


def _ledger(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """A ledger table, made empty by the first start."""
    path = f"{folder}/{name}"
    spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def results(spark: SparkSession, folder: str) -> DataFrame:
    """The latest result of every finished series, with its attempt."""
    newest = Window.partitionBy(*SERIES).orderBy(F.desc("attempt"))
    rows = _ledger(spark, folder, "results", RESULTS)
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def rows_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stored models, forecasts or comparisons that belong to the results."""
    counted = results(spark, folder).select(*SERIES, "attempt")
    return spark.read.parquet(f"{folder}/{name}").join(counted, [*SERIES, "attempt"], "left_semi")


def run_resumable(
    sales: DataFrame,
    series: DataFrame,
    folder: str,
    weather: DataFrame | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    weather_grain: str = "day",
    chunks: int = CHUNKS,
    retry_failed: bool = False,
    **options,
) -> DataFrame:
    """Finish the run in ``folder``: its results, whichever attempt they come from.

    ``options`` are those of :func:`batch.run_cells` and should be the same at every start, like
    the sales.  ``folder`` lies where driver and executors of later jobs can reach it.  Series
    whose fit failed count as finished unless ``retry_failed``.  A start that finds nothing to do
    reads the ledger only.
    """
    spark = series.sparkSession
    finished = results(spark, folder)
    if retry_failed:
        finished = finished.where(F.col("Status") != weekly.FAILED)
    # A hash per series, so that a chunk is the same series in every table of this attempt.
    chunk = F.pmod(F.xxhash64(*SERIES), F.lit(chunks)).cast("int")
    wanted = series.select(*SERIES).distinct().join(finished, SERIES, "left_anti")
    before = _ledger(spark, folder, "attempts", ATTEMPTS)
    attempt = 1 + (before.agg(F.max("attempt")).first()[0] or 0)
    todo_path = f"{folder}/todo/attempt={attempt}"
    wanted.withColumn("chunk", chunk).write.parquet(todo_path)
    todo = spark.read.schema(_todo_schema(series)).parquet(todo_path)
    waiting = todo.groupBy("chunk").count().orderBy("chunk").collect()
    started = spark.createDataFrame([(attempt, sum(r["count"] for r in waiting))], ATTEMPTS)
    started.coalesce(1).write.mode("append").parquet(f"{folder}/attempts")
    if not waiting:
        return results(spark, folder)

    cells_path = f"{folder}/cells/attempt={attempt}"
    cells = batch.requested_cells(sales, todo, weather, start_date, end_date, weather_grain)
    tables.overwrite(cells.withColumn("chunk", chunk), cells_path, ["chunk"])
    schema = cells.schema.add("chunk", T.IntegerType())
    stored = spark.read.schema(schema).parquet(cells_path)
    number = F.lit(attempt).cast("int")
    for row in waiting:
        mine = F.col("chunk") == row["chunk"]
        run = batch.run_cells(
            stored.where(mine).drop("chunk"),
            todo.where(mine).drop("chunk"),
            weather_grain=weather_grain,
            **options,
        )
        for name in KEPT:
            kept = getattr(run, name).withColumn("attempt", number)
            kept.write.mode("append").parquet(f"{folder}/{name}")
        # Scores come from the comparison just written, so results and stored rows agree.
        scored = spark.read.parquet(f"{folder}/comparison").where(F.col("attempt") == number)
        scored = scored.join(todo.where(mine), SERIES, "left_semi")
        done = batch.result_table(
            todo.where(mine), run.gate, run.weekly, run.models, scored, run.validation_days
        )
        done.withColumn("attempt", number).write.mode("append").parquet(f"{folder}/results")
    return results(spark, folder)


def _todo_schema(series: DataFrame) -> T.StructType:
    fields = [series.schema[c] for c in SERIES]
    return T.StructType([*fields, T.StructField("chunk", T.IntegerType())])
