"""Partitioned Parquet tables: create, append, replace partitions, and result sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.limit(0)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: str,
    path: str,
    description: str | None = None,
    replace: bool = False,
) -> None:
    """Register an empty partitioned table; ``replace`` drops an older definition first."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    names = [f.name for f in schema.fields if f.name != partition_by]
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        for f in [*(schema[n] for n in names), schema[partition_by]]
    )
    note = "" if description is None else " COMMENT '{}'".format(description.replace("'", "\\'"))
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"PARTITIONED BY (`{partition_by}`){note} LOCATION '{path}'"
    )


def with_partition_day(df: DataFrame, source: str, name: str) -> DataFrame:
    """Add the day of a timestamp column as a partition column."""
    return df.withColumn(name, F.to_date(F.col(source)))


def append(
    df: DataFrame, path: str, partition_by: list[str], compression: str | None = None
) -> None:
    writer = _spread(df, partition_by).write.mode("append").partitionBy(*partition_by)
    writer.parquet(path, compression=compression)


def overwrite(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the whole table."""
    (
        _spread(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    (
        _spread(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_results(df: DataFrame, path: str, run_id: str) -> None:
    """Append one run's rows, laid out by run, unit and channel."""
    append(df.withColumn("run_id", F.lit(run_id)), path, ["run_id", "Unit", "Channel"])


def write_models(models: DataFrame, path: str, trained_at: dt.datetime | None = None) -> None:
    """Append fitted models; :func:`latest_models` reads the newest one per series.

    Appending keeps a retrained series readable while the new files are written.
    """
    stamp = F.current_timestamp() if trained_at is None else F.lit(trained_at)
    append(models.withColumn("trained_at", stamp.cast("timestamp")), path, ["Unit", "Channel"])


def latest_models(models: DataFrame) -> DataFrame:
    newest = Window.partitionBy("SKU_ID", "Channel", "Unit").orderBy(F.desc("trained_at"))
    return models.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def _spread(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Group rows by partition before the write: few files each, a hot partition split."""
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
