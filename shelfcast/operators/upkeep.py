"""Weekly cells kept up beside a published sales table.

The cells are a published table by week, and each of its states notes the state of the sales
that it was made from.  Bringing them up to date compares two lists of partitions: the days that
changed name their weeks, only the days of those weeks are read, and their cells are made anew
and published at once.  Sums are never corrected by differences, so the cells equal a full build
in every bit, and a job that dies between the two tables is caught up by the next one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import weekly
from shelfcast.sources import published
from shelfcast.sources.sales import daily_sales
from shelfcast.sources.weather import weekly_weather


def closing_day(day: dt.date) -> dt.date:
    return day + dt.timedelta(days=6 - day.weekday())


def restated_weeks(days: list[str]) -> list[dt.date]:
    """Closing Sundays of partitions ``date=...``; rows without a date belong to no week."""
    values = (d.split("=", 1)[1] for d in days)
    dated = (dt.date.fromisoformat(v) for v in values if v != "__HIVE_DEFAULT_PARTITION__")
    return sorted({closing_day(d) for d in dated})


def days_of(sales: DataFrame, weeks: list[dt.date]) -> DataFrame:
    """The lines of whole weeks, chosen by partition."""
    return sales.where(F.col("date").isin([w - dt.timedelta(days=n) for w in weeks for n in range(7)]))


def refresh_cells(
    spark: SparkSession, sales_path: str, sales_schema: T.StructType, cells_path: str
) -> list[dt.date]:
    """Bring the cells up to the newest state of the sales; the weeks that were made anew.

    Both tables are published ones (see :mod:`shelfcast.sources.published`), the sales by
    ``date``, the cells by ``week``.  A week without lines any more loses its partition.
    """
    cells = published.state(spark, cells_path)
    source = published.state(spark, sales_path)
    done = published.state(spark, sales_path, int(cells.note)) if cells.note else published.State()
    weeks = restated_weeks(published.changed(done, source))
    if done.number == source.number:
        return []
    sales = published.read(spark, sales_path, sales_schema, source.number)
    fresh = weekly.weekly_cells(daily_sales(days_of(sales, weeks)))
    published.publish(
        fresh, cells_path, ["week"], cells.number, [f"week={w}" for w in weeks],
        note=str(source.number),
    )
    return weeks


def stored_cells(
    spark: SparkSession, cells_path: str, cells_schema: T.StructType, weather: DataFrame | None = None
) -> DataFrame:
    """The cells, with the weather of their weeks; restated weather needs no refresh."""
    cells = published.read(spark, cells_path, cells_schema)
    if weather is None:
        return cells
    by_week = weekly_weather(weather).withColumnRenamed("ds", "week")  # a row per calendar week
    return cells.join(F.broadcast(by_week), "week", "left")
