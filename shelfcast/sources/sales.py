"""Daily sales of all forecast series in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import parse_day
from shelfcast.functions.text import number_or_zero
from shelfcast.schemas import SERIES


def daily_sales(
    sales: DataFrame,
    series: DataFrame | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """Sales lines as ``SKU_ID, Channel, Unit, ds, y, Promo_discount_perc, is_promo``.

    ``series`` keeps only the listed series.  A bound that is no date selects nothing, so
    the result is empty but keeps its columns.  Date and column choices reach the scan.
    """
    lines = sales
    if start_date:
        lines = lines.where(F.col("date") >= parse_day(F.lit(start_date)))
    if end_date:
        lines = lines.where(F.col("date") <= parse_day(F.lit(end_date)))
    promo = F.col("Promo_discount_perc")
    out = lines.select(
        F.col("SKU_ID"),
        F.col("channel").alias("Channel"),
        F.col("unit").alias("Unit"),
        F.col("date").alias("ds"),
        F.col("quantity").cast("double").alias("y"),
        number_or_zero(promo).alias("Promo_discount_perc"),
        F.when(promo.try_cast("double") > 0, 1).otherwise(0).alias("is_promo"),
    )
    if series is not None:
        wanted = series.select(*SERIES).distinct()
        out = out.join(wanted, SERIES, "left_semi")
    return out


def without_returns(daily: DataFrame) -> DataFrame:
    """Drop rows with negative or missing quantity; zero stays."""
    return daily.where(F.col("y") >= 0)


def returns_removed(daily: DataFrame) -> DataFrame:
    """Rows dropped by :func:`without_returns`, per series."""
    kept = F.coalesce(F.col("y") >= 0, F.lit(False))
    return daily.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.sum(F.when(kept, 0).otherwise(1)).cast("bigint").alias("rows_removed"),
    )
