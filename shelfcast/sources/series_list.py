"""The list of series to forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.text import match_headers, strip
from shelfcast.schemas import SERIES, SERIES_LIST


def read_series_list(spark: SparkSession, path: str) -> DataFrame:
    """Series list from CSV with a header row; an empty file gives an empty list."""
    raw = (
        spark.read.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    if not raw.columns:
        return spark.createDataFrame([], SERIES_LIST)
    return normalise_series_list(raw)


def normalise_series_list(raw: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Match headers without regard to case or blanks, cast to text and strip values.

    Raises when a required column is missing.  ``carry`` names extra columns to keep, such as
    the ordinal that :func:`choose_series` needs for the order of the list.
    """
    headers = match_headers(raw.columns, SERIES)
    keys = [strip(F.col(f"`{headers[k]}`").cast(T.StringType())).alias(k) for k in SERIES]
    return raw.select(*keys, *(carry or []))


def choose_series(
    series: DataFrame,
    sku: str | None = None,
    unit: str | None = None,
    channel: str | None = None,
    max_series: int | None = None,
    list_order: list[str] | None = None,
) -> DataFrame:
    """Filter the list; a filter that is empty or None does nothing.

    ``max_series`` keeps the first entries in list order, given by the ``list_order`` columns.
    """
    for name, value in (("SKU_ID", sku), ("Unit", unit), ("Channel", channel)):
        if value:
            series = series.where(F.col(name) == value)
    if max_series and max_series > 0:
        if not list_order:
            raise ValueError("the first entries of a list need the columns that order it")
        series = series.orderBy(*list_order).limit(max_series)
    return series
