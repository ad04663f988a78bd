"""Daily weather from JSON payloads that hold one array per variable."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.dates import as_of_day, closing_sunday, parse_day
from shelfcast.schemas import PRECIPITATION, TEMPERATURES, WEATHER, WEATHER_PAYLOAD

#: Fixed value: the forecast service looks this many days ahead at most.
FORECAST_DAYS_LIMIT = 16


def read_weather_history(spark: SparkSession, path: str) -> DataFrame:
    """Weather history; only the variables present in the payload become columns."""
    return unpack_payload(spark.read.option("multiLine", True).json(path))


def read_weather_forecast(
    spark: SparkSession,
    path: str,
    as_of: str | dt.date | Column | None = None,
    forecast_days: int = FORECAST_DAYS_LIMIT,
) -> DataFrame:
    """Weather forecast with all four variables, at most 16 days from ``as_of`` on."""
    raw = spark.read.schema(WEATHER_PAYLOAD).option("multiLine", True).json(path)
    return limit_forecast(complete_variables(unpack_payload(raw)), as_of, forecast_days)


def unpack_payload(raw: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per day from ``daily``, a struct of parallel arrays."""
    carry = carry or []
    if "daily" not in raw.columns:
        empty = [F.lit(None).cast("double").alias(c) for c in WEATHER]
        return raw.select(*carry, F.lit(None).cast("date").alias("ds"), *empty).where(F.lit(False))
    present = raw.schema["daily"].dataType.names
    variables = [v for v in WEATHER if v in present]
    zipped = F.arrays_zip(*[F.col(f"daily.{v}").alias(v) for v in ["time", *variables]])
    day = raw.select(*carry, F.explode(zipped).alias("day"))
    return day.select(
        *carry,
        parse_day(F.col("day.time")).alias("ds"),
        *[F.col(f"day.{v}").cast("double").alias(v) for v in variables],
    )


def complete_variables(weather: DataFrame) -> DataFrame:
    """All four variables in fixed order; one the payload lacks is 0."""
    have = set(weather.columns)
    return weather.select(
        "ds", *[F.col(v) if v in have else F.lit(0.0).alias(v) for v in WEATHER]
    )


def limit_forecast(
    weather: DataFrame, as_of: str | dt.date | Column | None, forecast_days: int
) -> DataFrame:
    days = min(forecast_days, FORECAST_DAYS_LIMIT)
    first = as_of_day(as_of)
    return weather.where(F.col("ds").between(first, F.date_add(first, days - 1)))


def weekly_weather(weather: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean temperatures and total precipitation per week, for the variables present."""
    by = by or []
    week = closing_sunday(F.col("ds"))
    means = [F.avg(v).alias(v) for v in TEMPERATURES if v in weather.columns]
    sums = [F.sum(v).alias(v) for v in PRECIPITATION if v in weather.columns]
    weekly = weather.groupBy(*by, week.alias("week")).agg(*means, *sums)
    return weekly.withColumnRenamed("week", "ds")
