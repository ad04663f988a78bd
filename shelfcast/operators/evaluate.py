"""Forecasts against actuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import week_series
from shelfcast.functions.metrics import accuracy
from shelfcast.functions.numeric import is_finite
from shelfcast.schemas import METRICS, SERIES

FORECAST_COLUMNS = ["yhat", "yhat_lower", "yhat_upper"]


def forecast_vs_actual(
    actuals: DataFrame, forecasts: DataFrame, by: list[str] | None = None
) -> DataFrame:
    """Weeks that have both an actual and a forecast: the table behind the validation plot."""
    on = [*(by or SERIES), "ds"]
    values = [c for c in FORECAST_COLUMNS if c in forecasts.columns]
    return actuals.select(*on, "y").join(forecasts.select(*on, *values), on)


def score(comparison: DataFrame, by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE, sMAPE and WAPE per series."""
    return comparison.groupBy(*(by or SERIES)).agg(*accuracy())


def rounded_metrics(scores: DataFrame, places: int = 4) -> DataFrame:
    """Metrics as written to the result table; a missing one stays missing."""
    return scores.withColumns({m: F.round(m, places) for m in METRICS})


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("Status").count().orderBy(F.desc("count"), "Status")


def mean_metrics(results: DataFrame) -> DataFrame:
    """Mean of each metric over the series that succeeded, missing values left out."""
    done = results.where(F.col("Status") == "Success")
    return done.agg(*[F.avg(m).alias(m) for m in METRICS], F.count(F.lit(1)).alias("series"))


def finite_rows(df: DataFrame, metric: str) -> DataFrame:
    return df.where(is_finite(F.col(metric)))


def naive_forecast(split: DataFrame) -> DataFrame:
    """The holdout forecast by the week before."""
    held = split.where(~F.col("is_train"))
    lag: Column = F.col("y_lag1")
    return held.select(*SERIES, "ds", lag.alias("yhat"))


def naive_by_fold(weekly: DataFrame, folds: DataFrame) -> DataFrame:
    """The test weeks of every fold, forecast by the week before."""
    weeks = folds.select(
        *SERIES,
        "fold",
        F.explode(week_series(F.date_add("cutoff", 7), F.col("test_end"))).alias("ds"),
    )
    rows = weekly.select(*SERIES, "ds", "y", F.col("y_lag1").alias("yhat"))
    return weeks.join(rows, [*SERIES, "ds"])


def validation_plot_rows(comparison: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per point of the validation plot: actual, forecast and band in long form."""
    keys = [*(by or SERIES), "ds"]
    lines = ["y", *[c for c in FORECAST_COLUMNS if c in comparison.columns]]
    return comparison.select(*keys, *lines).unpivot(keys, lines, "line", "value")
