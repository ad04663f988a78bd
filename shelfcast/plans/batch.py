"""The whole forecasting run over all requested series, as one chain of frames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.durable import settle
from shelfcast.functions.dates import iso_day
from shelfcast.functions.numeric import to_log_scale
from shelfcast.operators import (
    evaluate,
    fitting,
    forecasting,
    grid,
    holidays,
    intervals,
    regressors,
    tuning,
    weekly,
)
from shelfcast.schemas import LAG, METRICS, PARAMETERS, SERIES
from shelfcast.sources.sales import daily_sales
from shelfcast.sources.weather import weekly_weather

RESULT_COLUMNS = [
    *SERIES,
    "Status",
    "min_date",
    "max_date",
    "validation_start",
    *METRICS,
    "best_params",
    "error_message",
]


@dataclass
class Run:
    """The frames a run produces."""

    weekly: DataFrame
    tuning: DataFrame
    models: DataFrame
    forecast: DataFrame
    comparison: DataFrame
    components: DataFrame
    results: DataFrame
    gate: DataFrame
    validation_days: int


def run_batch(
    sales: DataFrame,
    series: DataFrame,
    weather: DataFrame | None = None,
    weather_forecast: DataFrame | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    validation_days: int = weekly.VALIDATION_DAYS,
    param_grid: dict[str, list] | None = None,
    overrides: DataFrame | None = None,
    weather_grain: str = "day",
    holiday_match: str = "sunday",
    log_target: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    holiday_table: DataFrame | None = None,
    interval_paths: int = intervals.PATHS,
) -> Run:
    """Clean, aggregate, tune, fit, forecast and score every series of ``series``.

    The sales are scanned once.  Weekly cells, tuning results and models are written to the
    shared folder because several later steps read them.  Every requested series appears
    in the results, whatever became of it.

    ``log_target`` tunes and fits on log(1 + y) and reports on the scale of the data.
    ``prepare`` is applied to the training weeks, for instance outlier handling; accuracy is
    measured on untouched actuals.  ``holiday_table`` (``ds``) replaces the holiday rule.
    Forecast intervals come from ``interval_paths`` simulated paths; 0 takes the closed form.
    """
    cells = requested_cells(sales, series, weather, start_date, end_date, weather_grain)
    return run_cells(
        settle(cells, "cells"),
        series,
        weather_forecast=weather_forecast,
        validation_days=validation_days,
        param_grid=param_grid,
        overrides=overrides,
        weather_grain=weather_grain,
        holiday_match=holiday_match,
        log_target=log_target,
        prepare=prepare,
        holiday_table=holiday_table,
        interval_paths=interval_paths,
    )


def requested_cells(
    sales: DataFrame,
    series: DataFrame,
    weather: DataFrame | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    weather_grain: str = "day",
) -> DataFrame:
    """Weekly cells of the series in the list.

    The list meets cells, not lines.  Where it is small enough to be broadcast, the optimiser
    moves this join below the aggregate, to the scan.
    """
    daily = daily_sales(sales, None, start_date, end_date)
    cells = weekly.weekly_cells(daily, weather, weather_grain)
    return cells.join(series.select(*SERIES).distinct(), SERIES, "left_semi")


def run_cells(
    cells: DataFrame,
    series: DataFrame,
    weather_forecast: DataFrame | None = None,
    validation_days: int = weekly.VALIDATION_DAYS,
    param_grid: dict[str, list] | None = None,
    overrides: DataFrame | None = None,
    weather_grain: str = "day",
    holiday_match: str = "sunday",
    log_target: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    holiday_table: DataFrame | None = None,
    interval_paths: int = intervals.PATHS,
) -> Run:
    """The run from stored weekly cells on; arguments as in :func:`run_batch`."""
    gate = weekly.series_gate(cells, validation_days)
    passed = gate.where(F.col("status").isNull()).select(*SERIES)
    filled = weekly.fill_weeks(cells.join(passed, SERIES, "left_semi"))
    split = weekly.split_holdout(filled, validation_days)
    if prepare is not None:
        split = weekly.prepared_training(split, prepare)
    if holiday_table is not None:
        split = holidays.with_holiday_table(split, holiday_table, holiday_match)
    split = settle(split, "weekly")
    observed = split.where(F.col("train_weeks") >= weekly.MIN_TRAIN_WEEKS)
    ready = log_scale(observed) if log_target else observed
    train = ready.where("is_train")

    if param_grid is None:
        records = grid.profiled_grid(grid.series_profile(train))
    else:
        records = grid.given_grid(train.select(*SERIES).distinct(), param_grid)
    scored = settle(tuning.tune(train, records, grid.cv_schedule(train), holiday_match), "tuning")
    best = tuning.best_params(scored)
    chosen = best if overrides is None else tuning.with_overrides(best, overrides)
    target_scale = fitting.LOG if log_target else fitting.NATURAL
    models = settle(
        fitting.fit_models(ready, chosen, holiday_match, target_scale, weather_grain), "models"
    )

    by_week = None if weather_forecast is None else weekly_weather(weather_forecast)
    future = regressors.future_regressors(ready, by_week)
    if holiday_table is not None:
        future = holidays.with_holiday_table(future, holiday_table, holiday_match)
    forecast = forecasting.iterative_forecast(models, future, paths=interval_paths)
    components = forecasting.fitted_components(models, ready, future)
    if log_target:
        forecast = forecasting.natural_scale(forecast, evaluate.FORECAST_COLUMNS)
        components = forecasting.natural_components(components)
    comparison = evaluate.forecast_vs_actual(observed.where(~F.col("is_train")), forecast)
    results = result_table(series, gate, split, models, comparison, validation_days)
    return Run(
        split, scored, models, forecast, comparison, components, results, gate, validation_days
    )


def log_scale(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: to_log_scale(F.col(c)) for c in ("y", LAG)})


def retrain(
    split: DataFrame,
    subset: DataFrame,
    chosen: DataFrame,
    holiday_match: str = "sunday",
    target_scale: str = fitting.NATURAL,
    weather_grain: str = "day",
) -> DataFrame:
    """New models for a subset of the series; writing them supersedes the stored ones."""
    wanted = split.join(subset.select(*SERIES).distinct(), SERIES, "left_semi")
    return fitting.fit_models(wanted, chosen, holiday_match, target_scale, weather_grain)


def result_table(
    series: DataFrame,
    gate: DataFrame,
    split: DataFrame,
    models: DataFrame,
    comparison: DataFrame,
    validation_days: int = weekly.VALIDATION_DAYS,
) -> DataFrame:
    """One row per requested series: status, dates, metrics, parameters, message."""
    needed = validation_days + weekly.EXTRA_DAYS
    wanted = series.select(*SERIES).distinct()
    summary = weekly.split_summary(split).select(
        *SERIES, "validation_start", "train_weeks", F.col("status").alias("_split_status")
    )
    fitted = models.select(
        *SERIES,
        F.col("status").alias("_fit_status"),
        F.col("error_message").alias("_fit_error"),
        F.when(F.col("changepoint_prior_scale").isNotNull(), F.to_json(F.struct(*PARAMETERS))).alias(
            "best_params"
        ),
    )
    joined = (
        wanted.join(gate.select(*SERIES, "min_date", "max_date", "span_days", "status"), SERIES, "left")
        .join(summary, SERIES, "left")
        .join(fitted, SERIES, "left")
        .join(evaluate.rounded_metrics(evaluate.score(comparison)), SERIES, "left")
    )
    status = F.when(F.col("min_date").isNull(), F.lit(weekly.NO_DATA)).otherwise(
        F.coalesce(
            "status", "_split_status", "_fit_status", F.lit(weekly.FAILED)
        )
    )
    message = (
        F.when(
            status == weekly.NO_DATA,
            F.format_string("no data for SKU %s, channel %s, unit %s", "SKU_ID", "Channel", "Unit"),
        )
        .when(
            status == weekly.SHORT_DATA,
            F.format_string("%s days available, %s required", "span_days", F.lit(needed)),
        )
        .when(
            status == weekly.SHORT_TRAIN,
            F.format_string("%s training weeks after the split", "train_weeks"),
        )
        .when(
            status == weekly.FAILED,
            F.coalesce("_fit_error", F.lit("no week with sales of zero or more")),
        )
    )
    return joined.select(
        *SERIES,
        status.alias("Status"),
        *[iso_day(F.col(c)).alias(c) for c in ("min_date", "max_date", "validation_start")],
        *METRICS,
        "best_params",
        message.alias("error_message"),
    )
