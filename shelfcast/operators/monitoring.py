"""Watching stored forecasts: metrics over time, issues, alerts and success criteria."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.metrics import accuracy, wape
from shelfcast.schemas import METRICS, SERIES

# Limits of the score issues, the alert and the success criteria.
BIAS_SHARE = 0.2
EXTREME_STDS = 3
WORSE_BY = 1.5
ALERT_WAPE = 0.7
ALERT_WEEKS = 2
GOAL_MEAN_WAPE = 0.7
GOAL_MEAN_SMAPE = 0.5
GOOD_WAPE = 0.85
GOOD_SHARE = 0.75
WORST_WAPE = 1.0


def forecasts_beside_actuals(forecasts: DataFrame, weekly: DataFrame) -> DataFrame:
    """Stored forecasts and actuals of the same series and target week."""
    actual = weekly.select(*SERIES, F.col("ds").alias("target_date"), "y")
    return forecasts.select(
        *SERIES, "forecast_date", "target_date", F.col("predicted_quantity").alias("yhat")
    ).join(actual, [*SERIES, "target_date"])


def metrics_long(
    matched: DataFrame, calculation_date: str | dt.date, lookback_weeks: int = 4
) -> DataFrame:
    """One row per series and metric over the last weeks, as the metrics table stores them."""
    day = F.lit(str(calculation_date)).cast("date")
    recent = matched.where(
        (F.col("target_date") > F.date_sub(day, 7 * lookback_weeks)) & (F.col("target_date") <= day)
    )
    scored = recent.groupBy(*SERIES).agg(*accuracy())
    long = scored.unpivot(SERIES, METRICS, "metric_name", "metric_value")
    return long.select(
        *SERIES,
        day.alias("calculation_date"),
        F.lit(f"last_{lookback_weeks}_weeks").alias("period"),
        "metric_name",
        "metric_value",
    )


def weekly_scores(matched: DataFrame) -> DataFrame:
    """The four metrics per series and target week."""
    return matched.groupBy(*SERIES, "target_date").agg(*accuracy())


def metric_trend(matched: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean metrics over all series per week, optionally by unit, channel or SKU."""
    scored = weekly_scores(matched)
    finite = [F.avg(F.when(F.col(m) < float("inf"), F.col(m))).alias(m) for m in METRICS]
    return scored.groupBy(*(by or []), "target_date").agg(
        *finite, F.count(F.lit(1)).alias("series")
    )


def worst_models(scores: DataFrame, count: int = 10) -> DataFrame:
    """The series with the highest WAPE, then sMAPE."""
    return scores.orderBy(F.desc("WAPE"), F.desc("sMAPE"), *SERIES).limit(count)


def alerts(scores: DataFrame, limit: float = ALERT_WAPE, weeks: int = ALERT_WEEKS) -> DataFrame:
    """Weeks that end a run of ``weeks`` consecutive ones with WAPE above ``limit``."""
    order = Window.partitionBy(*SERIES).orderBy("target_date")
    run = order.rowsBetween(-(weeks - 1), 0)
    high = F.sum((F.col("WAPE") > limit).cast("int")).over(run) == weeks
    adjacent = F.lag("target_date", weeks - 1).over(order) == F.date_sub(
        "target_date", 7 * (weeks - 1)
    )
    marked = scores.select(*SERIES, "target_date", "WAPE", (high & adjacent).alias("_alert"))
    return marked.where("_alert").drop("_alert")


def score_issues(comparison: DataFrame) -> DataFrame:
    """The four metrics per series and a list of issues.

    Bias: mean error above a fifth of the mean actual.  Extreme: errors beyond three standard
    deviations.  Deterioration: WAPE of the later half above 1.5 times the earlier half's.
    """
    order = Window.partitionBy(*SERIES).orderBy("ds")
    whole = Window.partitionBy(*SERIES)
    error = F.col("yhat") - F.col("y")
    rows = comparison.withColumns(
        {
            "_error": error,
            "_std": F.stddev_pop(error).over(whole),
            "_n": F.count(F.lit(1)).over(whole),
            "_i": F.row_number().over(order),
        }
    ).withColumn("_early", F.col("_i") <= F.floor(F.col("_n") / 2))

    def half(is_early: Column) -> Column:
        y = F.when(is_early, F.col("y"))
        base = F.sum(F.abs(y))
        return F.when(base != 0, F.sum(F.abs(F.when(is_early, F.col("_error")))) / base)

    scored = rows.groupBy(*SERIES).agg(
        *accuracy(),
        F.avg("_error").alias("mean_error"),
        F.avg("y").alias("_mean"),
        F.sum((F.abs("_error") > EXTREME_STDS * F.col("_std")).cast("bigint")).alias(
            "extreme_errors"
        ),
        F.count(F.lit(1)).alias("_n"),
        half(F.col("_early")).alias("first_half_wape"),
        half(~F.col("_early")).alias("second_half_wape"),
    )
    worse = F.col("second_half_wape") > WORSE_BY * F.col("first_half_wape")
    issues = F.filter(
        F.array(
            F.when(F.abs("mean_error") > BIAS_SHARE * F.col("_mean"), F.lit("bias")),
            F.when(F.col("extreme_errors") > 0, F.lit("extreme_errors")),
            F.when((F.col("_n") >= 4) & worse, F.lit("deterioration")),
        ),
        lambda i: i.isNotNull(),
    )
    return scored.withColumn("issues", F.concat_ws(",", issues)).drop("_mean", "_n")


def success_criteria(scores: DataFrame) -> DataFrame:
    """One row: the goals and whether the scores meet them."""
    good = F.avg((F.col("WAPE") < GOOD_WAPE).cast("double"))
    return scores.agg(
        F.avg("WAPE").alias("mean_wape"),
        F.avg("sMAPE").alias("mean_smape"),
        good.alias("share_good"),
        F.max("WAPE").alias("max_wape"),
    ).select(
        "*",
        (F.col("mean_wape") < GOAL_MEAN_WAPE).alias("wape_met"),
        (F.col("mean_smape") < GOAL_MEAN_SMAPE).alias("smape_met"),
        (F.col("share_good") >= GOOD_SHARE).alias("share_met"),
        (F.col("max_wape") <= WORST_WAPE).alias("no_extreme"),
    )


def ensemble(forecasts: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Mean of several forecasts (``member``) per series and week, weighted if weights are given.

    ``weights`` has ``member`` and ``weight`` per series, for instance one over the
    cross-validation error.
    """
    if weights is None:
        rows = forecasts.withColumn("weight", F.lit(1.0))
    else:
        rows = forecasts.join(weights.select(*SERIES, "member", "weight"), [*SERIES, "member"])
    return rows.groupBy(*SERIES, "ds").agg(
        F.try_divide(F.sum(F.col("weight") * F.col("yhat")), F.sum("weight")).alias("yhat"),
        F.count(F.lit(1)).alias("members"),
    )


def rolling_origin(held_out: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean and spread of the metrics over several validation periods (``fold``).

    WAPE of a fold without sales is infinite and left out.
    """
    keys = by or SERIES
    y, yhat = F.col("y"), F.col("yhat")
    folds = held_out.groupBy(*keys, "fold").agg(
        *accuracy()[:3], wape(y, yhat).alias("WAPE")
    )

    def finite(m: str) -> Column:
        return F.when(F.col(m) < float("inf"), F.col(m))

    return folds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("folds"),
        *[F.avg(finite(m)).alias(f"mean_{m}") for m in METRICS],
        *[F.stddev_samp(finite(m)).alias(f"std_{m}") for m in METRICS],
    )
