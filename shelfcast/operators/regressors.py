"""Regressor values of the weeks to forecast.

Promotions come from the holdout where it has them, weather from the weekly forecast, and
everything else from the training means.  Without a holdout the promotion is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.holidays import GIVEN
from shelfcast.schemas import LAG, PROMO, SERIES, WEATHER

HORIZON_WEEKS = 4

#: Promotion assumed for a series without holdout.
ASSUMED_PROMO = {"Promo_discount_perc": 5.0, "is_promo": 1.0}


def future_weeks(split: DataFrame, horizon: int = HORIZON_WEEKS) -> DataFrame:
    """The Sundays after the training end of each series."""
    ends = split.groupBy(*SERIES).agg(F.first("train_end").alias("train_end"))
    return ends.select(
        *SERIES, "train_end", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).select(*SERIES, "step", F.expr("date_add(train_end, 7 * step)").alias("ds"))


def training_means(split: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean of each regressor over the training weeks."""
    names = columns or [c for c in [*PROMO, *WEATHER] if c in split.columns]
    return (
        split.where("is_train").groupBy(*SERIES).agg(*[F.avg(c).alias(c) for c in names])
    )


def future_regressors(
    split: DataFrame, weather_forecast: DataFrame | None = None, horizon: int = HORIZON_WEEKS
) -> DataFrame:
    """One row per series and future week with promotion and weather.

    ``weather_forecast`` is weekly (see ``weekly_weather``).  A regressor without forecast and
    training mean is 0.
    """
    weather = [c for c in WEATHER if c in split.columns]
    train = F.col("is_train")
    per_series = split.groupBy(*SERIES).agg(
        F.first("train_end").alias("train_end"),
        F.count(F.when(~train, F.lit(1))).alias("_held"),
        *[F.avg(F.when(train, F.col(c))).alias(f"_mean_{c}") for c in [*PROMO, *weather]],
        # The holdout is a few weeks long: its promotions ride along as an array.
        F.collect_list(
            F.when(
                ~train & (F.col("ds") <= F.date_add("train_end", 7 * horizon)),
                F.struct("ds", *PROMO),
            )
        ).alias("_promo"),
    )
    steps = per_series.where(F.col("train_end").isNotNull()).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).withColumn("ds", F.expr("date_add(train_end, 7 * step)"))
    known = F.element_at(F.filter("_promo", lambda p: p["ds"] == F.col("ds")), 1)

    def promo(name: str) -> Column:
        found = F.when(F.size(F.filter("_promo", lambda p: p["ds"] == F.col("ds"))) > 0, known[name])
        mean = F.coalesce(found, F.col(f"_mean_{name}"))
        return F.when(F.col("_held") > 0, mean).otherwise(F.lit(ASSUMED_PROMO[name]))

    out = steps.select(
        *SERIES, "step", "ds", *[promo(c).alias(c) for c in PROMO],
        *[F.col(f"_mean_{c}") for c in weather],
    )
    forecast_names: list[str] = []
    if weather_forecast is not None:
        forecast_names = [c for c in weather if c in weather_forecast.columns]
        renamed = weather_forecast.select(
            "ds", *[F.col(c).alias(f"_fc_{c}") for c in forecast_names]
        )
        out = out.join(renamed, "ds", "left")

    def filled(name: str) -> Column:
        options = [F.col(f"_fc_{name}")] if name in forecast_names else []
        return F.coalesce(*options, F.col(f"_mean_{name}"), F.lit(0.0)).alias(name)

    return out.select(*SERIES, "step", "ds", *PROMO, *[filled(c) for c in weather])


def scaffold(split: DataFrame, future: DataFrame) -> DataFrame:
    """Training weeks and the weeks after them in one frame.

    A future value wins over a historical one for the same week; what is still missing is
    carried forward, then backward, then 0.
    """
    names = [c for c in [*PROMO, *WEATHER, GIVEN] if c in split.columns]
    history = split.where("is_train").select(*SERIES, "ds", "y", *names, LAG)
    weeks = history.select(*SERIES, "ds", F.lit(0).alias("step")).unionByName(
        future.select(*SERIES, "ds", "step")
    )
    ahead = future.select(*SERIES, "ds", *[F.col(c).alias(f"_future_{c}") for c in names])
    joined = weeks.join(history, [*SERIES, "ds"], "left").join(ahead, [*SERIES, "ds"], "left")
    combined = joined.select(
        *SERIES,
        "ds",
        "step",
        "y",
        *[F.coalesce(F.col(f"_future_{c}"), F.col(c)).alias(c) for c in names],
        LAG,
    )
    return fill_forward_backward(combined, [*names, LAG])


def fill_forward_backward(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill gaps with the last earlier value, else the next later one, else 0."""
    order = Window.partitionBy(*SERIES).orderBy("ds")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(before),
            F.first(c, ignorenulls=True).over(after),
            F.lit(0.0),
        )
        for c in columns
    }
    return df.withColumns(filled)
