"""Forecasts from stored model rows, entirely in JVM expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.durable import spread
from shelfcast.functions.numeric import at_least_zero, from_log_scale, to_log_scale
from shelfcast.operators.design import (
    HOLIDAY_AT,
    REGRESSORS_AT,
    given_or_rule,
    holiday_term,
    regressor_effect,
    trend_at,
    yearly_effect,
)
from shelfcast.operators.fitting import LOG
from shelfcast.operators.intervals import LEVEL, deviations, quantile, with_trend_paths
from shelfcast.operators.regressors import HORIZON_WEEKS, future_regressors, scaffold
from shelfcast.operators.weekly import SUCCESS, split_holdout
from shelfcast.schemas import LAG, PROMO, SERIES, WEATHER

#: Fixed value: half width of an 80 % interval in standard deviations.
INTERVAL_Z = 1.2815515594457742


def combine(level: Column, effect: Column) -> Column:
    multiplicative = F.col("seasonality_mode") == "multiplicative"
    return F.when(multiplicative, level * (F.lit(1.0) + effect)).otherwise(level + effect)


def interval_width(effect: Column) -> Column:
    """Half width of the interval: noise, plus the trend changes expected after the history.

    Changes keep coming at the rate and mean size of the fitted ones; the variance of their
    joint effect at scaled time t > 1 has a closed form.
    """
    count = F.size("deltas")
    size = F.aggregate("deltas", F.lit(0.0), lambda a, d: a + F.abs(d)) / F.greatest(
        count, F.lit(1)
    )
    ahead = at_least_zero(F.col("t") - 1.0)
    wander = count * 2.0 * size * size * ahead * ahead * ahead / 3.0
    lift = F.when(F.col("seasonality_mode") == "multiplicative", F.lit(1.0) + effect).otherwise(1.0)
    return F.sqrt(F.col("sigma") * F.col("sigma") + wander * lift * lift) * INTERVAL_Z


def _values(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Weekly rows beside the model of their series, with scaled time."""
    good = models.where(F.col("status") == SUCCESS)
    extra = [c for c in good.columns if c not in rows.columns or c in SERIES]
    return rows.join(good.select(*extra), SERIES).withColumn(
        "t", F.datediff("ds", "t0") / F.col("t_span")
    )


def _known_parts(rows: DataFrame, names: list[str]) -> DataFrame:
    """Trend and effects that do not depend on the lag; the holiday rule is the model's."""
    by_week = F.col("holiday_match") == "week"
    given = F.when(by_week, given_or_rule(rows, "week")).otherwise(given_or_rule(rows, "sunday"))
    flag = holiday_term(F.col("ds"), F.col("last_week"), given)
    return rows.withColumns(
        {
            "_level": trend_at(F.col("t")),
            "_yearly": yearly_effect(),
            "_holidays": F.col("beta")[HOLIDAY_AT] * flag,
            "_regressors": regressor_effect(names),
        }
    )


def iterative_forecast(
    models: DataFrame, future: DataFrame, clip: bool = True, paths: int = 0
) -> DataFrame:
    """Forecast week by week: each week's forecast, floored at 0, is the next week's lag.

    The weeks of a series (``future`` has a handful) are folded in order by one expression;
    the first lag is the last training value.  ``clip`` floors the results at 0.

    The interval has a closed form; with ``paths`` it lies between quantiles of as many
    simulated paths, which need not be symmetric.
    """
    names = [c for c in [*PROMO, *WEATHER] if c in future.columns]
    at_lag = REGRESSORS_AT + len(names)
    rows = _known_parts(_values(future, models), names)
    known = F.col("_yearly") + F.col("_holidays") + F.col("_regressors")
    step = F.struct(
        "ds",
        "t",
        F.col("_level").alias("level"),
        known.alias("known"),
        (F.col("beta")[at_lag] / F.col("scales")[len(names)]).alias("per_unit"),
        F.col("centers")[len(names)].alias("center"),
        F.col("y_scale").alias("scale"),
        F.col("sigma").alias("sigma"),
        F.col("seasonality_mode").alias("seasonality_mode"),
    )
    model_columns = ["last_y", "deltas"]
    if paths:
        # Few bytes, but a tenth of a second each: the aggregate keeps this partitioning.
        rows = spread(rows, SERIES)
    per_series = rows.groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(step)).alias("steps"),
        *[F.first(c).alias(c) for c in model_columns],
    )
    empty = F.array().cast("array<struct<yhat:double,effect:double>>")

    def advance(state: Column, s: Column) -> Column:
        effect = s["known"] + s["per_unit"] * (state["lag"] - s["center"])
        multiplicative = s["seasonality_mode"] == "multiplicative"
        raw = F.when(multiplicative, s["level"] * (effect + 1.0)).otherwise(s["level"] + effect)
        yhat = raw * s["scale"]
        result = F.struct(yhat.alias("yhat"), effect.alias("effect"))
        return F.struct(
            F.greatest(yhat, F.lit(0.0)).alias("lag"),
            F.concat(state["out"], F.array(result)).alias("out"),
        )

    start = F.struct(F.col("last_y").alias("lag"), empty.alias("out"))
    carried = ["deltas", "_paths"] if paths else ["deltas"]
    if paths:
        last_t = F.array_max(F.transform("steps", lambda s: s["t"]))
        per_series = with_trend_paths(per_series, last_t, "_paths", paths)
    folded = per_series.withColumn(
        "out", F.aggregate("steps", start, advance, lambda state: state["out"])
    )
    each = folded.select(
        *SERIES, *carried, F.explode(F.arrays_zip("steps", "out")).alias("e")
    ).select(
        *SERIES,
        *carried,
        *[F.col(f"e.steps.{c}").alias(c) for c in ("ds", "t", "scale", "sigma", "seasonality_mode")],
        "e.out.yhat",
        "e.out.effect",
    )
    if paths:
        multiplicative = F.col("seasonality_mode") == "multiplicative"
        lift = F.when(multiplicative, F.col("effect") + 1.0).otherwise(1.0)
        each = each.withColumn("_off", deviations("_paths", lift))
        below, above = (
            F.col("scale") * quantile(F.col("_off"), share, paths)
            for share in ((1 - LEVEL) / 2, (1 + LEVEL) / 2)
        )
    else:
        above = F.col("scale") * interval_width(F.col("effect"))
        below = -above
    out = {"yhat": F.col("yhat"), "yhat_lower": F.col("yhat") + below, "yhat_upper": F.col("yhat") + above}
    return each.select(
        *SERIES, "ds", *[(at_least_zero(c) if clip else c).alias(n) for n, c in out.items()]
    )


def predict(models: DataFrame, rows: DataFrame) -> DataFrame:
    """Forecast and components of weeks whose lag is known, on the scale of the rows."""
    names = [c for c in [*PROMO, *WEATHER, LAG] if c in rows.columns]
    parts = _known_parts(_values(rows, models), names)
    effect = F.col("_yearly") + F.col("_holidays") + F.col("_regressors")
    scale = F.col("y_scale")
    additive = F.col("seasonality_mode") != "multiplicative"

    def component(name: str) -> Column:
        return F.when(additive, F.col(name) * scale).otherwise(F.col(name))

    yhat = combine(F.col("_level"), effect) * scale
    half = scale * interval_width(effect)
    return parts.select(
        *SERIES,
        "ds",
        *[c for c in ("y", "step") if c in rows.columns],
        (F.col("_level") * scale).alias("trend"),
        component("_yearly").alias("yearly"),
        component("_holidays").alias("holidays"),
        component("_regressors").alias("extra_regressors"),
        yhat.alias("yhat"),
        (yhat - half).alias("yhat_lower"),
        (yhat + half).alias("yhat_upper"),
        "seasonality_mode",
    )


def fitted_components(
    models: DataFrame, split: DataFrame, future: DataFrame
) -> DataFrame:
    """History and forecast with components: the table behind the component plots.

    Past weeks use their own lag; future weeks the forecast of the week before.
    """
    ahead = iterative_forecast(models, future, clip=False)
    order = Window.partitionBy(*SERIES).orderBy("ds")
    first_lag = models.select(*SERIES, "last_y")
    lags = (
        ahead.select(*SERIES, "ds", F.lag(at_least_zero(F.col("yhat"))).over(order).alias("_lag"))
        .join(first_lag, SERIES)
        .select(*SERIES, "ds", F.coalesce("_lag", "last_y").alias("_lag"))
    )
    rows = scaffold(split, future).join(lags, [*SERIES, "ds"], "left")
    rows = rows.withColumn(LAG, F.coalesce("_lag", LAG)).drop("_lag")
    return predict(models, rows)


def natural_scale(forecast: DataFrame, columns: list[str]) -> DataFrame:
    """Forecasts of models of log(1 + y) as quantities, floored at 0."""
    return forecast.withColumns({c: at_least_zero(from_log_scale(F.col(c))) for c in columns})


def natural_components(components: DataFrame) -> DataFrame:
    """Components of models of log(1 + y) on the scale of the data.

    The trend is a quantity; a component is what it alone adds to the trend of its week.  On
    this scale they do not add up to the forecast: on the other one they are factors.
    """
    trend = F.col("trend")
    additive = F.col("seasonality_mode") != "multiplicative"

    def alone(name: str) -> Column:
        part = F.when(additive, F.col(name)).otherwise(F.col(name) * trend)
        return from_log_scale(trend + part) - from_log_scale(trend)

    values = [c for c in ("y", "yhat", "yhat_lower", "yhat_upper") if c in components.columns]
    return components.withColumns(
        {c: alone(c) for c in ("yearly", "holidays", "extra_regressors")}
        | {c: from_log_scale(F.col(c)) for c in ["trend", *values]}
    )


def weekly_job(
    models: DataFrame,
    weekly: DataFrame,
    forecast_date: str | dt.date,
    weather_forecast: DataFrame | None = None,
    horizon: int = HORIZON_WEEKS,
    weather_grain: str = "day",
) -> DataFrame:
    """Forecast table of stored models, starting from the latest actuals of each series.

    A model brings its own target scale and holiday rule.  ``weather_grain`` says how the given
    rows were made; a model fitted to rows of another grain is an error.
    """
    split = split_holdout(weekly, validation_days=0)
    future = future_regressors(split, weather_forecast, horizon)
    latest = split.groupBy(*SERIES).agg(
        F.max_by("y", "ds").alias("_last_y"), F.max("ds").alias("last_week")
    )
    is_log = F.col("target_scale") == LOG
    start = F.when(is_log, to_log_scale(F.col("_last_y"))).otherwise(F.col("_last_y"))
    wrong = F.raise_error(F.lit(f"a model was fitted to rows whose weather grain is not {weather_grain}"))
    current = (
        models.drop("last_y", "last_week")
        .join(latest, SERIES)
        .withColumn("last_y", F.when(F.col("weather_grain") != weather_grain, wrong).otherwise(start))
    )
    ahead = iterative_forecast(current, future).join(models.select(*SERIES, "target_scale"), SERIES)
    quantity = F.when(is_log, at_least_zero(from_log_scale(F.col("yhat")))).otherwise(F.col("yhat"))
    return ahead.select(
        *SERIES,
        F.lit(str(forecast_date)).cast("date").alias("forecast_date"),
        F.col("ds").alias("target_date"),
        quantity.alias("predicted_quantity"),
    )
