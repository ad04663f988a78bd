"""Simulated intervals: coverage, sameness, limiting cases."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import forecasting, intervals
from shelfcast.operators.design import REGRESSORS_AT
from shelfcast.schemas import SERIES

LAST = dt.date(2024, 6, 30)
WEEKS = 40


def models(spark, count, deltas, sigma, mode="additive", level=10.0, wave=0.0):
    """Rows of models with a level, the same changes and one yearly term."""
    beta = [0.0] * (REGRESSORS_AT + 1)
    beta[1] = wave
    rows = [
        (f"s{i}", "TF", "U", LAST - dt.timedelta(weeks=WEEKS), float(7 * WEEKS), 1.0, LAST, 5.0, level, 0.0,
         [0.1] * len(deltas), deltas, beta, [0.0], [1.0], sigma, mode, "Success", "sunday", "natural", "day")
        for i in range(count)
    ]
    return spark.createDataFrame(
        rows,
        "SKU_ID string, Channel string, Unit string, t0 date, t_span double, y_scale double, last_week date, "
        "last_y double, offset double, slope double, knots array<double>, deltas array<double>, "
        "beta array<double>, centers array<double>, scales array<double>, sigma double, "
        "seasonality_mode string, status string, holiday_match string, target_scale string, weather_grain string",
    )


def weeks_ahead(rows, horizon):
    weeks = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return rows.select(*SERIES, weeks.alias("step")).select(
        *SERIES, "step", F.expr(f"date_add(date'{LAST}', cast(step * 7 as int))").alias("ds")
    )


def forecast(rows, horizon=4, paths=200):
    got = forecasting.iterative_forecast(rows, weeks_ahead(rows, horizon), clip=False, paths=paths)
    return got.orderBy("SKU_ID", "ds").collect()


def test_coverage_of_simulated_series(spark):
    """Futures drawn by another generator fall between the bounds in 80 % of the weeks."""
    deltas, sigma, horizon, count = [2.0, -4.0, 3.0, -1.0, 2.0], 0.2, 8, 1500
    got = forecast(models(spark, count, deltas, sigma), horizon)
    rng = np.random.default_rng(5)
    size, ahead = np.mean(np.abs(deltas)), horizon / WEEKS
    inside = np.zeros((count, horizon), bool)
    for s in range(count):
        n = rng.poisson(len(deltas) * ahead)
        at, by = rng.uniform(0, ahead, n), rng.laplace(0, size, n)
        for k in range(horizon):
            r = got[s * horizon + k]
            bend = (by * np.maximum((k + 1) / WEEKS - at, 0)).sum()
            y = r.yhat + bend + rng.normal(0, sigma)
            inside[s, k] = r.yhat_lower <= y <= r.yhat_upper
    assert abs(inside.mean() - 0.8) < 0.02
    assert np.abs(inside.mean(axis=0) - 0.8).max() < 0.035
    # and the changes matter: noise alone would be narrower by the last week
    width = np.array([r.yhat_upper - r.yhat_lower for r in got]).reshape(count, horizon).mean(axis=0)
    assert width[-1] > 1.1 * width[0] and abs(width[0] / (2 * forecasting.INTERVAL_Z * sigma) - 1) < 0.05


def test_rows_do_not_depend_on_partitions_or_neighbours(spark):
    rows = models(spark, 6, [0.5, -0.5], 0.1)
    once = forecast(rows, paths=50)
    again = forecast(rows.repartition(5, "SKU_ID"), paths=50)
    alone = forecast(rows.where("SKU_ID = 's3'"), paths=50)
    assert once == again and [r for r in once if r.SKU_ID == "s3"] == alone
    assert len({r.yhat_upper for r in once}) == len(once)
    # a longer horizon leaves the noise of earlier weeks as it is
    plain = models(spark, 1, [], 0.1)
    assert forecast(plain, 4, 50) == forecast(plain, 6, 50)[:4]


def test_nothing_uncertain_and_lifted_noise(spark):
    flat = forecast(models(spark, 1, [], 0.0), paths=20)
    assert all(r.yhat_lower == r.yhat == r.yhat_upper for r in flat)
    # the trend's changes are multiplied by the effects, the noise is not
    one, two = (
        forecast(models(spark, 1, [1.0], 0.0, mode, wave=0.5), paths=400) for mode in ("additive", "multiplicative")
    )
    for a, m in zip(one, two):
        lift = m.yhat / 10.0
        assert abs((m.yhat_upper - m.yhat) - lift * (a.yhat_upper - a.yhat)) < 1e-9
    noise = [forecast(models(spark, 1, [], 0.3, mode, wave=0.5), paths=50) for mode in ("additive", "multiplicative")]
    for a, m in zip(*noise):
        assert abs((m.yhat_upper - m.yhat) - (a.yhat_upper - a.yhat)) < 1e-9


@pytest.mark.parametrize("mean", [0.0, 0.3, 7.0, 90.0])
def test_counts_have_the_mean_and_variance_of_their_law(spark, mean):
    frame = spark.range(4000).select(
        F.col("id").cast("string").alias("SKU_ID"), F.lit("c").alias("Channel"), F.lit("u").alias("Unit"),
        F.lit(mean).alias("m"),
    )
    n = np.array([r[0] for r in frame.select(intervals.arrivals("m", intervals.uniform(F.lit("n")))).collect()])
    assert abs(n.mean() - mean) <= 4 * np.sqrt(mean / 4000)
    assert abs(n.var() - mean) <= 0.15 * mean


def test_quantiles_are_linear_between_neighbours(spark):
    values = sorted([0.3, -1.0, 5.0, 2.5, 2.5, 9.0, -4.0])
    frame = spark.createDataFrame([(values,)], "v array<double>")
    for share in (0.0, 0.1, 0.5, 0.9, 1.0):
        got = frame.select(intervals.quantile(F.col("v"), share, len(values))).first()[0]
        assert abs(got - np.quantile(values, share)) < 1e-12
