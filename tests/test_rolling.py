"""Rolling origins, ensembles of records, information by neighbours, the solver's steps."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import fitting, grid, quality, rolling
from shelfcast.schemas import PARAMETERS, SERIES

START = dt.date(1998, 1, 4)


def weekly_rows(spark, series=2, weeks=60):
    rng = np.random.default_rng(4)
    rows = []
    for s in range(series):
        y = 50 + 10 * s + 0.3 * np.arange(weeks) + rng.normal(0, 3, weeks)
        promo = (np.arange(weeks) % 5 == 0).astype(float)
        y = y + 8 * promo
        for i in range(weeks):
            rows.append(
                (f"s{s}", "c", "u", START + dt.timedelta(weeks=i), float(y[i]), float(y[i - 1]) if i else 0.0,
                 float(10 * promo[i]), float(promo[i]), False, START + dt.timedelta(weeks=weeks - 1))
            )
    schema = (
        "SKU_ID string, Channel string, Unit string, ds date, y double, y_lag1 double, "
        "Promo_discount_perc double, is_promo double, yearly boolean, last_week date"
    )
    return spark.createDataFrame(rows, schema)


def params_of(df, mode):
    record = {**grid.MANUAL_RECORD, "seasonality_mode": mode}
    return df.select(*SERIES).distinct().select(*SERIES, *[F.lit(record[p]).alias(p) for p in PARAMETERS])


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_rolling_predictions_are_those_of_fresh_fits(spark, mode):
    train = weekly_rows(spark)
    params = params_of(train, mode)
    folds = grid.cv_schedule(train, grid.initial_weeks(F.col("train_weeks"), automatic=True))
    key = lambda r: (r.SKU_ID, r.fold, r.ds)
    rolled = sorted(rolling.rolling_predictions(train, params, folds).collect(), key=key)
    records = params.withColumn("param_id", F.lit(0))
    fresh = sorted(fitting.held_out_predictions(train, records, folds).collect(), key=key)
    assert [key(r) for r in rolled] == [key(r) for r in fresh] and len(rolled) > 20
    assert all(r.error is None for r in rolled)
    assert max(abs(a.yhat - b.yhat) for a, b in zip(rolled, fresh)) < 1e-3
    assert [r.y for r in rolled] == [r.y for r in fresh]


def test_prefix_constants_are_those_of_the_prefix():
    rng = np.random.default_rng(1)
    raw = np.column_stack([rng.normal(1e6, 1, 40), rng.integers(0, 2, 40), np.full(40, 7.5)])
    y, days = rng.normal(size=40), np.arange(40) * 7.0
    prefixes = rolling.Prefixes(days, y, raw)
    for weeks in (2, 17, 40):
        t, x, top = prefixes.scaled(weeks)
        part = raw[:weeks, 0]
        assert np.allclose(x[:, 0], (raw[:, 0] - part.mean()) / part.std(ddof=1), rtol=1e-6, atol=1e-6)
        assert np.array_equal(x[:, 1:], raw[:, 1:])
        assert t[weeks - 1] == 1 and top == np.abs(y[:weeks]).max()


def test_no_folds_no_rows(spark):
    train = weekly_rows(spark, weeks=4)
    folds = grid.cv_schedule(train, F.lit(10))
    assert rolling.rolling_predictions(train, params_of(train, "additive"), folds).collect() == []


def test_top_records_and_weights(spark):
    names = ", ".join(f"{p} {'string' if p == 'seasonality_mode' else 'double'}" for p in PARAMETERS)
    rows = [
        ("a", "c", "u", i, *[("additive" if p == "seasonality_mode" else 0.5) for p in PARAMETERS], s)
        for i, s in enumerate([0.4, 0.2, float("inf"), 0.2, float("nan"), 0.9])
    ] + [("b", "c", "u", 0, *[("additive" if p == "seasonality_mode" else 0.5) for p in PARAMETERS], float("inf"))]
    results = spark.createDataFrame(rows, f"SKU_ID string, Channel string, Unit string, param_id int, {names}, smape double")
    best = rolling.top_records(results, 3).orderBy("member").collect()
    assert [(r.SKU_ID, r.member, r.param_id) for r in best] == [("a", 1, 1), ("a", 2, 3), ("a", 3, 0)]
    assert math.isclose(sum(r.weight for r in best), 1.0)
    assert math.isclose(best[0].weight / best[2].weight, 2.0, rel_tol=1e-4)


def test_information_by_neighbours():
    rng = np.random.default_rng(3)
    x = rng.normal(size=2000)
    noise = rng.normal(size=2000)
    assert quality.neighbour_information(x, noise, 3) < 0.05
    rho = 0.8
    y = rho * x + math.sqrt(1 - rho**2) * noise
    assert abs(quality.neighbour_information(x, y, 3) + 0.5 * math.log(1 - rho**2)) < 0.06
    flags, other = rng.integers(0, 2, 2000).astype(float), rng.integers(0, 3, 2000).astype(float)
    assert quality.neighbour_information(flags, other, 3) < 0.05
    assert abs(quality.neighbour_information(flags, flags, 3) - math.log(2)) < 0.02
    assert quality.neighbour_information(np.ones(50), noise[:50], 3) < 1e-12
    assert quality.neighbour_information(x[:3], noise[:3], 3) == 0.0


def test_independent_columns_are_not_kept(spark):
    rng = np.random.default_rng(9)
    rows = [
        ("s", "c", "u", float(v), float(p), float(d), float(lag))
        for v, p, d, lag in zip(rng.normal(100, 9, 350), rng.integers(0, 2, 350), rng.normal(size=350), rng.normal(size=350))
    ]
    schema = "SKU_ID string, Channel string, Unit string, y double, is_promo double, Promo_discount_perc double, y_lag1 double"
    frame = spark.createDataFrame(rows, schema)
    kept = {r.regressor: r.keep for r in quality.regressor_selection(frame).collect()}
    assert len(kept) == 3 and sum(kept.values()) == 0


def test_products_with_large_residuals_converge():
    """Creeping records: a stiff yearly prior beside a loose one for the regressors."""
    rng = np.random.default_rng(2)
    n = 200
    t = np.linspace(0, 1, n)
    x = np.column_stack([np.sin(np.arange(n) * k / 8) for k in range(1, 21)] + [np.zeros(n), rng.normal(size=n)])
    y = np.abs((0.3 + 0.2 * t) * (1 + 0.9 * x[:, -1]) + 0.2 * rng.normal(size=n))
    trend = fitting._trend(t, np.linspace(0.05, 0.8, 25))
    scales = np.repeat(np.array([[0.01], [0.01], [10.0]]), x.shape[1], axis=1)
    scales[:, 20:] = np.array([[5.0], [10.0], [0.1]])
    *_, stands = fitting.map_estimates(y / y.max(), trend, x, np.array([0.01, 0.1, 0.5]), scales, True, step_limit=200)
    assert stands.all()
