"""Fit, forecast, tuning and the batch run."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.metrics import accuracy
from shelfcast.operators import (
    design,
    evaluate,
    fitting,
    forecasting,
    grid,
    holidays,
    quality,
    regressors,
    tuning,
    weekly,
)
from shelfcast.plans import batch
from shelfcast.schemas import LAG, METRICS, PARAMETERS, PROMO, SERIES

D = dt.date
START = D(2022, 1, 2)
LOOSE = {
    "changepoint_prior_scale": 0.5,
    "seasonality_prior_scale": 10.0,
    "holidays_prior_scale": 10.0,
    "seasonality_mode": "additive",
    "changepoint_range": 0.8,
}


def weekly_rows(spark, series, weeks=130, level=100.0, slope=0.5, promo=8.0, noise=1.0, seed=1):
    """Weekly features with a known trend, promotion effect and yearly wave."""
    rng = np.random.default_rng(seed)
    out = []
    for s in series:
        y_before = 0.0
        for i in range(weeks):
            ds = START + dt.timedelta(days=7 * i)
            p = float(rng.integers(0, 2))
            wave = 10 * np.sin(2 * np.pi * (ds - D(1970, 1, 1)).days / 365.25)
            y = float(max(0.0, level + slope * i + promo * p + wave + noise * rng.normal()))
            out.append((s, "TF", "U", ds, y, 5.0 * p, p, y_before))
            y_before = y
    return spark.createDataFrame(
        out,
        "SKU_ID string, Channel string, Unit string, ds date, y double, "
        "Promo_discount_perc double, is_promo double, y_lag1 double",
    )


def params_for(df, **changes):
    record = {**LOOSE, **changes}
    return df.select(*SERIES).distinct().select(*SERIES, *[F.lit(record[p]).alias(p) for p in PARAMETERS])


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_solver_recovers_known_effects(mode):
    rng = np.random.default_rng(3)
    n = 300
    t = np.linspace(0, 1, n)
    trend = fitting._trend(t, [0.25, 0.5, 0.75])
    x = rng.normal(size=(n, 3))
    theta, beta = np.array([0.4, 0.3, 0.0, -0.6, 0.0]), np.array([0.10, -0.05, 0.0])
    y = fitting.predicted(theta[None], beta[None], trend, x, mode == "multiplicative")[0]
    y = y + rng.normal(size=n) * 0.005
    got, effects, sigma, stands = fitting.map_estimates(
        y, trend, x, np.array([0.5]), np.full((1, 3), 10.0), mode == "multiplicative"
    )
    assert np.allclose(effects[0], beta, atol=0.01)
    assert np.allclose(got[0, :2], theta[:2], atol=0.05)
    assert abs(got[0, 3] + 0.6) < 0.1
    assert 0.003 < sigma[0] < 0.01 and stands.all()


def test_records_solved_together_as_alone():
    rng = np.random.default_rng(5)
    t = np.linspace(0, 1, 80)
    trend, x = fitting._trend(t, [0.3, 0.6]), rng.normal(size=(80, 4))
    y = 0.5 + 0.2 * t + 0.1 * x[:, 0] + 0.02 * rng.normal(size=80)
    widths, scales = np.array([0.01, 0.5]), np.array([[0.1] * 4, [10.0] * 4])
    for multiplicative in (False, True):
        both = fitting.map_estimates(y, trend, x, widths, scales, multiplicative)
        for i in range(2):
            one = fitting.map_estimates(y, trend, x, widths[i : i + 1], scales[i : i + 1], multiplicative)
            for together, alone in zip(both[:2], one[:2]):
                assert np.allclose(together[i], alone[0], atol=1e-5)


@pytest.mark.parametrize("multiplicative", [False, True])
def test_solutions_are_modes_whatever_the_step_limit(multiplicative):
    """The whole grid on one series: slopes near 0, and more steps change nothing."""
    rng = np.random.default_rng(8)
    n = 110
    t = np.linspace(0, 1, n)
    trend = fitting._trend(t, np.linspace(0.03, 0.8, 25))
    x = np.column_stack([np.sin(2 * np.pi * t * k) for k in range(1, 21)] + [rng.normal(size=(n, 6))])
    y = np.maximum(0, 0.4 + 0.3 * t + 0.1 * x[:, 3] + 0.08 * x[:, 21] + 0.1 * rng.normal(size=n))
    y = y / y.max()
    widths = np.repeat(grid.DEFAULT_GRID["changepoint_prior_scale"], 30)
    scales = np.tile(np.repeat(grid.DEFAULT_GRID["seasonality_prior_scale"], 5), 5)
    effects = fitting._effect_scales(scales, np.tile(grid.DEFAULT_GRID["holidays_prior_scale"], 30), x.shape[1])
    got = fitting.map_estimates(y, trend, x, widths, effects, multiplicative)
    more = fitting.map_estimates(y, trend, x, widths, effects, multiplicative, 10 * fitting.STEP_LIMIT)
    assert got[3].all()
    posterior = fitting._Posterior(y, trend, x, widths, effects, multiplicative)
    w = np.hstack(got[:2])
    gradient, _, _ = posterior.step(w, fitting.ROUNDING)
    assert np.abs(gradient).max() < 0.05
    numeric = [
        (posterior.value(w + h, fitting.ROUNDING) - posterior.value(w - h, fitting.ROUNDING)) / 2e-6
        for h in 1e-6 * np.eye(w.shape[1])[[0, 1, 5, 27, 40, 50]]
    ]
    assert np.allclose(np.array(numeric).T, gradient[:, [0, 1, 5, 27, 40, 50]], atol=1e-2)
    first, second = (fitting.predicted(*e[:2], trend, x, multiplicative) for e in (got, more))
    assert np.allclose(first, second, atol=1e-9)


def test_a_record_that_does_not_converge_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(fitting, "STEP_LIMIT", 1)
    t = np.linspace(0, 1, 30)
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(30, 2)), rng.normal(size=30) ** 2
    stands = fitting.map_estimates(y, fitting._trend(t, [0.5]), x, [0.05], np.ones((1, 2)), True, 1)[3]
    assert not stands.any()


def test_forecast_of_generated_data(spark):
    """Trend, wave and promotion are carried into the holdout; JVM and fit agree."""
    rows = weekly_rows(spark, ["a"])
    split = weekly.split_holdout(rows).cache()
    models = fitting.fit_models(split, params_for(rows)).cache()
    assert models.first().status == weekly.SUCCESS
    history = forecasting.predict(models, split.where("is_train"))
    assert history.select(accuracy()[0]).first()[0] < 1.5
    future = regressors.future_regressors(split)
    ahead = forecasting.iterative_forecast(models, future)
    compared = evaluate.forecast_vs_actual(split.where("not is_train"), ahead)
    assert compared.count() == 2
    assert evaluate.score(compared).first().WAPE < 0.05
    inside = ahead.where("yhat_lower <= yhat and yhat <= yhat_upper and yhat_lower < yhat_upper")
    assert (ahead.count(), inside.count()) == (4, 4)


def test_fold_equals_a_loop(spark):
    """The folded forecast is the one a week-by-week loop gives."""
    rows = weekly_rows(spark, ["a"], weeks=60)
    split = weekly.split_holdout(rows).cache()
    for mode in ("additive", "multiplicative"):
        models = fitting.fit_models(split, params_for(rows, seasonality_mode=mode)).cache()
        future = regressors.future_regressors(split).cache()
        raw = forecasting.iterative_forecast(models, future, clip=False).orderBy("ds").collect()
        lag = models.first().last_y
        for step in raw:
            week = future.where(F.col("ds") == F.lit(step.ds)).withColumn("y_lag1", F.lit(lag))
            one = forecasting.predict(models, week).first()
            assert abs(one.yhat - step.yhat) < 1e-9 * max(1.0, abs(one.yhat))
            assert abs(one.yhat_upper - step.yhat_upper) < 1e-9 * max(1.0, abs(one.yhat_upper))
            lag = max(0.0, one.yhat)


def test_another_series_changes_nothing(spark):
    one = weekly_rows(spark, ["a"], weeks=60)
    two = one.unionByName(weekly_rows(spark, ["b"], weeks=60, seed=9))
    got = []
    for rows in (one, two.repartition(7)):
        split = weekly.split_holdout(rows)
        model = fitting.fit_models(split, params_for(rows)).where("SKU_ID = 'a'").first()
        got.append((model.offset, model.slope, tuple(model.beta), tuple(model.deltas)))
    assert got[0] == got[1]


def test_failed_series_is_a_row(spark):
    rows = weekly_rows(spark, ["a", "b"], weeks=40)
    only_a = params_for(rows).where("SKU_ID = 'a'")
    got = fitting.fit_models(weekly.split_holdout(rows), only_a).orderBy("SKU_ID").collect()
    assert [r.status for r in got] == [weekly.SUCCESS, weekly.FAILED]
    assert got[1].error_message == "no valid parameters" and got[1].beta is None


def test_series_of_zeros_and_short_series(spark):
    rows = weekly_rows(spark, ["z"], weeks=14, level=0.0, slope=0.0, promo=0.0, noise=0.0).withColumn("y", F.lit(0.0))
    split = weekly.split_holdout(rows)
    assert fitting.fit_models(split, params_for(rows)).first().status == weekly.SUCCESS
    for weeks in (3, 4):
        tiny = weekly.split_holdout(weekly_rows(spark, ["t"], weeks=weeks))
        assert fitting.fit_models(tiny, params_for(tiny)).count() == 1


def test_forecasts_are_never_negative(spark):
    rows = weekly_rows(spark, ["a"], weeks=80, level=60.0, slope=-1.0)
    split = weekly.split_holdout(rows)
    models = fitting.fit_models(split, params_for(rows))
    ahead = forecasting.iterative_forecast(models, regressors.future_regressors(split))
    assert ahead.where("yhat < 0 or yhat_lower < 0 or yhat_upper < 0").count() == 0


def test_grid_sizes(spark):
    profile = spark.createDataFrame(
        [("a", 0.1, 0.0, 60), ("b", 0.9, 0.5, 60), ("c", 0.1, 0.0, 20), ("d", 0.9, 0.5, 20)],
        "SKU_ID string, cv double, zero_share double, n_points int",
    ).withColumns({"Channel": F.lit("TF"), "Unit": F.lit("U")})
    records = grid.profiled_grid(profile)
    sizes = {r.SKU_ID: r["count"] for r in records.groupBy("SKU_ID").count().collect()}
    assert sizes == {"a": 900, "b": 600, "c": 720, "d": 480}
    first = {r.SKU_ID: r.seasonality_mode for r in records.where("param_id = 0").collect()}
    assert (first["a"], first["b"]) == ("additive", "multiplicative")
    assert records.where("SKU_ID = 'a'").select("param_id").distinct().count() == 900


def test_schedule_and_tuning(spark):
    rows = weekly_rows(spark, ["a"], weeks=60).cache()
    folds = grid.cv_schedule(rows).collect()
    assert [(f.weeks_before, f.test_end - f.cutoff) for f in folds] == [(58, dt.timedelta(days=14))]
    small = {**{k: [v] for k, v in LOOSE.items()}, "seasonality_mode": ["additive", "multiplicative"],
             "changepoint_prior_scale": [0.01, 0.5]}
    records = grid.with_manual_record(grid.given_grid(rows.select(*SERIES).distinct(), small), rows.select(*SERIES).distinct())
    split = weekly.split_holdout(rows, validation_days=0)
    scored = tuning.tune(split, records, grid.cv_schedule(rows)).cache()
    assert scored.count() == 5 and scored.where("smape < 2").count() == 5
    best = tuning.best_params(scored).first()
    assert best.smape == scored.agg(F.min("smape")).first()[0]
    # The sums of folds give the metrics that scoring the held-out weeks gives.
    by_week = tuning.score_records(fitting.held_out_predictions(split, records, grid.cv_schedule(rows)), records)
    columns = ["param_id", *PARAMETERS, "mae", "rmse", "smape", "error"]
    for a, b in zip(*(df.select(*columns).orderBy("param_id").collect() for df in (scored, by_week))):
        assert a[:6] == b[:6] and np.allclose(a[6:9], b[6:9]) and a.error == b.error is None
    assert tuning.tune(split, records, grid.cv_schedule(rows).limit(0)).where("smape = double('inf')").count() == 5
    for weeks in (3, 10, 58, 300):
        for reach in (0.8, 0.9, 0.95):
            placed = spark.range(1).select(design.knots(F.lit(weeks), F.lit(reach)).alias("k")).first().k
            assert np.allclose(placed, fitting._knots(weeks, reach), atol=1e-15)
    # The held-out forecast of a record is that of a model fitted to the fold.
    held = fitting.held_out_predictions(split, records, grid.cv_schedule(rows))
    record = held.where("param_id = 0").orderBy("ds").collect()
    fold = split.withColumn("is_train", F.col("ds") <= F.lit(folds[0].cutoff))
    model = fitting.fit_models(fold, params_for(rows, changepoint_prior_scale=0.01))
    direct = forecasting.predict(model, fold.where("not is_train")).orderBy("ds").collect()
    for a, b in zip(record, direct):
        assert abs(a.yhat - b.yhat) < 0.02 * abs(b.yhat)


def test_selection_skips_infinite_and_breaks_ties(spark):
    rows = [(1, 0.5, 3.0), (0, 0.5, 4.0), (2, float("inf"), 1.0), (3, None, 0.0)]
    results = spark.createDataFrame(rows, "param_id int, smape double, mae double").withColumns(
        {**{k: F.lit("x") for k in SERIES}, **{p: F.lit(LOOSE[p]) for p in PARAMETERS}}
    )
    best = tuning.best_params(results).first()
    assert (best.param_id, best.mae, best.lowest_mae) == (0, 4.0, 3.0)
    assert tuning.best_params(results.where("param_id > 1")).count() == 0


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 0.0), (10.0, 30.0)], "y double, yhat double")
    got = df.agg(*accuracy()).first()
    assert (got.MAE, got.sMAPE, got.WAPE) == (10.0, 0.5, 2.0)
    assert abs(got.RMSE - 200**0.5) < 1e-12
    zeros = spark.createDataFrame([(0.0, 3.0)], "y double, yhat double").agg(*accuracy()).first()
    assert zeros.WAPE == float("inf") and zeros.sMAPE == 2.0


def test_holiday_rules(spark):
    days = spark.createDataFrame([(D(2023, 1, 1),), (D(2024, 2, 25),), (D(2024, 2, 18),)], "ds date")
    got = days.select(
        holidays.week_holiday_flag(F.col("ds")).alias("s"),
        holidays.week_holiday_flag(F.col("ds"), "week").alias("w"),
    ).collect()
    assert [(r.s, r.w) for r in got] == [(1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]


def test_assumed_promotion_without_holdout(spark):
    rows = weekly_rows(spark, ["a"], weeks=20)
    split = weekly.split_holdout(rows, validation_days=0)
    got = regressors.future_regressors(split).collect()
    assert {(r.Promo_discount_perc, r.is_promo) for r in got} == {(5.0, 1.0)} and len(got) == 4


def test_yearly_terms_need_a_year(spark):
    rows = weekly_rows(spark, ["a"], weeks=40)
    split = weekly.split_holdout(rows)
    assert split.first().yearly is False
    x = design.design(split, SERIES).first().x
    assert set(x[: design.HOLIDAY_AT]) == {0.0}


def test_batch_reports_every_series(spark, daily_frame):
    """All statuses, one row per requested series."""
    def days(sku, first, n, y=3):
        return [(sku, str(first + dt.timedelta(days=i)), y + i % 3, 5 * (i % 2)) for i in range(n)]

    first = D(2024, 1, 1)
    daily = daily_frame(
        days("good", first, 200)
        + days("short", first, 20)
        + days("thin", first, 60)
        + [("returns", str(first), -1, 0), ("returns", str(first + dt.timedelta(days=90)), -1, 0)]
    )
    sales = daily.select(
        "SKU_ID", F.col("Channel").alias("channel"), F.col("Unit").alias("unit"), F.col("ds").alias("date"),
        F.col("y").alias("quantity"), "Promo_discount_perc",
    )
    listed = spark.createDataFrame(
        [(s, "TF", "U") for s in ("good", "short", "thin", "returns", "absent")],
        "SKU_ID string, Channel string, Unit string",
    )
    run = batch.run_batch(sales, listed, param_grid={k: [v] for k, v in LOOSE.items()})
    got = {r.SKU_ID: r for r in run.results.collect()}
    assert {k: r.Status for k, r in got.items()} == {
        "good": weekly.SUCCESS,
        "short": weekly.SHORT_DATA,
        "thin": weekly.SHORT_TRAIN,
        "returns": weekly.FAILED,
        "absent": weekly.NO_DATA,
    }
    assert run.results.columns == batch.RESULT_COLUMNS
    assert all(got["good"][m] is not None and got["short"][m] is None for m in METRICS)
    assert got["short"].error_message == "20 days available, 42 required"
    assert got["good"].validation_start == "2024-07-08" and got["good"].min_date == "2024-01-01"
    assert run.forecast.count() == 4 and run.components.where("step > 0").count() == 4


def test_log_scale_and_prepared_weeks(spark, daily_frame):
    """The optional log scale reports on the data's scale; prepared rows reach the model."""
    first = D(2024, 1, 1)
    daily = daily_frame(
        [("a", str(first + dt.timedelta(days=i)), 500 if i == 60 else 3 + i % 3, 0) for i in range(203)]
    )
    sales = daily.select(
        "SKU_ID", F.col("Channel").alias("channel"), F.col("Unit").alias("unit"), F.col("ds").alias("date"),
        F.col("y").alias("quantity"), "Promo_discount_perc",
    )
    run = batch.run_batch(
        sales,
        daily.select(*SERIES).distinct(),
        param_grid={k: [v] for k, v in LOOSE.items()},
        log_target=True,
        prepare=quality.outliers,
    )
    assert run.weekly.where("is_outlier").count() == 1
    assert run.results.first().Status == weekly.SUCCESS
    assert run.comparison.where("yhat between 20 and 40").count() == 2
    # components on the scale of the data, too
    parts = run.components.orderBy("ds").collect()
    assert all(20 < r.yhat < 40 and 20 < r.trend < 40 for r in parts[2:])
    ahead = {r.ds: r.yhat for r in run.forecast.collect()}
    assert all(abs(ahead[r.ds] - r.yhat) < 1e-6 for r in parts if r.step > 0)
    # the outlier is gone from the lag of the week after it, and held-out actuals are as sold
    assert run.weekly.agg(F.max("y_lag1")).first()[0] < 60
    held = run.weekly.where("not is_train").orderBy("ds")
    assert [r.y for r in held.collect()] == [r.y for r in run.comparison.orderBy("ds").collect()]
    # stored models carry their scale: the weekly job publishes quantities
    job = forecasting.weekly_job(run.models, run.weekly.select(*SERIES, "ds", "y", *PROMO, LAG), "2024-08-01")
    assert job.where("predicted_quantity between 20 and 40").count() == 4
    with pytest.raises(Exception, match="weather grain"):
        forecasting.weekly_job(run.models, run.weekly, "2024-08-01", weather_grain="row").collect()


def test_holdout_outliers_are_not_prepared(spark):
    """A jump in the holdout stays, and does not change the training weeks."""
    calm = weekly_rows(spark, ["a"], weeks=40)
    last = START + dt.timedelta(days=7 * 39)
    jump = calm.withColumn("y", F.when(F.col("ds") == F.lit(last), 9000.0).otherwise(F.col("y")))

    def prepared(rows):
        return weekly.prepared_training(weekly.split_holdout(rows), quality.outliers)

    got = prepared(jump)
    assert got.count() == 40 and got.where("y = 9000 and not is_train").count() == 1
    columns = [*SERIES, "ds", "y", "is_outlier", LAG]
    train = [df.where("is_train").select(*columns).orderBy("ds").collect() for df in (got, prepared(calm))]
    assert train[0] == train[1]


def test_given_holidays_reach_fit_and_forecast(spark):
    """A day off that no rule knows has its effect in the model; the holiday rule is the model's."""
    days = [START + dt.timedelta(days=7 * i - 2) for i in range(3, 130, 9)]
    table = spark.createDataFrame([(d,) for d in days], "ds date")
    rows = holidays.with_holiday_table(weekly_rows(spark, ["a"]), table, "week")
    rows = rows.withColumn("y", F.col("y") + 30 * F.col("holiday"))
    split = weekly.split_holdout(rows).cache()
    models = fitting.fit_models(split, params_for(rows), "week").cache()
    assert models.first().holiday_match == "week"
    parts = forecasting.predict(models, split.where("is_train"))
    off = parts.join(rows.where("holiday = 1").select(*SERIES, "ds"), [*SERIES, "ds"])
    assert off.where("holidays between 20 and 40").count() == off.count() > 10
    ruled = fitting.fit_models(weekly.split_holdout(rows.drop("holiday")), params_for(rows), "week")
    assert abs(ruled.first().beta[design.HOLIDAY_AT] * ruled.first().y_scale) < 15
    future = holidays.with_holiday_table(regressors.future_regressors(split), table, "week")
    assert forecasting.iterative_forecast(models, future).count() == 4
