"""Every query by name: ``(spark, folder of the test tables) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.durable import fresh_path, repeat_rows, settle
from shelfcast.functions import numeric, text
from shelfcast.operators import (
    design,
    evaluate,
    fitting,
    forecasting,
    frozen,
    grid,
    holidays,
    ingest,
    intervals,
    inventory,
    monitoring,
    quality,
    regressors,
    rolling,
    tuning,
    upkeep,
    weekly,
)
from shelfcast.plans import batch, resume
from shelfcast.plans import standins as given
from shelfcast.plans.present import present
from shelfcast.schemas import METRICS, PARAMETERS, PROMO, WEATHER
from shelfcast.sources import dimensions, published, series_list, tables, weather
from shelfcast.sources import sales as sales_source
from shelfcast.sources.tables import latest_models, with_partition_day

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = given.AS_OF
SEEDS = given.STOCK_SEED_FILES

#: Arguments of the qualified-SKU reports, scaled to the density of the test tables.
QUALIFY = {"since": "1999-01-01", "min_days": 12, "seen_by": "1999-12-31", "seen_from": "2000-01-01"}


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return present(fn(spark, sf))

    QUERIES[fn.__name__] = run
    return run


def stored(df):
    """Rows that several steps read are written once: stand-ins for stored tables, weekly rows."""
    return settle(df, "given")


def daily(spark, sf):
    return sales_source.daily_sales(given.sales(spark, sf))


def features(spark, sf):
    return weekly.weekly_features(daily(spark, sf), given.weather(spark, sf))


# --- sources and clean-up -----------------------------------------------------------------


@query
def sales_scan(spark, sf):
    """All listed series in one scan, within a date range."""
    listed = series_list.normalise_series_list(given.series_list(spark, sf))
    return sales_source.daily_sales(
        given.sales(spark, sf), listed, start_date="1996-01-01", end_date="2000-12-31"
    )


@query
def sales_scan_bad_date(spark, sf):
    """A bound that is no date: no rows, same columns; counted so that there is a row."""
    got = sales_source.daily_sales(given.sales(spark, sf), start_date="1996-13-45")
    return got.agg(F.count(F.lit(1)).alias("rows"), F.count("y").alias("with_y"))


@query
def series_list_clean(spark, sf):
    return series_list.normalise_series_list(given.series_list(spark, sf))


@query
def combos_filter_limit(spark, sf):
    listed = series_list.normalise_series_list(given.series_list(spark, sf))
    return series_list.choose_series(
        listed, unit="EUROPE", channel="", max_series=7, list_order=["SKU_ID", "Channel", "Unit"]
    )


@query
def negative_sales_filter(spark, sf):
    return sales_source.returns_removed(daily(spark, sf))


@query
def kept_daily_sales(spark, sf):
    return sales_source.without_returns(daily(spark, sf))


@query
def goods_clean(spark, sf):
    return dimensions.goods_attributes(given.goods_source(spark, sf))


@query
def trim_all_strings(spark, sf):
    return text.trim_text_columns(given.landing_sales(spark, sf))


@query
def customer_dim(spark, sf):
    return dimensions.customer_hierarchy(given.customers(spark, sf))


@query
def weather_json_daily(spark, sf):
    from shelfcast.schemas import WEATHER_PAYLOAD

    raw = given.weather_payload(spark, sf).select(
        "town", F.from_json("payload", WEATHER_PAYLOAD).alias("p")
    )
    return weather.unpack_payload(raw.select("town", "p.daily"), carry=["town"])


@query
def weather_weekly(spark, sf):
    from shelfcast.schemas import WEATHER_PAYLOAD

    raw = given.weather_payload(spark, sf).select(
        "town", F.from_json("payload", WEATHER_PAYLOAD).alias("p")
    )
    days = weather.unpack_payload(raw.select("town", "p.daily"), carry=["town"])
    return weather.weekly_weather(days, by=["town"])


@query
def weather_forecast_window(spark, sf):
    """Sixteen days at most, from the reporting day on, missing variables as 0."""
    days = given.weather(spark, sf).drop("snowfall_sum")
    return weather.limit_forecast(weather.complete_variables(days), "2001-10-20", 35)


# --- files and stored tables --------------------------------------------------------------


@query
def series_list_file(spark, sf):
    """The list written as CSV and read again."""
    path = fresh_path(spark, "series-list")
    tables.write_csv(given.series_list(spark, sf), path)
    return series_list.read_series_list(spark, path)


@query
def weather_files(spark, sf):
    """Weather payloads, each in a JSON file of its own."""
    path = fresh_path(spark, "weather")
    payloads = given.weather_payload(spark, sf).select("payload")
    payloads.write.option("maxRecordsPerFile", 1).text(path)
    return weather.read_weather_history(spark, path)


@query
def weekly_rows_stored(spark, sf):
    """Weekly rows laid out by unit and channel, two units restated, and read again."""
    path = fresh_path(spark, "weekly")
    rows = weekly_lag.__wrapped__(spark, sf)
    tables.overwrite(rows.withColumn("y", -F.col("y")), path, ["Unit", "Channel"])
    for unit in ("ASIA", "EUROPE"):
        tables.replace_partitions(rows.where(F.col("Unit") == unit), path, ["Unit", "Channel"])
    return tables.read_table(spark, path, rows.schema).select(*rows.columns)


@query
def weekly_upkeep(spark, sf):
    """Weekly rows from stored cells: built from the first load, kept up when days are restated."""
    sales_path, cells_path = fresh_path(spark, "sales"), fresh_path(spark, "cells")
    lines = stored(given.sales(spark, sf))
    last = lines.agg(F.max("date")).scalar()
    first_load = lines.where(F.col("date") < F.date_sub(last, 30))
    restated = lines.where(F.col("date") >= F.date_sub(last, 60))
    restated = restated.withColumn("quantity", F.col("quantity") + 1)
    for load in (first_load, restated):
        published.publish(load, sales_path, ["date"])
        upkeep.refresh_cells(spark, sales_path, lines.schema, cells_path)
    schema = weekly.weekly_cells(sales_source.daily_sales(lines)).schema
    return weekly.fill_weeks(upkeep.stored_cells(spark, cells_path, schema))


@query
def run_metrics_stored(spark, sf):
    """Result rows of two runs, appended and read again."""
    path = fresh_path(spark, "results")
    scored = stored(evaluate.rounded_metrics(evaluate.score(naive_comparison(spark, sf))))
    for run in ("2001-10-28", "2001-11-04"):
        tables.write_results(scored, path, run)
    both = tables.read_table(spark, path)
    return both.select(*KEYS, F.col("run_id").cast("string").alias("run_id"), "MAE", "WAPE")


@query
def latest_models_stored(spark, sf):
    """Model rows appended twice: the newest of each series counts."""
    path = fresh_path(spark, "models")
    models = stored(lag_models(training(spark, sf)))
    tables.write_models(models, path, dt.datetime(2001, 10, 28))
    newer = models.where(F.col("Unit") != "ASIA").withColumn("offset", F.col("offset") + 1)
    tables.write_models(newer, path, dt.datetime(2001, 11, 4))
    latest = tables.latest_models(tables.read_table(spark, path))
    return latest.select(*KEYS, "trained_at", "offset", "last_y", F.element_at("beta", -1).alias("slope"))


# --- weekly series ------------------------------------------------------------------------


@query
def date_range(spark, sf):
    return weekly.date_range(daily(spark, sf))


@query
def weekly_resample(spark, sf):
    return weekly.present_weeks(weekly.weekly_cells(daily(spark, sf)))


@query
def weekly_gap_filled(spark, sf):
    """Series of towns, which have many empty weeks."""
    by_town = given.sales(spark, sf).withColumn("unit", F.col("town"))
    return weekly.weekly_features(sales_source.daily_sales(by_town))


@query
def weekly_lag(spark, sf):
    return weekly.weekly_features(daily(spark, sf)).select("SKU_ID", "Channel", "Unit", "ds", "y", "y_lag1")


@query
def weekly_with_weather(spark, sf):
    return features(spark, sf)


@query
def weekly_with_weather_by_row(spark, sf):
    return weekly.weekly_features(daily(spark, sf), given.weather(spark, sf), weather_grain="row")


@query
def series_gate(spark, sf):
    return weekly.series_gate(weekly.weekly_cells(daily(spark, sf))).drop("kept_rows")


@query
def train_validation_split(spark, sf):
    split = weekly.split_holdout(weekly.weekly_features(daily(spark, sf)))
    return split.select("SKU_ID", "Channel", "Unit", "ds", "y", "is_train", "validation_start")


@query
def split_summary(spark, sf):
    return weekly.split_summary(weekly.split_holdout(weekly.weekly_features(daily(spark, sf))))


# --- loading files ------------------------------------------------------------------------


@query
def daily_sales_seed(spark, sf):
    return given.seeded_sales(given.landing_sales(spark, sf))


@query
def daily_sales_merge(spark, sf):
    landing = stored(given.landing_sales(spark, sf))
    main = given.seeded_sales(landing)
    audit = ingest.load_audit(main, "main_sales", AS_OF)
    upto = ingest.loaded_upto(audit, "main_sales")
    return ingest.daily_merge(main, landing, trim=True, placeholder=True, upto=upto)


def published_sales(spark, sf):
    """Path and schema of the sales table: the seed is published, then the newest file.

    Files of the seed are in the table and never newer than it, so only the others are written.
    """
    path = fresh_path(spark, "main-sales")
    seed = given.seeded_sales(given.landing_sales(spark, sf))
    published.publish(seed, path, ["date"], note="seed", slices=published.slices_for(seed))
    late = stored(given.unseeded_sales(given.landing_sales(spark, sf, given.unseeded)))
    ingest.merge_and_publish(late, path, trim=True, placeholder=True)
    return path, seed.schema


@query
def daily_sales_published(spark, sf):
    path, schema = published_sales(spark, sf)
    return published.read(spark, path, schema)


@query
def published_states(spark, sf):
    """Partitions in each state of the sales table and how many it changed."""
    return published.history(spark, published_sales(spark, sf)[0])


@query
def daily_stock_merge(spark, sf):
    landing = given.landing_stocks(spark, sf)
    main = ingest.replay(landing.where(F.col("filename_end_date") < "2001-11-11"))
    return ingest.daily_merge(main, landing)


@query
def placeholder_row(spark, sf):
    landing = given.landing_sales(spark, sf)
    newest = ingest.newest_file(given.seeded_sales(landing), landing)
    return ingest.placeholder_row(newest)


@query
def load_audit(spark, sf):
    landing = given.landing_sales(spark, sf)
    newest = ingest.newest_file(given.seeded_sales(landing), landing)
    return ingest.load_audit(newest, "main_sales", AS_OF)


@query
def load_status(spark, sf):
    landing = given.landing_sales(spark, sf)
    again = ingest.load_status(landing, landing)
    return ingest.load_status(given.seeded_sales(landing), landing).unionByName(again)


@query
def stock_seed(spark, sf):
    return ingest.seed_from_files(given.landing_stocks(spark, sf), SEEDS)


@query
def stock_backfill_replay(spark, sf):
    return ingest.replay(given.landing_stocks(spark, sf), SEEDS)


@query
def stock_backfill_audit(spark, sf):
    return ingest.replay_audit(given.landing_stocks(spark, sf), "main_stocks", SEEDS, AS_OF)


@query
def sales_replay(spark, sf):
    """All sales files in one go: the latest file that contains a date wins."""
    return ingest.replay(given.landing_sales(spark, sf))


@query
def audit_partitions(spark, sf):
    """Audit rows counted by the day that partitions the audit table."""
    audit = ingest.replay_audit(given.landing_sales(spark, sf), "main_sales", [], AS_OF)
    by_day = with_partition_day(audit, "date_from_file_name", "file_day")
    return by_day.groupBy("file_day").agg(
        F.count(F.lit(1)).alias("files"), F.sum("no_of_records").alias("records")
    )


# --- snapshots ----------------------------------------------------------------------------


@query
def frozen_sales(spark, sf):
    return frozen.frozen_sales(
        given.sku_sales(spark, sf),
        given.customers(spark, sf),
        given.trimmed_catalog(spark, sf),
        AS_OF,
    )


@query
def frozen_sales_audit(spark, sf):
    snapshot = frozen.frozen_sales(
        given.sku_sales(spark, sf),
        given.customers(spark, sf),
        given.trimmed_catalog(spark, sf),
        "2001-11-01",
    )
    return frozen.refresh_audit(snapshot, "sales_frozen", "2001-11-01").withColumn(
        "debug_info", frozen.window_note("2001-11-01")
    )


@query
def frozen_stocks(spark, sf):
    return frozen.frozen_stocks(ingest.replay(given.landing_stocks(spark, sf)), AS_OF)


# --- stock cover --------------------------------------------------------------------------


def combinations(spark, sf, forecasts=None, **kw):
    """Only the window of the sales is written, and of the stocks nothing: one day of them is used."""
    sales = given.sku_sales(spark, sf)
    return inventory.report_by_combination(
        stored(inventory.recent_sales(sales, AS_OF)),
        ingest.replay(given.landing_stocks(spark, sf)),
        given.customers(spark, sf),
        given.goods(spark, sf),
        given.catalog(spark, sf),
        given.forecasts(spark, sf, sales) if forecasts is None else forecasts,
        given.warehouse_map(spark, sf),
        as_of=AS_OF,
        **kw,
    )


def report(spark, sf, **kw):
    return repeat_rows(combinations(spark, sf, **kw), "lines")


@query
def stock_cover_report(spark, sf):
    return report(spark, sf)


@query
def stock_cover_report_by_unit(spark, sf):
    """The same with the stock of a unit's warehouses added up."""
    return report(spark, sf, stock_by_unit=True)


@query
def report_with_forecast(spark, sf):
    return inventory.with_forecast(report(spark, sf))


@query
def report_sku_overlap(spark, sf):
    forecasts = given.forecasts(spark, sf, given.sku_sales(spark, sf))
    return inventory.skus_with_any_forecast(combinations(spark, sf, forecasts), forecasts)


@query
def forecast_vs_report(spark, sf):
    forecasts = given.forecasts(spark, sf, given.sku_sales(spark, sf))
    return inventory.forecast_beside_report(forecasts, combinations(spark, sf, forecasts))


@query
def latest_stock(spark, sf):
    stocks = ingest.replay(given.landing_stocks(spark, sf))
    return inventory.latest_stock(stocks, given.warehouse_map(spark, sf))


@query
def sales_averages(spark, sf):
    return inventory.sales_averages(inventory.recent_sales(given.landing_sales(spark, sf), AS_OF))


@query
def qualified_sku_quantity(spark, sf):
    return inventory.qualified_skus(given.sku_sales(spark, sf), **QUALIFY)


@query
def qualified_skus_by_contract(spark, sf):
    return inventory.qualified_skus_by_contract(
        inventory.qualified_skus(given.sku_sales(spark, sf), **QUALIFY),
        given.trimmed_catalog(spark, sf),
    )


# --- holdout, holidays, future weeks ------------------------------------------------------

KEYS = ["SKU_ID", "Channel", "Unit"]


def split(spark, sf):
    return weekly.split_holdout(features(spark, sf))


def training(spark, sf):
    return split(spark, sf).where("is_train")


def town_daily(spark, sf):
    return sales_source.daily_sales(given.sales(spark, sf).withColumn("unit", F.col("town")))


@query
def holiday_flags(spark, sf):
    rows = weekly.weekly_features(daily(spark, sf))
    return rows.select(
        *KEYS,
        "ds",
        holidays.week_holiday_flag(F.col("ds")).alias("on_sunday"),
        holidays.week_holiday_flag(F.col("ds"), "week").alias("in_week"),
    )


@query
def holiday_calendar(spark, sf):
    """Holidays per series, with the stock days of the test tables as extra days off."""
    extra = given.landing_stocks(spark, sf).select(F.col("date").alias("ds"))
    return holidays.holiday_calendar(weekly.weekly_features(daily(spark, sf)), KEYS, extra)


@query
def holiday_table_weeks(spark, sf):
    """Weeks flagged by a table of days off instead of the rule, by Sunday and by week."""
    rows = weekly.weekly_features(daily(spark, sf)).select(*KEYS, "ds")
    extra = given.landing_stocks(spark, sf).select(F.date_sub("date", 2).alias("ds"))
    by_week = holidays.with_holiday_table(rows, extra, "week").withColumnRenamed("holiday", "in_week")
    return holidays.with_holiday_table(by_week, extra, "sunday")


@query
def series_years(spark, sf):
    return holidays.series_years(weekly.weekly_features(daily(spark, sf)), KEYS)


@query
def training_means(spark, sf):
    return regressors.training_means(split(spark, sf))


@query
def future_weeks(spark, sf):
    return regressors.future_weeks(split(spark, sf))


def weekly_outlook(spark, sf):
    days = weather.limit_forecast(given.weather(spark, sf), "2001-10-20", 16)
    return weather.weekly_weather(days)


def future(spark, sf):
    return regressors.future_regressors(split(spark, sf), weekly_outlook(spark, sf))


@query
def future_regressors(spark, sf):
    return future(spark, sf)


@query
def future_regressors_without_holdout(spark, sf):
    """Nothing held out: the promotion is assumed, the weather is the training mean."""
    return regressors.future_regressors(
        weekly.split_holdout(features(spark, sf), validation_days=0)
    )


@query
def history_future_scaffold(spark, sf):
    return regressors.scaffold(split(spark, sf), future(spark, sf)).drop("step")


@query
def fill_forward_backward(spark, sf):
    rows = weekly.weekly_features(daily(spark, sf)).select(
        *KEYS, "ds", *[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in ("y", "Promo_discount_perc")]
    )
    return regressors.fill_forward_backward(rows, ["y", "Promo_discount_perc"])


# --- accuracy -----------------------------------------------------------------------------


def naive_comparison(spark, sf):
    held = stored(split(spark, sf))
    return evaluate.forecast_vs_actual(
        held.where(~F.col("is_train")), evaluate.naive_forecast(held)
    )


@query
def forecast_vs_actual(spark, sf):
    return naive_comparison(spark, sf)


@query
def naive_metrics(spark, sf):
    return evaluate.rounded_metrics(evaluate.score(naive_comparison(spark, sf)))


@query
def validation_plot(spark, sf):
    return evaluate.validation_plot_rows(naive_comparison(spark, sf))


@query
def run_summary(spark, sf):
    """Means over every series that passed the gates, and over those with a finite WAPE."""
    cells = stored(weekly.weekly_cells(daily(spark, sf)))
    scored = evaluate.score(naive_comparison(spark, sf)).join(weekly.series_status(cells), KEYS)
    finite = evaluate.mean_metrics(evaluate.finite_rows(scored, "WAPE"))
    finite = finite.select(F.lit("finite WAPE").alias("which"), "*")
    return evaluate.mean_metrics(scored).select(F.lit("all").alias("which"), "*").unionByName(finite)


@query
def status_counts(spark, sf):
    """Series of single customers, by what the data gate and the training gate say."""
    by_customer = given.sales(spark, sf).withColumn("unit", F.col("customer_ID"))
    cells = weekly.line_cells(sales_source.daily_sales(by_customer))
    return evaluate.status_counts(weekly.series_status(cells))


# --- tuning -------------------------------------------------------------------------------


@query
def series_profile(spark, sf):
    return grid.series_profile(training(spark, sf))


@query
def param_grid(spark, sf):
    return grid.default_grid(weekly.date_range(daily(spark, sf)))


@query
def param_grid_by_series(spark, sf):
    """Town series are sparse: the grid shrinks where zeros are many."""
    train = weekly.split_holdout(weekly.weekly_features(town_daily(spark, sf))).where("is_train")
    return grid.profiled_grid(grid.series_profile(train)).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("param_id").alias("ids"),
        F.max("param_id").alias("last_id"),
        F.max_by("seasonality_mode", "param_id").alias("last_mode"),
        F.sum("changepoint_prior_scale").alias("sum_changepoint"),
        F.sum(F.col("seasonality_prior_scale") * F.col("param_id")).alias("sum_seasonality"),
    )


@query
def cv_schedule(spark, sf):
    return grid.cv_schedule(training(spark, sf))


@query
def cv_schedule_automatic(spark, sf):
    return grid.cv_schedule(
        training(spark, sf), grid.initial_weeks(F.col("train_weeks"), automatic=True)
    )


def scored_grid(spark, sf):
    """A score for every record by formula, some of them infinite."""
    profile = grid.series_profile(training(spark, sf))
    records = grid.with_manual_record(grid.profiled_grid(profile), profile)
    rows = records.join(profile.select(*KEYS, "n_points"), KEYS)
    mixed = (F.col("param_id") * 37 + F.col("n_points") * 11) % 101
    failed = F.col("param_id") % 10 == 7
    return rows.select(
        *KEYS,
        "param_id",
        *PARAMETERS,
        F.when(failed, float("inf")).otherwise(mixed / 101.0).alias("smape"),
        F.when(failed, float("inf"))
        .otherwise((F.col("param_id") * 53 + F.col("n_points")) % 211 / 10.0)
        .alias("mae"),
    )


@query
def best_params(spark, sf):
    return tuning.best_params(scored_grid(spark, sf))


@query
def param_impact(spark, sf):
    return tuning.param_impact(scored_grid(spark, sf))


@query
def param_scatter(spark, sf):
    return tuning.param_scatter(scored_grid(spark, sf))


@query
def tuned_beside_manual(spark, sf):
    return tuning.tuned_beside_manual(scored_grid(spark, sf))


@query
def params_with_overrides(spark, sf):
    """Hand-picked values for the series of one unit replace the tuned ones."""
    best = tuning.best_params(scored_grid(spark, sf))
    chosen = {**{p: F.lit(None) for p in PARAMETERS}, "changepoint_prior_scale": F.lit(0.5)}
    overrides = best.where(F.col("Unit") == "ASIA").select(
        *KEYS, *[chosen[p].cast(best.schema[p].dataType).alias(p) for p in PARAMETERS]
    )
    return tuning.with_overrides(best, overrides)


# --- forecasts ----------------------------------------------------------------------------


@query
def recursive_ar1_forecast(spark, sf):
    """Four weeks of ``intercept + slope * lag``, each forecast being the next week's lag."""
    held = stored(split(spark, sf))
    steps = regressors.future_weeks(held)
    ahead = forecasting.iterative_forecast(lag_models(held.where("is_train")), steps)
    return ahead.join(steps, [*KEYS, "ds"]).select(*KEYS, "step", "ds", "yhat")


def lag_models(train, others=0):
    """Model rows by formula: a straight line on the week before, and no other effect.

    ``others`` regressors stand before the lag.
    """
    nothing = F.array_repeat(F.lit(0.0), design.REGRESSORS_AT + others)
    empty = F.array().cast("array<double>")
    line = train.groupBy(*KEYS).agg(
        F.regr_slope("y", "y_lag1").alias("_slope"),
        F.regr_intercept("y", "y_lag1").alias("offset"),
        F.max_by("y", "ds").alias("last_y"),
        F.max("ds").alias("last_week"),
        F.min("ds").alias("t0"),
    )
    return line.select(
        *KEYS, "offset", "last_y", "last_week", "t0",
        F.lit(7.0).alias("t_span"), F.lit(1.0).alias("y_scale"), F.lit(0.0).alias("slope"),
        empty.alias("knots"), empty.alias("deltas"),
        F.concat(nothing, F.array("_slope")).alias("beta"),
        F.array_repeat(F.lit(0.0), others + 1).alias("centers"),
        F.array_repeat(F.lit(1.0), others + 1).alias("scales"),
        F.lit(0.5).alias("sigma"), F.lit("additive").alias("seasonality_mode"),
        F.lit(fitting.NATURAL).alias("target_scale"), F.lit("sunday").alias("holiday_match"),
        F.lit("day").alias("weather_grain"), F.lit(weekly.SUCCESS).alias("status"),
    )


@query
def sampled_intervals(spark, sf):
    """The same line with two bends: bounds are quantiles of 1,000 simulated paths a series."""
    held = stored(split(spark, sf))
    bent = {
        "t_span": F.datediff("last_week", "t0").cast("double"),
        "knots": F.array(F.lit(0.25), F.lit(0.75)),
        "deltas": F.array(F.lit(40.0), F.lit(-20.0)),
        "sigma": F.lit(2.0),
    }
    models = lag_models(held.where("is_train")).withColumns(bent)
    return forecasting.iterative_forecast(models, regressors.future_weeks(held), paths=intervals.PATHS)


@query
def lag_model_components(spark, sf):
    """Components of the given lag models: the line's constant, and what the lag adds to it."""
    held = stored(split(spark, sf).select(*KEYS, "ds", "y", "y_lag1", "is_train", "train_end"))
    steps = regressors.future_weeks(held)
    parts = forecasting.fitted_components(lag_models(held.where("is_train")), held, steps)
    return parts.select(*KEYS, "ds", "step", "trend", "extra_regressors", "yhat", "yhat_upper")


@query
def lag_model_job(spark, sf):
    """The weekly job with given lag models, from the latest actuals."""
    rows = stored(features(spark, sf).select(*KEYS, "ds", "y", "y_lag1", *PROMO))
    models = lag_models(weekly.split_holdout(rows).where("is_train"), len(PROMO))
    return forecasting.weekly_job(models, rows, AS_OF)


@query
def fit_optimality(spark, sf):
    """How far the stored coefficients are from a mode: gradients computed from them alone."""
    held = stored(split(spark, sf))
    models = stored(fitting.fit_models(held, manual_params(held)))
    return fitting.optimality(models, held).select(
        *KEYS, "weeks", (F.col("slope").between(-1e-5, 1e-5)).alias("at_mode")
    )


def manual_params(split_rows):
    return split_rows.select(*KEYS).distinct().select(
        *KEYS, *[F.lit(v).alias(p) for p, v in grid.MANUAL_RECORD.items()]
    )


def fitted(spark, sf):
    """Weekly rows with holdout flags, models fitted to them, and their future weeks."""
    held = stored(split(spark, sf))
    models = fitting.fit_models(held, manual_params(held))
    return held, models, regressors.future_regressors(held, weekly_outlook(spark, sf))


@query
def model_features(spark, sf):
    """Scaled time and the feature vector of every training week."""
    rows = design.design(training(spark, sf), KEYS)
    features_ = [F.col("x")[i].alias(f"x_{i}") for i in range(design.REGRESSORS_AT + 7)]
    return rows.select(*KEYS, "ds", "weeks", "y_scale", "t", *features_)


@query
def changepoints(spark, sf):
    """Scaled times of the possible trend changes, per series and changepoint range."""
    counted = training(spark, sf).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("weeks"))
    ranges = F.explode(F.array(*[F.lit(v) for v in grid.DEFAULT_GRID["changepoint_range"]]))
    placed = counted.select(*KEYS, "weeks", ranges.alias("changepoint_range")).select(
        *KEYS,
        "changepoint_range",
        F.posexplode(design.knots(F.col("weeks"), F.col("changepoint_range"))).alias("i", "t"),
    )
    return placed


@query
def fit_models(spark, sf):
    _, models, _ = fitted(spark, sf)
    plain = [f.name for f in models.schema.fields if f.dataType.typeName() != "array"]
    return models.select(*plain, F.size("knots").alias("changepoints"))


@query
def iterative_forecast(spark, sf):
    _, models, future_rows = fitted(spark, sf)
    return forecasting.iterative_forecast(models, future_rows)


@query
def fitted_components(spark, sf):
    held, models, future_rows = fitted(spark, sf)
    return forecasting.fitted_components(stored(models), held, future_rows)


@query
def model_metrics(spark, sf):
    """Holdout accuracy of the fitted models."""
    held, models, future_rows = fitted(spark, sf)
    forecast = forecasting.iterative_forecast(models, future_rows)
    return evaluate.score(evaluate.forecast_vs_actual(held.where(~F.col("is_train")), forecast))


@query
def weekly_forecast_job(spark, sf):
    """Stored models forecast four weeks from the latest actuals."""
    held, models, _ = fitted(spark, sf)
    return forecasting.weekly_job(models, held.select(*KEYS, "ds", "y", "y_lag1", *PROMO, *WEATHER), AS_OF)


@query
def retrained_models(spark, sf):
    """The series with the worst naive forecast get new models; the newest one counts."""
    held = stored(split(spark, sf))
    naive = evaluate.score(
        evaluate.forecast_vs_actual(held.where(~F.col("is_train")), evaluate.naive_forecast(held))
    )
    params = manual_params(held)
    old = fitting.fit_models(held, params).withColumn("trained_at", F.lit("2001-11-04").cast("timestamp"))
    new = batch.retrain(held, naive.where("WAPE > 1"), params)
    versions = old.unionByName(new.withColumn("trained_at", F.lit("2001-11-11").cast("timestamp")))
    return latest_models(versions).select(*KEYS, "trained_at", "status", "sigma", "slope", "weeks")


@query
def record_scores(spark, sf):
    """Given held-out predictions, one record with an error, through the scoring of records."""
    held = naive_comparison(spark, sf)
    records = grid.given_grid(held.select(*KEYS).distinct(), {
        **{p: [v] for p, v in grid.MANUAL_RECORD.items()}, "changepoint_range": [0.8, 0.9, 0.95],
    })
    tried = held.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("param_id"))
    broken = F.when((F.col("param_id") == 1) & (F.col("Unit") == "ASIA"), "failed")
    tried = tried.withColumn("yhat", F.col("yhat") * (F.col("param_id") + 1)).withColumn("error", broken)
    scored = tuning.score_records(tried, records)
    return scored.select(*KEYS, "param_id", "changepoint_range", "mae", "rmse", "smape", "error")


@query
def tuning_results(spark, sf):
    """Cross-validation scores of the whole grid of every series."""
    train = stored(training(spark, sf))
    records = grid.profiled_grid(grid.series_profile(train))
    return tuning.tune(train, records, grid.cv_schedule(train))


def small_grid(series):
    """Eight records a series, for queries that compare two ways to their scores."""
    lists = {
        "changepoint_prior_scale": [0.05, 0.5], "seasonality_prior_scale": [0.1, 10.0],
        "holidays_prior_scale": [0.1], "seasonality_mode": ["additive", "multiplicative"],
        "changepoint_range": [0.8],
    }
    return grid.given_grid(series, lists)


@query
def tuning_check(spark, sf):
    """Scores that tuning reports beside those recomputed in SQL from stored predictions."""
    train = stored(training(spark, sf))
    records = stored(small_grid(train.select(*KEYS).distinct()))
    folds = grid.cv_schedule(train)
    predictions = stored(fitting.held_out_predictions(train, records, folds))
    again = spark.sql(
        """
        SELECT SKU_ID, Channel, Unit, param_id, count(*) AS weeks, max(error) AS failure,
               avg(abs(y - yhat)) AS mae2, sqrt(avg(power(y - yhat, 2))) AS rmse2,
               avg(if(abs(y) + abs(yhat) > 0, 2 * abs(y - yhat) / (abs(y) + abs(yhat)), 0)) AS smape2
        FROM {held} GROUP BY ALL
        """,
        held=predictions,
    )

    def same(a, b):
        near = F.abs(F.col(a) - F.col(b)) <= 1e-6 * (1 + F.abs(b))
        return F.when(F.col("failure").isNotNull(), F.col(a) == float("inf")).otherwise(near)

    both = tuning.tune(train, records, folds).join(again, [*KEYS, "param_id"])
    agrees = same("mae", "mae2") & same("rmse", "rmse2") & same("smape", "smape2")
    return both.select(*KEYS, "param_id", "weeks", agrees.alias("agrees"))


@query
def rolling_origin_fits(spark, sf):
    """Fitted models rolled over all origins; their scores again in SQL from stored predictions."""
    train = stored(training(spark, sf))
    folds = grid.cv_schedule(train, grid.initial_weeks(F.col("train_weeks"), automatic=True))
    held = stored(rolling.rolling_predictions(train, manual_params(train), folds))
    again = spark.sql(
        """
        SELECT SKU_ID, Channel, Unit, count(*) AS folds2, sum(weeks) AS weeks, avg(mae) AS mae2,
               stddev_samp(mae) AS spread2, count_if(failed) AS failed
        FROM (SELECT SKU_ID, Channel, Unit, fold, count(*) AS weeks, avg(abs(y - yhat)) AS mae,
                     bool_or(error IS NOT NULL) AS failed
              FROM {held} GROUP BY ALL)
        GROUP BY ALL
        """,
        held=held,
    )
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 1e-6 * (1 + F.abs(b))
    both = monitoring.rolling_origin(held).join(again, KEYS)
    agrees = near("mean_MAE", "mae2") & near("std_MAE", "spread2") & (F.col("folds") == F.col("folds2"))
    return both.select(*KEYS, "folds", "weeks", "failed", agrees.alias("agrees"))


@query
def ensemble_of_records(spark, sf):
    """Holdout forecasts of the three best records by cross-validation, weighted by its errors."""
    held = stored(split(spark, sf))
    train = held.where("is_train")
    records = small_grid(train.select(*KEYS).distinct())
    best = stored(rolling.top_records(tuning.tune(train, records, grid.cv_schedule(train))))
    future_rows = regressors.future_regressors(held, weekly_outlook(spark, sf))
    forecasts = stored(rolling.member_forecasts(held, best, future_rows))
    again = spark.sql(
        """
        SELECT SKU_ID, Channel, Unit, ds, sum(weight * yhat) AS yhat2, sum(weight) AS weight_sum,
               min(yhat) AS low, max(yhat) AS high
        FROM {forecasts} JOIN {best} USING (SKU_ID, Channel, Unit, member) GROUP BY ALL
        """,
        forecasts=forecasts,
        best=best,
    )
    both = monitoring.ensemble(forecasts, best).join(again, [*KEYS, "ds"])
    tiny = 1e-6 * (1 + F.abs("yhat"))
    agrees = (F.abs(F.col("yhat") - F.col("yhat2")) <= tiny) & F.col("yhat").between(
        F.col("low") - tiny, F.col("high") + tiny
    )
    return both.select(*KEYS, "ds", "members", "weight_sum", agrees.alias("agrees"))


@query
def regressor_neighbours(spark, sf):
    return quality.regressor_neighbours(features(spark, sf))


@query
def run_results(spark, sf):
    """The whole run over the listed series: profiled grids, 16 days of weather forecast."""
    run = batch.run_batch(
        given.sales(spark, sf),
        series_list.normalise_series_list(given.series_list(spark, sf)),
        given.weather(spark, sf),
        weather.limit_forecast(given.weather(spark, sf), "2001-10-20", 16),
    )
    return run.results


@query
def resumed_run(spark, sf):
    """A run over one unit, gone on over all: attempts, and metrics again in SQL from stored rows."""
    listed = series_list.normalise_series_list(given.series_list(spark, sf))
    absent = F.lit("absent").alias("SKU_ID"), F.lit("BUILDING").alias("Channel"), F.col("Unit")
    listed = stored(listed.union(listed.select(*absent).distinct()))
    folder = fresh_path(spark, "run")
    options = {"param_grid": {p: [v] for p, v in grid.MANUAL_RECORD.items()}, "chunks": 2}
    resume.run_resumable(given.sales(spark, sf), listed.where("Unit = 'ASIA'"), folder, **options)
    results = resume.run_resumable(given.sales(spark, sf), listed, folder, **options)
    again = spark.sql(
        """
        SELECT SKU_ID, Channel, Unit, avg(abs(y - yhat)) AS MAE2, sqrt(avg(power(y - yhat, 2))) AS RMSE2,
               avg(if(abs(y) + abs(yhat) > 0, 2 * abs(y - yhat) / (abs(y) + abs(yhat)), 0)) AS sMAPE2,
               if(sum(abs(y)) > 0, sum(abs(y - yhat)) / sum(abs(y)), double('infinity')) AS WAPE2,
               bool_and(yhat BETWEEN yhat_lower AND yhat_upper) AS inside
        FROM {comparison} GROUP BY ALL
        """,
        comparison=resume.rows_of(spark, folder, "comparison"),
    )
    agrees = F.coalesce(F.col("inside"), F.lit(True))
    for m in METRICS:
        # Both missing, both infinite, or equal to the four places that results have.
        near = F.col(m).eqNullSafe(F.col(f"{m}2")) | (F.abs(F.col(m) - F.col(f"{m}2")) < 1e-4)
        agrees = agrees & F.coalesce(near, F.lit(False))
    return results.join(again, KEYS, "left").select(*KEYS, "Status", "attempt", agrees.alias("agrees"))


# --- quality and features -----------------------------------------------------------------


@query
def outliers_mad(spark, sf):
    rows = quality.outliers(weekly.weekly_features(daily(spark, sf)))
    return rows.select(*KEYS, "ds", "y", "y_original", "is_outlier")


@query
def rolling_features(spark, sf):
    return quality.rolling_features(features(spark, sf)).drop(
        "Promo_discount_perc", "is_promo", *WEATHER
    )


@query
def weather_extremes(spark, sf):
    sold = town_daily(spark, sf).select("ds").distinct()
    return quality.weekly_extremes(given.weather(spark, sf).join(sold, "ds", "left_semi"))


@query
def regressor_correlation(spark, sf):
    return quality.regressor_correlation(features(spark, sf))


@query
def regressor_information(spark, sf):
    return quality.regressor_information(features(spark, sf))


@query
def regressor_selection(spark, sf):
    return quality.regressor_selection(stored(features(spark, sf))).select(*KEYS, "regressor", "keep")


@query
def seasonality_mode(spark, sf):
    return quality.seasonality_mode(weekly.weekly_features(daily(spark, sf)))


@query
def dow_profile(spark, sf):
    return quality.day_of_week_profile(daily(spark, sf))


@query
def quality_report(spark, sf):
    return quality.quality_report(weekly.weekly_cells(town_daily(spark, sf)))


@query
def log_scale_target(spark, sf):
    """The optional log scale of the target and its inverse."""
    rows = weekly.weekly_features(daily(spark, sf))
    logged = numeric.to_log_scale(F.col("y"))
    return rows.select(
        *KEYS, "ds", logged.alias("y_log"), numeric.from_log_scale(logged).alias("y_back")
    )


# --- monitoring ---------------------------------------------------------------------------


def stored_forecasts(spark, sf):
    """Every week forecast by the one before, as rows of the forecast table."""
    rows = weekly.weekly_features(daily(spark, sf))
    return rows, rows.select(
        *KEYS,
        F.date_sub("ds", 7).alias("forecast_date"),
        F.col("ds").alias("target_date"),
        F.col("y_lag1").alias("predicted_quantity"),
    )


def matched(spark, sf):
    rows, table = stored_forecasts(spark, sf)
    return monitoring.forecasts_beside_actuals(table, rows)


@query
def forecasts_beside_actuals(spark, sf):
    return matched(spark, sf)


@query
def monitor_long(spark, sf):
    return monitoring.metrics_long(matched(spark, sf), AS_OF)


@query
def metric_trend(spark, sf):
    return monitoring.metric_trend(matched(spark, sf), ["Unit"])


@query
def worst_models(spark, sf):
    return monitoring.worst_models(evaluate.score(naive_comparison(spark, sf)))


@query
def alerts(spark, sf):
    return monitoring.alerts(monitoring.weekly_scores(matched(spark, sf)))


@query
def score_issues(spark, sf):
    comparison = matched(spark, sf).select(*KEYS, F.col("target_date").alias("ds"), "y", "yhat")
    return monitoring.score_issues(comparison)


@query
def success_criteria(spark, sf):
    scores = evaluate.score(matched(spark, sf).withColumn("ds", F.col("target_date")))
    return monitoring.success_criteria(scores)


def members(held):
    """Three simple forecasts of the holdout: last week, four weeks' mean, training mean."""
    order = weekly.series_window("ds").rowsBetween(-4, -1)
    mean = F.avg(F.when(F.col("is_train"), F.col("y"))).over(weekly.series_window())
    rows = held.select(
        *KEYS,
        "ds",
        "is_train",
        F.col("y_lag1").alias("last"),
        F.avg("y").over(order).alias("four"),
        mean.alias("level"),
    )
    return rows.where(~F.col("is_train")).unpivot(
        [*KEYS, "ds"], ["last", "four", "level"], "member", "yhat"
    )


@query
def ensemble(spark, sf):
    return monitoring.ensemble(members(split(spark, sf)))


@query
def ensemble_weighted(spark, sf):
    """Members weighted by one over their training error."""
    held = split(spark, sf)
    rows = held.where("is_train")
    mean = F.avg("y").over(weekly.series_window())
    four = F.avg("y").over(weekly.series_window("ds").rowsBetween(-4, -1))
    errors = rows.select(
        *KEYS,
        F.abs(F.col("y") - F.col("y_lag1")).alias("last"),
        F.abs(F.col("y") - F.coalesce(four, F.lit(0.0))).alias("four"),
        F.abs(F.col("y") - mean).alias("level"),
    )
    weights = (
        errors.unpivot(KEYS, ["last", "four", "level"], "member", "error")
        .groupBy(*KEYS, "member")
        .agg((1.0 / (1.0 + F.avg("error"))).alias("weight"))
    )
    return monitoring.ensemble(members(held), weights)


@query
def rolling_origin(spark, sf):
    train = training(spark, sf)
    folds = grid.cv_schedule(train, grid.initial_weeks(F.col("train_weeks"), automatic=True))
    return monitoring.rolling_origin(evaluate.naive_by_fold(train, folds))
