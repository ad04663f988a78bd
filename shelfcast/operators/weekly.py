"""Weekly series: resample, gap fill, lag, sufficiency gate and holdout split.

The sales lines are shuffled once, after a map-side aggregate to (series, week) cells, so a
series that holds a third of all lines costs no task more than its number of weeks.  All
later steps work on cells, whose number per series is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.dates import closing_sunday, span_days, week_series
from shelfcast.schemas import LAG, PROMO, SERIES, TEMPERATURES, WEATHER
from shelfcast.sources.weather import weekly_weather

#: Days of history asked for beyond the holdout, weeks needed to train,
#: days of training that switch yearly seasonality on, days held out.
EXTRA_DAYS = 28
MIN_TRAIN_WEEKS = 10
YEARLY_FROM_DAYS = 365
VALIDATION_DAYS = 14

# Status texts of the run result.
NO_DATA = "Error: No Data"
SHORT_DATA = "Skipped: Insufficient Data"
SHORT_TRAIN = "Skipped: Insufficient Training Data"
FAILED = "Error: Processing Failed"
SUCCESS = "Success"


def series_window(*order_by: str):
    window = Window.partitionBy(*SERIES)
    return window.orderBy(*order_by) if order_by else window


def join_daily_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily weather beside every sales row; a day without weather counts as 0."""
    present = [c for c in WEATHER if c in weather.columns]
    days = weather.select("ds", *present)
    return daily.join(days, "ds", "left").fillna(0.0, subset=present)


def weekly_cells(
    daily: DataFrame, weather: DataFrame | None = None, weather_grain: str = "day"
) -> DataFrame:
    """One row per series and week that has any sales row.

    Negative rows count for the date range (``first_day``, ``last_day``) but not for the
    measures; ``kept_rows`` is 0 where a week has nothing else.

    ``weather_grain='day'`` adds each week's weather once.  ``'row'`` weighs it by sales rows:
    a day's rain then counts as often as the day has rows, and days without sales not at all.
    """
    if weather_grain not in ("day", "row"):
        raise ValueError("weather_grain is 'day' or 'row'")
    by_row = weather is not None and weather_grain == "row"
    rows = join_daily_weather(daily, weather) if by_row else daily
    kept = F.col("y") >= 0

    def of_kept(name: str) -> Column:
        return F.when(kept, F.col(name))

    weather_measures = []
    if by_row:
        weather_measures = [
            (F.avg if c in TEMPERATURES else F.sum)(of_kept(c)).alias(c)
            for c in WEATHER
            if c in weather.columns
        ]
    cells = rows.groupBy(*SERIES, closing_sunday(F.col("ds")).alias("week")).agg(
        F.sum(of_kept("y")).alias("y"),
        F.avg(of_kept("Promo_discount_perc")).alias("Promo_discount_perc"),
        F.max(of_kept("is_promo")).cast("double").alias("is_promo"),
        *weather_measures,
        F.count(of_kept("y")).alias("kept_rows"),
        F.count(F.lit(1)).alias("rows"),
        F.min("ds").alias("first_day"),
        F.max("ds").alias("last_day"),
    )
    if weather is not None and not by_row:
        # Grouped by week: one row per calendar week, whatever the weather table holds.
        by_week = weekly_weather(weather).withColumnRenamed("ds", "week")
        cells = cells.join(F.broadcast(by_week), "week", "left")
    return cells


def measures(cells: DataFrame) -> list[str]:
    return ["y", *PROMO, *[c for c in WEATHER if c in cells.columns]]


def present_weeks(cells: DataFrame) -> DataFrame:
    """The weeks that have sales, before gaps are filled."""
    return cells.where("kept_rows > 0").select(
        *SERIES, F.col("week").alias("ds"), *measures(cells)
    )


def fill_weeks(cells: DataFrame) -> DataFrame:
    """Every week from the first to the last, gaps with 0 in all measures, plus ``y_lag1``.

    Each week generates itself and the empty weeks up to the next one, so neither a date
    spine nor a join back to it is needed, and the lag comes from the same window.
    """
    names = measures(cells)
    order = series_window("week")
    known = cells.where("kept_rows > 0").select(
        *SERIES,
        "week",
        *names,
        F.lead("week").over(order).alias("_next"),
        F.lag("week").over(order).alias("_previous"),
        F.lag("y").over(order).alias("_previous_y"),
    )
    until = F.coalesce(F.date_sub("_next", 7), F.col("week"))
    spread = known.withColumn("ds", F.explode(week_series(F.col("week"), until)))
    observed = F.col("ds") == F.col("week")
    adjacent = F.col("_previous") == F.date_sub("week", 7)
    lag = (
        F.when(observed, F.when(adjacent, F.col("_previous_y")).otherwise(0.0))
        .when(F.col("ds") == F.date_add("week", 7), F.col("y"))
        .otherwise(0.0)
    )
    return spread.select(
        *SERIES,
        "ds",
        *[F.when(observed, F.coalesce(F.col(c), F.lit(0.0))).otherwise(0.0).alias(c) for c in names],
        F.coalesce(lag, F.lit(0.0)).alias(LAG),
    )


def weekly_features(
    daily: DataFrame, weather: DataFrame | None = None, weather_grain: str = "day"
) -> DataFrame:
    """Daily rows to gap-free weekly features."""
    return fill_weeks(weekly_cells(daily, weather, weather_grain))


def date_range(daily: DataFrame) -> DataFrame:
    """First and last day and number of rows per series, returns included."""
    return daily.groupBy(*SERIES).agg(
        F.min("ds").alias("min_date"),
        F.max("ds").alias("max_date"),
        F.count(F.lit(1)).alias("rows"),
    )


def line_cells(daily: DataFrame) -> DataFrame:
    """Every sales row as a cell of its own, for :func:`series_gate` and :func:`series_status`.

    Where a series has few rows a week, adding them up first would only shuffle them once more.
    """
    return daily.select(
        *SERIES,
        closing_sunday(F.col("ds")).alias("week"),
        F.when(F.col("y") >= 0, 1).otherwise(0).cast("bigint").alias("kept_rows"),
        F.col("ds").alias("first_day"),
        F.col("ds").alias("last_day"),
    )


def series_gate(
    cells: DataFrame, validation_days: int = VALIDATION_DAYS, *more: Column
) -> DataFrame:
    """Per series: date range, days spanned, and whether that is enough to go on.

    ``more`` are further aggregates of the cells.
    """
    needed = validation_days + EXTRA_DAYS
    ranged = cells.groupBy(*SERIES).agg(
        F.min("first_day").alias("min_date"),
        F.max("last_day").alias("max_date"),
        F.sum("kept_rows").alias("kept_rows"),
        *more,
    )
    span = span_days(F.col("min_date"), F.col("max_date"))
    return ranged.withColumn("span_days", span).withColumn(
        "status",
        F.when(F.col("span_days") < needed, F.lit(SHORT_DATA)).when(
            F.col("kept_rows") == 0, F.lit(FAILED)
        ),
    )


def series_status(cells: DataFrame, validation_days: int = VALIDATION_DAYS) -> DataFrame:
    """What the data gate and the training gate say about each series.

    The weeks between the first and the last are counted and not generated: series of single
    customers have few cells, and years of empty weeks between them.  As in a join by the keys,
    the training gate says nothing about a series with a missing key.
    """
    week = F.when(F.col("kept_rows") > 0, F.col("week"))
    gate = series_gate(
        cells, validation_days, F.min(week).alias("_first"), F.max(week).alias("_last")
    )
    held_weeks = max((validation_days - 1) // 7 + 1, 0)
    train_weeks = F.datediff("_last", "_first") / 7 + 1 - held_weeks
    named = F.concat(*SERIES).isNotNull()
    short = F.when(named & (train_weeks < MIN_TRAIN_WEEKS), F.lit(SHORT_TRAIN))
    return gate.select(*SERIES, F.coalesce("status", short, F.lit(SUCCESS)).alias("Status"))


def split_holdout(weekly: DataFrame, validation_days: int = VALIDATION_DAYS) -> DataFrame:
    """Flag training weeks and describe the training part on every row of its series.

    Adds ``last_week``, ``validation_start``, ``is_train``, ``train_weeks``, ``train_end`` and
    ``yearly``.
    """
    whole = series_window()
    train_day = F.when(F.col("is_train"), F.col("ds"))
    return (
        weekly.withColumn("last_week", F.max("ds").over(whole))
        .withColumn("validation_start", F.date_sub("last_week", validation_days - 1))
        .withColumn("is_train", F.col("ds") < F.col("validation_start"))
        .withColumn("train_weeks", F.count(train_day).over(whole))
        .withColumn("train_end", F.max(train_day).over(whole))
        .withColumn(
            "yearly",
            F.coalesce(
                F.datediff("train_end", F.min(train_day).over(whole)) >= YEARLY_FROM_DAYS,
                F.lit(False),
            ),
        )
    )


def prepared_training(
    split: DataFrame, prepare: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``split`` with ``prepare`` applied to its training weeks, and the lag of every week anew.

    Held-out weeks keep their actuals, and nothing is learned from them.
    """
    both = prepare(split.where("is_train")).unionByName(
        split.where(~F.col("is_train")), allowMissingColumns=True
    )
    return both.withColumn(LAG, F.coalesce(F.lag("y").over(series_window("ds")), F.lit(0.0)))


def split_summary(split: DataFrame) -> DataFrame:
    """One row per series: holdout start, week counts, yearly switch, training gate."""
    return (
        split.groupBy(*SERIES)
        .agg(
            F.first("validation_start").alias("validation_start"),
            F.first("train_weeks").alias("train_weeks"),
            (F.count(F.lit(1)) - F.first("train_weeks")).alias("validation_weeks"),
            F.first("yearly").alias("yearly"),
        )
        .withColumn(
            "status", F.when(F.col("train_weeks") < MIN_TRAIN_WEEKS, F.lit(SHORT_TRAIN))
        )
    )
