"""Data quality, outliers, extra features and what they are worth.

Everything works on weekly rows, whose number per series the calendar bounds, except the
day-of-week profile, which pre-aggregates the sales lines.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.durable import spread
from shelfcast.functions.dates import closing_sunday
from shelfcast.schemas import LAG, PROMO, SERIES, TEMPERATURES, WEATHER

# Outlier threshold in MADs, width of the replacing median, selection limits,
# limits of the seasonality rule, length of a seasonal cycle.
OUTLIER_MADS = 3
MEDIAN_WEEKS = 5
MIN_CORRELATION = 0.2
MIN_INFORMATION = 0.05
VARIABLE_FROM = 0.5
SEASONAL_FROM = 0.3
CYCLE = 52

BINS = 8
#: Nearest neighbours of the information estimate.
NEIGHBOURS = 3


def _ordered():
    return Window.partitionBy(*SERIES).orderBy("ds")


def outliers(weekly: DataFrame, threshold: float = OUTLIER_MADS) -> DataFrame:
    """Weeks more than ``threshold`` MADs from the series median, replaced by a rolling median.

    ``y_original`` keeps the value, ``is_outlier`` flags the week.
    """
    whole = Window.partitionBy(*SERIES)
    half = MEDIAN_WEEKS // 2
    near = _ordered().rowsBetween(-half, half)
    off = F.abs(F.col("y") - F.col("_median"))
    marked = (
        weekly.withColumn("_median", F.median("y").over(whole))
        .withColumn("_mad", F.median(off).over(whole))
        .withColumn("is_outlier", off > F.col("_mad") * threshold)
        .withColumn("_near", F.percentile("y", 0.5).over(near))
        .withColumn("y_original", F.col("y"))
    )
    return marked.withColumn(
        "y", F.when(F.col("is_outlier"), F.col("_near")).otherwise(F.col("y"))
    ).drop("_median", "_mad", "_near")


def rolling_features(weekly: DataFrame, lags: int = 4, average: int = 3) -> DataFrame:
    """Several lags of the target, its mean over the weeks before, and lagged weather."""
    order = _ordered()
    added = {f"y_lag{k}": F.coalesce(F.lag("y", k).over(order), F.lit(0.0)) for k in range(1, lags + 1)}
    before = order.rowsBetween(-average, -1)
    added[f"y_mean{average}"] = F.coalesce(F.avg("y").over(before), F.lit(0.0))
    for c in WEATHER:
        if c in weekly.columns:
            added[f"{c}_lag1"] = F.coalesce(F.lag(c).over(order), F.lit(0.0))
    return weekly.withColumns(added)


def weekly_extremes(weather: DataFrame) -> DataFrame:
    """The weekly weather by other aggregates: highest, lowest and mean temperatures."""
    present = [c for c in TEMPERATURES if c in weather.columns]
    aggs = [f(c).alias(f"{c}_{f.__name__}") for c in present for f in (F.max, F.min, F.avg)]
    return weather.groupBy(closing_sunday(F.col("ds")).alias("week")).agg(*aggs).withColumnRenamed(
        "week", "ds"
    )


def _regressors(df: DataFrame) -> list[str]:
    return [c for c in [*PROMO, *WEATHER, LAG] if c in df.columns]


def regressor_correlation(weekly: DataFrame) -> DataFrame:
    """Pearson correlation of each regressor with the target; NULL for a constant one."""
    names = _regressors(weekly)

    def correlation(c: str) -> Column:
        return F.try_divide(F.covar_pop(c, "y"), F.stddev_pop(c) * F.stddev_pop("y"))

    wide = weekly.groupBy(*SERIES).agg(*[correlation(c).alias(c) for c in names])
    return wide.unpivot(SERIES, names, "regressor", "correlation")


def regressor_information(weekly: DataFrame, bins: int = BINS) -> DataFrame:
    """Mutual information of each regressor with the target, in nats, on equal-width bins.

    The bins span each series' own range; a value on an edge belongs to the upper bin, whatever
    the rounding noise.  Counts of the joint cells are all that is shuffled.
    """
    names = _regressors(weekly)
    whole = Window.partitionBy(*SERIES)

    def bin_of(c: str) -> Column:
        low, high = F.min(c).over(whole), F.max(c).over(whole)
        share = (F.col(c) - low) / (high - low)
        return F.when(high > low, F.least(F.floor(F.round(share * bins, 9)), F.lit(bins - 1))).otherwise(
            F.lit(0)
        ).cast("int")

    binned = weekly.select(*SERIES, bin_of("y").alias("_by"), *[bin_of(c).alias(c) for c in names])
    cells = (
        binned.unpivot([*SERIES, "_by"], names, "regressor", "_bx")
        .groupBy(*SERIES, "regressor", "_bx", "_by")
        .agg(F.count(F.lit(1)).cast("double").alias("_n"))
    )
    one = Window.partitionBy(*SERIES, "regressor")
    nx = F.sum("_n").over(one.partitionBy(*SERIES, "regressor", "_bx"))
    ny = F.sum("_n").over(one.partitionBy(*SERIES, "regressor", "_by"))
    n = F.sum("_n").over(one)
    counted = cells.select(*SERIES, "regressor", "_n", nx.alias("_nx"), ny.alias("_ny"), n.alias("_all"))
    term = F.col("_n") / F.col("_all") * F.log(
        F.col("_n") * F.col("_all") / (F.col("_nx") * F.col("_ny"))
    )
    return counted.groupBy(*SERIES, "regressor").agg(F.sum(term).alias("mutual_information"))


INFORMATION_SCHEMA = (
    "SKU_ID string, Channel string, Unit string, regressor string, mutual_information double"
)


def _digamma(top: int) -> np.ndarray:
    """Digamma of 0 to ``top``, for whole numbers a harmonic sum; at 0 unused."""
    return np.concatenate([[0.0], np.cumsum(np.concatenate([[0.0], 1.0 / np.arange(1, top)]))]) - np.euler_gamma


def neighbour_information(x: np.ndarray, y: np.ndarray, neighbours: int) -> float:
    """Mutual information in nats by nearest neighbours, 0 at least.

    Distances are the larger of the two columns', each in units of its standard deviation.  With
    ``r`` the distance to the ``neighbours``-th nearest row, the information is the mean of
    ``digamma(neighbours) + digamma(n) - digamma(nx) - digamma(ny)``, where ``nx`` and ``ny``
    count the rows nearer than ``r`` in one column, the row itself among them.  Where so many
    rows are equal that ``r`` is 0, the number of equal rows stands for ``neighbours`` and
    equality for nearness (Kraskov et al. 2004; ties after Gao et al. 2017).
    """
    n = len(x)
    if n <= neighbours:
        return 0.0
    psi, total = _digamma(n), 0.0
    sx, sy = (s if s > 0 else 1.0 for s in (np.std(x), np.std(y)))
    for low in range(0, n, 512):  # bounded memory, whatever the number of weeks
        rows = slice(low, low + 512)
        dx, dy = np.abs(x[rows, None] - x) / sx, np.abs(y[rows, None] - y) / sy
        both = np.maximum(dx, dy)
        radius = np.partition(both, neighbours, axis=1)[:, neighbours]  # the row itself comes first
        tied = radius == 0
        near = lambda d: np.where(tied, (d == 0).sum(axis=1), (d < radius[:, None]).sum(axis=1))  # noqa: B023, E731
        count = np.where(tied, (both == 0).sum(axis=1), neighbours)
        total += (psi[count] + psi[n] - psi[near(dx)] - psi[near(dy)]).sum()
    return max(0.0, total / n)


def regressor_neighbours(weekly: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Mutual information of each regressor with the target by nearest neighbours, in nats.

    A task takes the weeks of one series, whose number the calendar bounds.  Values are rounded
    to nine places first, so that ties do not hang on rounding noise.  A week without a value of
    the target or of the regressor is left out.
    """
    names = _regressors(weekly)
    rows = weekly.select(*SERIES, *[F.round(c, 9).alias(c) for c in ["y", *names]])

    def inform(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for c in names:
            pair = pdf[["y", c]].dropna().to_numpy(float)
            out.append({k: pdf[k].iloc[0] for k in SERIES} | {
                "regressor": c, "mutual_information": neighbour_information(pair[:, 1], pair[:, 0], neighbours),
            })
        return pd.DataFrame(out)

    return spread(rows, SERIES).groupBy(*SERIES).applyInPandas(inform, INFORMATION_SCHEMA)


def regressor_selection(weekly: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Correlation and information of each regressor, and whether either is enough.

    The information is that of nearest neighbours: counts in equal-width bins come out above the
    limit for columns that have nothing to do with each other.
    """
    both = regressor_correlation(weekly).join(
        regressor_neighbours(weekly, neighbours), [*SERIES, "regressor"]
    )
    keep = (F.coalesce("correlation", F.lit(0.0)) > MIN_CORRELATION) | (
        F.col("mutual_information") > MIN_INFORMATION
    )
    return both.withColumn("keep", keep)


def seasonality_mode(weekly: DataFrame) -> DataFrame:
    """Additive or multiplicative, from the strength of the yearly pattern.

    The pattern is what remains of the series after a centred one-year average (half weights
    at both ends), averaged per week of the cycle.  It needs two full cycles.
    """
    order = _ordered()
    half = CYCLE // 2
    around = order.rowsBetween(-half, half)
    ends = F.lag("y", half).over(order) + F.lead("y", half).over(order)
    full = F.count(F.lit(1)).over(around) == CYCLE + 1
    level = F.when(full, (F.sum("y").over(around) - ends / 2) / CYCLE)
    phased = weekly.select(
        *SERIES,
        "y",
        ((F.row_number().over(order) - 1) % CYCLE).alias("phase"),
        (F.col("y") - level).alias("rest"),
    )
    phases = phased.groupBy(*SERIES, "phase").agg(
        F.avg("rest").alias("season"),
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("s1"),
        F.sum(F.col("y") * F.col("y")).alias("s2"),
    )
    n, s1, s2 = F.sum("n"), F.sum("s1"), F.sum("s2")
    q1, q2 = F.sum(F.col("n") * F.col("season")), F.sum(F.col("n") * F.col("season") * F.col("season"))

    def spread(count: Column, total: Column, squares: Column) -> Column:
        return F.sqrt(
            F.greatest(F.try_divide(squares - total * total / count, count - 1), F.lit(0.0))
        )

    stats = phases.groupBy(*SERIES).agg(
        n.alias("weeks"),
        spread(n, s1, s2).alias("_std"),
        (s1 / n).alias("_mean"),
        spread(n, q1, q2).alias("_season_std"),
    )
    enough = F.col("weeks") >= 2 * CYCLE
    strength = F.when(enough & (F.col("_std") > 0), F.col("_season_std") / F.col("_std"))
    cv = F.when(F.col("_mean") > 0, F.col("_std") / F.col("_mean"))
    multiplicative = (strength > SEASONAL_FROM) & (cv > VARIABLE_FROM)
    return stats.select(
        *SERIES,
        "weeks",
        strength.alias("seasonal_strength"),
        cv.alias("cv"),
        F.when(multiplicative, "multiplicative").otherwise("additive").alias("seasonality_mode"),
    )


def day_of_week_profile(daily: DataFrame) -> DataFrame:
    """Sales per weekday (Sunday is 1) and its share of the series total."""
    by_day = daily.where("y >= 0").groupBy(*SERIES, F.dayofweek("ds").alias("day_of_week")).agg(
        F.sum("y").alias("y"), F.count(F.lit(1)).alias("rows")
    )
    whole = F.sum("y").over(Window.partitionBy(*SERIES))
    return by_day.withColumn("share", F.when(whole > 0, F.col("y") / whole).otherwise(0.0))


def quality_report(cells: DataFrame, min_weeks: int = 52, max_zero_share: float = 0.3) -> DataFrame:
    """Completeness of each series and flags for what looks wrong.

    ``cells`` are the weekly cells, so returns and empty weeks are still visible.
    """
    report = cells.groupBy(*SERIES).agg(
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        F.sum("rows").alias("rows"),
        F.sum(F.col("rows") - F.col("kept_rows")).alias("rows_removed"),
        F.sum((F.col("kept_rows") > 0).cast("bigint")).alias("weeks_with_sales"),
        (F.datediff(F.max("week"), F.min("week")) / 7 + 1).cast("bigint").alias("weeks_spanned"),
    )
    complete = F.col("weeks_with_sales") / F.col("weeks_spanned")
    flags = F.filter(
        F.array(
            F.when(F.col("weeks_spanned") < min_weeks, F.lit("short_history")),
            F.when(1 - complete > max_zero_share, F.lit("many_empty_weeks")),
            F.when(F.col("rows_removed") / F.col("rows") > 0.2, F.lit("many_returns")),
        ),
        lambda f: f.isNotNull(),
    )
    return report.select(
        *SERIES,
        "first_day",
        "last_day",
        "rows",
        "rows_removed",
        "weeks_with_sales",
        "weeks_spanned",
        complete.alias("completeness"),
        F.concat_ws(",", flags).alias("flags"),
    )
