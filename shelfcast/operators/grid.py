"""Parameter grids and cross-validation schedules, one row per series and record or fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.schemas import PARAMETERS, SERIES

# The default grid, and what replaces parts of it for difficult series.
DEFAULT_GRID = {
    "changepoint_prior_scale": [0.01, 0.05, 0.1, 0.5, 1.0],
    "seasonality_prior_scale": [0.01, 0.1, 1.0, 5.0, 10.0, 20.0],
    "holidays_prior_scale": [0.01, 0.1, 1.0, 5.0, 10.0],
    "seasonality_mode": ["additive", "multiplicative"],
    "changepoint_range": [0.8, 0.9, 0.95],
}
MANY_ZEROS_SEASONALITY = [0.01, 0.1, 1.0, 5.0]
SHORT_SERIES_CHANGEPOINTS = [0.001, 0.01, 0.05, 0.1]
VARIABLE_MODES = ["multiplicative", "additive"]

# A record known to work well by hand.
MANUAL_RECORD = {
    "changepoint_prior_scale": 0.5,
    "seasonality_prior_scale": 10.0,
    "holidays_prior_scale": 0.1,
    "seasonality_mode": "multiplicative",
    "changepoint_range": 0.8,
}

#: Order in which the records are numbered: the last one varies fastest.
NUMBERING = [
    "changepoint_prior_scale",
    "changepoint_range",
    "holidays_prior_scale",
    "seasonality_mode",
    "seasonality_prior_scale",
]

PERIOD_WEEKS = 2
HORIZON_WEEKS = 2


def series_profile(train: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Coefficient of variation, share of zeros and number of points of each series."""
    mean = F.avg("y")
    return train.groupBy(*(by or SERIES)).agg(
        F.when(mean > 0, F.stddev_samp("y") / mean).otherwise(0.0).alias("cv"),
        F.avg((F.col("y") == 0).cast("double")).alias("zero_share"),
        F.count(F.lit(1)).alias("n_points"),
    )


def _array(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def expand_grid(series: DataFrame, choices: dict[str, Column], carry: list[str]) -> DataFrame:
    """One row per series and combination of the chosen arrays, numbered by ``param_id``."""
    out = series.select(*carry, F.lit(0).alias("param_id"), *[
        choices[name].alias(f"_{name}") for name in NUMBERING
    ])
    done: list[str] = []
    for name in NUMBERING:
        rest = [f"_{n}" for n in NUMBERING if n not in (*done, name)]
        out = out.select(
            *carry,
            "param_id",
            *done,
            *rest,
            F.size(f"_{name}").alias("_n"),
            F.posexplode(f"_{name}").alias("_i", name),
        ).withColumn("param_id", F.col("param_id") * F.col("_n") + F.col("_i"))
        done.append(name)
    return out.select(*carry, "param_id", *PARAMETERS)


def default_grid(series: DataFrame) -> DataFrame:
    """The full grid for every series."""
    return expand_grid(series, {n: _array(v) for n, v in DEFAULT_GRID.items()}, SERIES)


def profiled_grid(profile: DataFrame) -> DataFrame:
    """The grid fitted to each series' profile.

    High variability only changes the order of the modes; many zeros and short histories ask
    for stronger regularisation and swap in other priors.
    """
    choices = {n: _array(v) for n, v in DEFAULT_GRID.items()}
    choices["seasonality_mode"] = F.when(
        F.col("cv") > 0.5, _array(VARIABLE_MODES)
    ).otherwise(choices["seasonality_mode"])
    choices["seasonality_prior_scale"] = F.when(
        F.col("zero_share") > 0.3, _array(MANY_ZEROS_SEASONALITY)
    ).otherwise(choices["seasonality_prior_scale"])
    choices["changepoint_prior_scale"] = F.when(
        F.col("n_points") < 30, _array(SHORT_SERIES_CHANGEPOINTS)
    ).otherwise(choices["changepoint_prior_scale"])
    return expand_grid(profile, choices, SERIES)


def given_grid(series: DataFrame, grid: dict[str, list]) -> DataFrame:
    """A grid of the caller's choice for every series."""
    return expand_grid(series, {n: _array(grid[n]) for n in PARAMETERS}, SERIES)


def with_manual_record(grid: DataFrame, series: DataFrame) -> DataFrame:
    """The grid plus the hand-picked record, numbered -1."""
    manual = series.select(
        *SERIES,
        F.lit(-1).alias("param_id"),
        *[F.lit(MANUAL_RECORD[p]).alias(p) for p in PARAMETERS],
    )
    return grid.unionByName(manual)


def initial_weeks(weeks: Column, automatic: bool = False) -> Column:
    """Weeks before the first fold: all but four, or 70 % of them (12 at least) if automatic."""
    if automatic:
        return F.greatest(
            F.floor(weeks * 0.7).cast("int"), F.least(F.lit(12), (weeks - 4).cast("int"))
        )
    return (weeks - 4).cast("int")


def cv_schedule(
    train: DataFrame,
    initial: Column | None = None,
    period: int = PERIOD_WEEKS,
    horizon: int = HORIZON_WEEKS,
) -> DataFrame:
    """Folds of each series, latest first: train up to ``cutoff``, test ``horizon`` weeks.

    The latest cutoff leaves ``horizon`` weeks; earlier ones follow every ``period`` weeks
    while ``initial`` weeks of history remain.  A series too short for one fold has no row.
    """
    span = train.groupBy(*SERIES).agg(
        F.min("ds").alias("_first"), F.count(F.lit(1)).alias("train_weeks")
    )
    start = initial if initial is not None else initial_weeks(F.col("train_weeks"))
    last = (F.col("train_weeks") - 1 - horizon).cast("int")
    ranged = span.select("*", last.alias("_last"), start.alias("_initial")).where(
        F.col("_last") >= F.greatest(F.col("_initial"), F.lit(0))
    )
    folds = ranged.select(
        *SERIES,
        "_first",
        "_last",
        F.explode(
            F.sequence(F.lit(0), F.expr(f"cast(floor((_last - _initial) / {period}) as int)"))
        ).alias("fold"),
    ).withColumn("cutoff_week", F.col("_last") - F.col("fold") * period)
    return folds.select(
        *SERIES,
        "fold",
        (F.col("cutoff_week") + 1).alias("weeks_before"),
        F.expr("date_add(_first, 7 * cutoff_week)").alias("cutoff"),
        F.expr(f"date_add(_first, 7 * (cutoff_week + {horizon}))").alias("test_end"),
    )
