"""Fitted models over many origins, and ensembles of parameter records.

Rolling origins: a series goes to one task once, with the list of its origins, and not once an
origin.  An origin sees a prefix of the weeks; its scaling constants come from running sums over
the series, and its fit starts from the solution of the origin before, which has almost the same
weeks.  Ensembles: the best records of a series by cross-validation, each fitted and forecast,
weighted by what cross-validation says of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.durable import settle, spread
from shelfcast.functions.numeric import is_finite
from shelfcast.operators import fitting
from shelfcast.operators.design import REGRESSORS_AT, design
from shelfcast.operators.forecasting import iterative_forecast
from shelfcast.schemas import PARAMETERS, SERIES

#: Added to an error before it becomes a weight, so that a perfect record does not divide by 0.
LEAST_ERROR = 1e-6


class Prefixes:
    """Scaling constants of every prefix of a series' weeks, from running sums."""

    def __init__(self, days: np.ndarray, y: np.ndarray, raw: np.ndarray):
        self.days, self.y, self.raw = days, y, raw
        self.top = np.maximum.accumulate(np.abs(y))
        # sums of gaps from the first value, so that a constant column has none at all
        gap = raw - raw[:1]
        self.sums, self.squares = gap.cumsum(axis=0), (gap * gap).cumsum(axis=0)
        self.binary = np.logical_and.accumulate((raw == 0) | (raw == 1), axis=0)
        self.constant = np.logical_and.accumulate(gap == 0, axis=0)

    def scaled(self, weeks: int) -> tuple[np.ndarray, ...]:
        """Scaled time and regressors of all rows, and the target's scale, as ``weeks`` give them."""
        last = weeks - 1
        span = max(self.days[last] - self.days[0], 1.0)
        mean = self.sums[last] / weeks
        spread_ = np.maximum(self.squares[last] - weeks * mean * mean, 0.0) / max(1, weeks - 1)
        plain = self.binary[last] | self.constant[last]
        center = np.where(plain, 0.0, self.raw[0] + mean)
        scale = np.where(plain, 1.0, np.sqrt(spread_))
        top = self.top[last]
        return (self.days - self.days[0]) / span, (self.raw - center) / scale, top if top > 0 else 1.0


def _origins(pdf: pd.DataFrame, packed: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Predictions of each origin's test weeks, shortest history first."""
    one = packed.iloc[0]
    mode = one["seasonality_mode"] == "multiplicative"
    x = np.stack(pdf["x"].to_numpy()).astype(float)
    first = pdf.iloc[0]
    raw = x[:, REGRESSORS_AT:] * np.asarray(first["scales"], float) + np.asarray(first["centers"], float)
    days = np.rint(pdf["t"].to_numpy(float) * float(first["t_span"]))
    y, ds = pdf["y"].to_numpy(float), pdf["ds"]
    prefixes, before = Prefixes(days, y, raw), None
    for origin in sorted(one["origins"], key=lambda o: o["weeks_before"]):
        weeks = int(origin["weeks_before"])
        test = np.flatnonzero((np.arange(len(y)) >= weeks) & (ds <= origin["test_end"]).to_numpy())
        error = None
        try:
            t, regressors, top = prefixes.scaled(weeks)
            trend = fitting._trend(t, fitting._knots(weeks, one["changepoint_range"]))
            columns = np.hstack([x[:, :REGRESSORS_AT], regressors])
            priors = fitting._effect_scales(
                [one["seasonality_prior_scale"]], [one["holidays_prior_scale"]], columns.shape[1]
            )
            same = before is not None and before.shape[1] == trend.shape[1] + columns.shape[1]
            theta, beta, _, stands = fitting.map_estimates(
                y[:weeks] / top, trend[:weeks], columns[:weeks],
                np.array([one["changepoint_prior_scale"]], float), priors, mode,
                start=before if same else None,
            )
            before = np.hstack([theta, beta]) if stands[0] else None
            yhat = top * fitting.predicted(theta, beta, trend[test], columns[test], mode)[0]
            if not stands[0]:
                error = fitting.NOT_CONVERGED
        except Exception as problem:  # noqa: BLE001 - an origin that fails is a result
            yhat, error, before = np.full(len(test), np.nan), str(problem), None
        yield pd.DataFrame({"fold": origin["fold"], "ds": ds.iloc[test], "y": y[test], "yhat": yhat, "error": error})


def roll(pdf: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
    if pdf.empty or packed.empty:
        return pd.DataFrame(columns=fitting.HELD_COLUMNS)
    out = pd.concat(_origins(pdf.sort_values("ds"), packed), ignore_index=True)
    keys = {c: pdf[c].iloc[0] for c in SERIES} | {"param_id": 0}
    return out.assign(**keys)[fitting.HELD_COLUMNS]


def rolling_predictions(
    train: DataFrame, params: DataFrame, folds: DataFrame, holiday_match: str = "sunday"
) -> DataFrame:
    """Predictions of the test weeks of every fold by a model fitted to the weeks before it.

    ``params`` has one record per series, ``folds`` are those of ``grid.cv_schedule``.  A series
    without parameters or folds has no row; a fold whose fit fails has rows with its message.
    """
    rows = design(spread(train.withColumn("is_train", F.lit(True)), SERIES), SERIES, holiday_match)
    rows = rows.select(*SERIES, "ds", "y", "t", "x", "t_span", "centers", "scales")
    origins = F.array_sort(F.collect_list(F.struct("fold", "weeks_before", "test_end"))).alias("origins")
    packed = folds.groupBy(*SERIES).agg(origins).join(params.select(*SERIES, *PARAMETERS), SERIES)
    # new column identities, because both sides stem from the same frame
    packed = packed.select(*[F.col(c).alias(c) for c in packed.columns])
    groups = rows.groupBy(*SERIES).cogroup(packed.groupBy(*SERIES))
    return groups.applyInPandas(roll, fitting.HELD_SCHEMA)


def top_records(results: DataFrame, size: int = 3) -> DataFrame:
    """The ``size`` best records per series by sMAPE, with ``member`` (1 the best) and ``weight``.

    Weights follow one over the cross-validation error and add up to 1.  Records without finite
    metrics do not count; a series may have fewer members, or none.
    """
    order = Window.partitionBy(*SERIES).orderBy("smape", "param_id")
    valid = results.where(is_finite(F.col("smape")))
    best = valid.withColumn("member", F.row_number().over(order)).where(F.col("member") <= size)
    share = 1.0 / (F.col("smape") + LEAST_ERROR)
    whole = F.sum(share).over(Window.partitionBy(*SERIES))
    return best.select(*SERIES, "member", "param_id", *PARAMETERS, "smape", (share / whole).alias("weight"))


def member_forecasts(
    split: DataFrame, members: DataFrame, future: DataFrame, size: int = 3, holiday_match: str = "sunday"
) -> DataFrame:
    """``member, ds, yhat`` per series: each member fitted and forecast week by week.

    ``members`` are those of :func:`top_records`; a member whose fit fails has no rows.
    """
    def one(number: int) -> DataFrame:
        models = fitting.fit_models(split, members.where(F.col("member") == number), holiday_match)
        good = settle(models.where(F.col("status") == "Success"), "member-models")
        rows = iterative_forecast(good, future)
        return rows.select(*SERIES, F.lit(number).alias("member"), "ds", "yhat")

    return reduce(DataFrame.unionByName, [one(n) for n in range(1, size + 1)])
