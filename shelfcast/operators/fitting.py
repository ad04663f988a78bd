"""Fitting one additive or multiplicative regression per series.

Spark builds the features and groups the rows; a task sees the weekly rows of one series (and
fold), whose number the calendar bounds, and solves a small regularised regression.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.durable import spread
from shelfcast.operators.design import CHANGEPOINTS, HOLIDAY_AT, design, knots, regressor_names
from shelfcast.operators.weekly import FAILED, SUCCESS
from shelfcast.schemas import PARAMETERS, SERIES

TREND_SCALE = 5.0
NOISE_SCALE = 0.5
#: Least noise, as a share of the largest value: a perfect fit would have no mode without it.
LEAST_NOISE = 1e-3
#: Laplace priors are rounded off within this distance of 0 (the target is at most 1).
ROUNDING = 1e-3
#: Widths passed on the way there, each a start for the next.
WIDER = (0.1, 0.02, 0.005)
#: Expected gain of a step (in units of the log posterior) below which a solution stands, and
#: the steps after which a record counts as not converged.  Far beyond what records need.
TOLERANCE = 1e-9
STEP_LIMIT = 2000
#: Gain of the last step below which the whole curvature is used.
NEAR = 0.1
NOT_CONVERGED = "the fit did not converge"

MODEL_SCHEMA = (
    "SKU_ID string, Channel string, Unit string, changepoint_prior_scale double, "
    "seasonality_prior_scale double, holidays_prior_scale double, seasonality_mode string, "
    "changepoint_range double, yearly boolean, weeks bigint, t0 date, t_span double, "
    "y_scale double, last_ds date, last_y double, last_week date, regressors array<string>, "
    "centers array<double>, scales array<double>, knots array<double>, offset double, "
    "slope double, deltas array<double>, beta array<double>, sigma double, target_scale string, "
    "holiday_match string, weather_grain string, status string, "
    "error_message string"
)


class _Posterior:
    """Log posterior of many prior settings on the same data, with its derivatives.

    ``trend`` holds the columns 1, t and one hinge per changepoint, whose weights have Laplace
    priors of width ``bend_scale``; the effects of ``x`` have normal priors of width
    ``effect_scale``, one row per setting.  The noise is always at its own mode.
    """

    def __init__(self, y, trend, x, bend_scale, effect_scale, multiplicative):
        self.y, self.trend, self.x, self.multiplicative = y, trend, x, multiplicative
        self.q, self.columns = trend.shape[1], np.hstack([trend, x])
        settings = len(effect_scale)
        level = np.full((settings, self.q), 1.0 / TREND_SCALE**2)
        level[:, 2:] = 0.0
        self.ridge = np.hstack([level, 1.0 / effect_scale**2])
        self.bend = np.asarray(bend_scale, float)[:, None]
        width = self.columns.shape[1]
        i, j = np.triu_indices(width)
        pairs = self.columns[:, i] * self.columns[:, j]
        # which factor weighs a pair of columns: 0 both of the trend, 1 mixed, 2 both effects
        block = (i >= self.q).astype(int) + (j >= self.q)
        #: products of pairs of columns, by factor, and where each entry of a full matrix finds its own
        self.pairs = [pairs[:, block == k] for k in range(3)]
        number = np.empty(len(i), int)
        number[np.argsort(block, kind="stable")] = np.arange(len(i))
        self.entry = np.empty((width, width), int)
        self.entry[i, j] = self.entry[j, i] = number
        self.entry = self.entry.ravel()
        #: sums of products, which in the additive form do not depend on the coefficients
        self.gram = None if multiplicative else np.concatenate([pairs.sum(axis=0)[block == k] for k in range(3)])[self.entry]

    def only(self, rows):
        part = object.__new__(_Posterior)
        part.__dict__.update(self.__dict__, ridge=self.ridge[rows], bend=self.bend[rows])
        return part

    def _parts(self, w):
        level, effect = w[:, : self.q] @ self.trend.T, w[:, self.q :] @ self.x.T
        return level, 1.0 + effect if self.multiplicative else effect

    def _noise(self, rss):
        """Mode of the variance under its half-normal prior, and its slope in ``rss``.

        At least ``LEAST_NOISE`` squared, where it stays when ``rss`` falls further.
        """
        n, k = len(self.y), 1.0 / NOISE_SCALE**2
        root = np.sqrt(n * n + 4.0 * k * rss)
        v = (root - n) / (2.0 * k)
        return np.maximum(v, LEAST_NOISE**2), np.where(v > LEAST_NOISE**2, 1.0 / root, 0.0)

    def value(self, w, rounding):
        level, effect = self._parts(w)
        fitted = level * effect if self.multiplicative else level + effect
        rss = ((self.y - fitted) ** 2).sum(axis=1)
        v, _ = self._noise(rss)
        bends = np.sqrt(w[:, 2 : self.q] ** 2 + rounding**2) / self.bend
        fit = 0.5 * len(self.y) * np.log(v) + rss / (2 * v) + v / (2 * NOISE_SCALE**2)
        return fit + 0.5 * (self.ridge * w * w).sum(axis=1) + bends.sum(axis=1)

    def step(self, w, rounding, near=None):
        """Gradient, Newton step and noise.

        Products of trend and effects bend with the residual; that part of the curvature counts
        for the settings flagged ``near``, whose gain has become small.  Far from a mode it may
        point to a saddle, and without it a mode with large residuals is crept up to.
        """
        level, effect = self._parts(w)
        if self.multiplicative:
            residual = self.y - level * effect
            moment = np.hstack([(residual * effect) @ self.trend, (residual * level) @ self.x])
            mixed = effect * level
            if near is not None:
                mixed = mixed - np.where(near[:, None], residual, 0.0)
            factors = (effect * effect, mixed, level * level)
            packed = np.concatenate([f @ p for f, p in zip(factors, self.pairs)], axis=1)
        else:
            residual = self.y - level - effect
            moment = residual @ self.columns
            packed = None
        rss = (residual**2).sum(axis=1)
        v, slope = self._noise(rss)
        root = np.sqrt(w[:, 2 : self.q] ** 2 + rounding**2)
        gradient = self.ridge * w - moment / v[:, None]
        gradient[:, 2 : self.q] += w[:, 2 : self.q] / root / self.bend
        curve = self.ridge.copy()
        curve[:, 2 : self.q] += rounding**2 / root**3 / self.bend
        width = w.shape[1]
        if packed is None:
            hessian = self.gram / v[:, None]
        else:
            packed /= v[:, None]
            hessian = packed.take(self.entry, axis=1)
        hessian = hessian.reshape(len(w), width, width)
        index = np.arange(width)
        hessian[:, index, index] += curve + 1e-10
        both = np.linalg.solve(hessian, np.stack([-gradient, moment], axis=2))
        plain, along = both[:, :, 0], both[:, :, 1]
        # the noise moves with the fit: a term of rank one, left out where it would dominate
        c = 2.0 * slope / v**2
        rest = 1.0 - c * (moment * along).sum(axis=1)
        share = np.where(rest > 0.1, c * (moment * plain).sum(axis=1) / np.maximum(rest, 0.1), 0.0)
        move = plain + share[:, None] * along
        uphill = (gradient * move).sum(axis=1) >= 0
        if near is not None and (uphill & near).any():  # the whole curvature is that of a saddle
            back = np.flatnonzero(uphill & near)
            move[back] = self.only(back).step(w[back], rounding)[1]
            uphill[back] = False
        # rounding errors can turn a step uphill; the scaled gradient never is
        move[uphill] = -gradient[uphill] / hessian[uphill][:, index, index]
        return gradient, move, v


def map_estimates(
    y, trend, x, bend_scale, effect_scale, multiplicative, step_limit=STEP_LIMIT, start=None
):
    """Posterior modes for many prior settings on the same data, and which of them stand.

    Damped Newton steps on all settings at once; a setting leaves when a step promises no gain.
    The multiplicative form is a product of trend and effects, so its mode is a local one, the
    first downhill from a flat series, or from the coefficients in ``start`` (one row a setting,
    such as the solution for almost the same data).  No random numbers.
    """
    posterior = _Posterior(y, trend, x, bend_scale, effect_scale, multiplicative)
    settings = len(effect_scale)
    w = np.zeros((settings, trend.shape[1] + x.shape[1]))
    w[:, 0] = np.mean(y)
    sigma = np.zeros(settings)
    stands = np.zeros(settings, bool)
    everyone, wider = np.arange(settings), WIDER
    if start is not None:
        w[:], wider = start, WIDER[-1:]
    for rounding, tolerance in [*((r, 1e-2) for r in wider), (ROUNDING, TOLERANCE)]:
        _descend(posterior, w, sigma, stands, everyone, rounding, tolerance, step_limit)
    return w[:, : trend.shape[1]], w[:, trend.shape[1] :], sigma, stands


def _descend(posterior, w, sigma, stands, rows, rounding, tolerance, step_limit):
    """Damped Newton steps on ``rows`` of ``w``, in place, until none promises a gain."""
    active = rows
    stands[rows] = False
    gains = np.full(len(w), np.inf)
    for _ in range(step_limit if len(rows) else 0):
        here = posterior.only(active)
        gradient, move, v = here.step(w[active], rounding, gains[active] < NEAR)
        gain = -(gradient * move).sum(axis=1)
        gains[active] = gain
        sigma[active] = np.sqrt(v)
        done = gain < tolerance
        stands[active[done]] = True
        active, move, gain = active[~done], move[~done], gain[~done]
        if not len(active):
            break
        here = posterior.only(active)
        at, before = w[active], here.value(w[active], rounding)
        size, open_ = np.ones(len(active)), np.ones(len(active), bool)
        for _ in range(40):
            # only settings still searching are evaluated again
            trial = here.only(np.flatnonzero(open_)).value(
                at[open_] + size[open_, None] * move[open_], rounding
            )
            fails = ~(trial <= before[open_] - 1e-4 * size[open_] * gain[open_])
            open_[open_] = fails
            if not open_.any():
                break
            size[open_] *= 0.5
        w[active] = at + np.where(open_, 0.0, size)[:, None] * move
        # no step helps any more: rounding errors are larger than the gain
        stuck = active[open_]
        stands[stuck] = gain[open_] < 1e-6
        active = active[~open_]
        if not len(active):
            break


def predicted(theta, beta, trend, x, multiplicative):
    level, effect = theta @ trend.T, beta @ x.T
    return level * (1.0 + effect) if multiplicative else level + effect


def _trend(t, bends):
    """Columns of the piecewise linear trend: level, slope and one hinge per changepoint."""
    bends = np.asarray(bends, float)
    return np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - bends[None], 0.0)])


def _arrays(pdf: pd.DataFrame):
    """Scaled target, scaled time and features of the rows of one group."""
    y = pdf["y"].to_numpy(float) / float(pdf["y_scale"].iloc[0])
    return y, pdf["t"].to_numpy(float), np.stack(pdf["x"].to_numpy()).astype(float)


def _effect_scales(seasonal, holidays, width: int):
    """Yearly terms follow the seasonality prior, holidays and regressors the holiday prior."""
    out = np.repeat(np.asarray(holidays, float)[:, None], width, axis=1)
    out[:, :HOLIDAY_AT] = np.asarray(seasonal, float)[:, None]
    return out


def fit_one(pdf: pd.DataFrame) -> pd.DataFrame:
    """Model row of one series; a failed fit becomes a row with its message."""
    pdf = pdf.sort_values("ds")
    last = pdf.iloc[-1]
    keep = [*SERIES, *PARAMETERS, *SETTINGS, "yearly", "weeks", "t0", "t_span", "y_scale", "last_week"]
    row = {c: last[c] for c in keep} | {
        "last_ds": last["ds"],
        "last_y": float(last["y"]),
        **{c: list(last[c]) for c in ("regressors", "centers", "scales")},
        **dict.fromkeys(["knots", "offset", "slope", "deltas", "beta", "sigma"]),
    }
    try:
        if pd.isna(last["changepoint_prior_scale"]):
            raise ValueError("no valid parameters")
        y, t, x = _arrays(pdf)
        multiplicative = last["seasonality_mode"] == "multiplicative"
        theta, beta, sigma, stands = map_estimates(
            y,
            _trend(t, last["knots"]),
            x,
            np.array([last["changepoint_prior_scale"]], float),
            _effect_scales(
                [last["seasonality_prior_scale"]], [last["holidays_prior_scale"]], x.shape[1]
            ),
            multiplicative,
        )
        if not stands[0]:
            raise ValueError(NOT_CONVERGED)
        row |= {
            "knots": [float(v) for v in last["knots"]],
            "offset": theta[0, 0],
            "slope": theta[0, 1],
            "deltas": theta[0, 2:].tolist(),
            "beta": beta[0].tolist(),
            "sigma": float(sigma[0]),
            "status": SUCCESS,
            "error_message": None,
        }
    except Exception as problem:  # noqa: BLE001 - one series never stops the others
        row |= {"status": FAILED, "error_message": str(problem)}
    return pd.DataFrame([row])


#: What a forecast must know about the rows that a model was fitted to.
SETTINGS = ["target_scale", "holiday_match", "weather_grain"]
NATURAL, LOG = "natural", "log"


def fit_models(
    split: DataFrame,
    params: DataFrame,
    holiday_match: str = "sunday",
    target_scale: str = NATURAL,
    weather_grain: str = "day",
) -> DataFrame:
    """One fitted model per series, from its training weeks and chosen parameters.

    ``params`` has one row per series; a series without one gets a failed model row.  The rows
    are exchanged once, for the scaling window and the fit alike.  The settings under which the
    rows were made stay with the model: forecasts read them there.
    """
    names = regressor_names(split)
    train = split.where("is_train").join(params.select(*SERIES, *PARAMETERS), SERIES, "left")
    ready = design(spread(train, SERIES), SERIES, holiday_match).select(
        *SERIES, *PARAMETERS, "yearly", "weeks", "t0", "t_span", "y_scale", "last_week",
        "ds", "y", "t", "x", "centers", "scales",
        F.array(*[F.lit(c) for c in names]).alias("regressors"),
        *[F.lit(v).alias(c) for c, v in zip(SETTINGS, (target_scale, holiday_match, weather_grain))],
        knots(F.col("weeks"), F.col("changepoint_range")).alias("knots"),
    )
    return ready.groupBy(*SERIES).applyInPandas(fit_one, MODEL_SCHEMA)


def optimality(models: DataFrame, split: DataFrame, holiday_match: str = "sunday") -> DataFrame:
    """``slope``: the gradient of the log posterior at the stored coefficients.

    Its length is taken in the posterior's own curvature (the gain that one more Newton step
    promises), so that it means the same for every series and prior.  Features are built again
    from the weekly rows, and the slope comes from the coefficients alone: this checks what is
    stored and not the solver's own account.
    """
    coefficients = ["offset", "slope", "deltas", "beta", "knots"]
    good = models.where(F.col("status") == SUCCESS).select(*SERIES, *PARAMETERS, *coefficients)
    rows = split.where("is_train").join(good, SERIES)
    ready = design(spread(rows, SERIES), SERIES, holiday_match).select(
        *SERIES, *PARAMETERS, *coefficients, "weeks", "ds", "y", "t", "x", "y_scale"
    )

    def slope_of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        one = pdf.iloc[0]
        y, t, x = _arrays(pdf)
        posterior = _Posterior(
            y, _trend(t, one["knots"]), x, [one["changepoint_prior_scale"]],
            _effect_scales([one["seasonality_prior_scale"]], [one["holidays_prior_scale"]], x.shape[1]),
            one["seasonality_mode"] == "multiplicative",
        )
        w = np.concatenate([[one["offset"], one["slope"]], one["deltas"], one["beta"]])[None]
        gradient, move, _ = posterior.step(w, ROUNDING)
        row = {c: one[c] for c in [*SERIES, "weeks"]} | {"slope": float(-(gradient * move).sum())}
        return pd.DataFrame([row])

    schema = "SKU_ID string, Channel string, Unit string, weeks bigint, slope double"
    return ready.groupBy(*SERIES).applyInPandas(slope_of, schema)


HELD_SCHEMA = (
    "SKU_ID string, Channel string, Unit string, fold int, param_id int, ds date, y double, "
    "yhat double, error string"
)
HELD_COLUMNS = [*SERIES, "fold", "param_id", "ds", "y", "yhat", "error"]

#: Sums over the held-out weeks of one fold, from which the metrics of a record are made.
SUMS_SCHEMA = (
    "SKU_ID string, Channel string, Unit string, fold int, param_id int, "
    "changepoint_prior_scale double, seasonality_prior_scale double, "
    "holidays_prior_scale double, seasonality_mode string, changepoint_range double, "
    "weeks bigint, absolute double, squared double, relative double, error string"
)
SUMS_COLUMNS = [
    *SERIES, "fold", "param_id", *PARAMETERS, "weeks", "absolute", "squared", "relative", "error",
]


def _unpacked(packed: pd.DataFrame) -> pd.DataFrame:
    """The records of one group, which arrive as one row with an array."""
    records = pd.DataFrame(list(packed["records"].iloc[0]))
    weeks = int(packed["weeks_before"].iloc[0])
    knots_of = {r: _knots(weeks, r) for r in records["changepoint_range"].unique()}
    return records.assign(knots=records["changepoint_range"].map(knots_of))


def _knots(weeks: int, changepoint_range: float) -> list[float]:
    """The changepoints of :func:`design.knots`."""
    reach = int(np.floor(weeks * changepoint_range))
    count = min(CHANGEPOINTS, reach - 1)
    if count <= 0:
        return []
    return [float(np.rint(j * (reach - 1) / count) / (weeks - 1)) for j in range(1, count + 1)]


def hold_out_sums(pdf: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
    """Error sums of every record over the held-out weeks of one series and fold."""
    if pdf.empty or packed.empty:
        return pd.DataFrame(columns=SUMS_COLUMNS)
    records = _unpacked(packed)
    held = fit_and_hold_out(pdf, packed)
    miss = (held["y"] - held["yhat"]).abs()
    size = held["y"].abs() + held["yhat"].abs()
    held = held.assign(
        weeks=1, absolute=miss, squared=miss * miss,
        relative=np.where(size != 0, 2 * miss / size.where(size != 0, 1.0), 0.0),
    )
    sums = held.groupby("param_id", sort=False)[["weeks", "absolute", "squared", "relative"]].sum(min_count=1)
    sums["error"] = held.groupby("param_id", sort=False)["error"].first()
    out = records.join(sums, on="param_id")
    for key in [*SERIES, "fold"]:
        out[key] = pdf[key].iloc[0]
    out["weeks"] = out["weeks"].fillna(0).astype("int64")
    return out[SUMS_COLUMNS]


def fit_and_hold_out(pdf: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
    """Predictions of the held-out weeks of one series and fold for every record.

    Records with the same changepoint range and mode share their matrices and are solved
    together.
    """
    if pdf.empty or packed.empty:
        return pd.DataFrame(columns=HELD_COLUMNS)
    records = _unpacked(packed)
    pdf = pdf.sort_values("ds")
    train = pdf["is_train"].to_numpy(bool)
    held = pdf.loc[~train, [*SERIES, "fold", "ds", "y"]]
    y, t, x = _arrays(pdf)
    scale = float(pdf["y_scale"].iloc[0])
    parts = []
    for (_, mode), same in records.groupby(["changepoint_range", "seasonality_mode"]):
        try:
            trend = _trend(t, same["knots"].iloc[0])
            theta, beta, _, stands = map_estimates(
                y[train],
                trend[train],
                x[train],
                same["changepoint_prior_scale"].to_numpy(float),
                _effect_scales(
                    same["seasonality_prior_scale"], same["holidays_prior_scale"], x.shape[1]
                ),
                mode == "multiplicative",
            )
            yhat = scale * predicted(theta, beta, trend[~train], x[~train], mode == "multiplicative")
            errors = np.where(stands, None, NOT_CONVERGED)
        except Exception as problem:  # noqa: BLE001 - an error is a result of the record
            errors = np.full(len(same), str(problem), object)
            yhat = np.full((len(same), len(held)), np.nan)
        part = held.loc[held.index.repeat(len(same))]
        parts.append(
            part.assign(
                param_id=np.tile(same["param_id"].to_numpy(), len(held)),
                yhat=yhat.T.reshape(-1),
                error=np.tile(errors, len(held)),
            )
        )
    return pd.concat(parts)[HELD_COLUMNS]


def _cross_validation(
    train: DataFrame, records: DataFrame, folds: DataFrame, holiday_match: str
):
    """Weekly rows beside the records, grouped by series and fold.

    A group has weekly rows, bounded by the calendar, and one row with all its records, bounded
    by the grid.  The records of a series are made in one task and packed there, so what is
    shuffled of them is one row for each series.
    """
    by_fold = [*SERIES, "fold"]
    rows = (
        train.join(folds.select(*by_fold, "cutoff", "test_end"), SERIES)
        .where(F.col("ds") <= F.col("test_end"))
        .withColumn("is_train", F.col("ds") <= F.col("cutoff"))
    )
    ready = design(spread(rows, by_fold), by_fold, holiday_match).select(
        *by_fold, "ds", "y", "is_train", "y_scale", "t", "x"
    )
    packed = records.groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(F.struct("param_id", *PARAMETERS))).alias("records")
    )
    tried = folds.select(*by_fold, "weeks_before").join(packed, SERIES)
    # New column identities, because both sides stem from the same frame.
    tried = spread(tried.select(*[F.col(c).alias(c) for c in tried.columns]), by_fold)
    return ready.groupBy(*by_fold).cogroup(tried.groupBy(*by_fold))


def held_out_predictions(
    train: DataFrame, records: DataFrame, folds: DataFrame, holiday_match: str = "sunday"
) -> DataFrame:
    """Cross-validation predictions of every record on every fold and week."""
    groups = _cross_validation(train, records, folds, holiday_match)
    return groups.applyInPandas(fit_and_hold_out, HELD_SCHEMA)


def held_out_sums(
    train: DataFrame, records: DataFrame, folds: DataFrame, holiday_match: str = "sunday"
) -> DataFrame:
    """Error sums of every record on every fold: one row each, with the record's parameters."""
    groups = _cross_validation(train, records, folds, holiday_match)
    return groups.applyInPandas(hold_out_sums, SUMS_SCHEMA)
