"""Model features as columns: scaled time, changepoints, yearly terms, regressors.

Fit and forecast build them from the same expressions.  Order of the feature vector: ten
yearly sine/cosine pairs, the holiday flag, the regressors with the lag last.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.holidays import GIVEN, week_holiday_flag
from shelfcast.schemas import LAG, PROMO, WEATHER

#: Fixed values of the model family (Taylor & Letham, "Forecasting at Scale", 2018).
YEARLY_ORDER = 10
YEAR_DAYS = 365.25
CHANGEPOINTS = 25

HOLIDAY_AT = 2 * YEARLY_ORDER
REGRESSORS_AT = HOLIDAY_AT + 1


def regressor_names(df: DataFrame) -> list[str]:
    """Regressors a frame carries; weather columns are optional."""
    return [c for c in [*PROMO, *WEATHER, LAG] if c in df.columns]


def yearly_terms(day: str = "ds") -> list[str]:
    """Sine and cosine of one to ten cycles per year, as SQL text."""
    rates = [2 * math.pi * k / YEAR_DAYS for k in range(1, YEARLY_ORDER + 1)]
    return [f"{f}(unix_date({day}) * {rate!r}D)" for rate in rates for f in ("sin", "cos")]


def holiday_term(day: Column, last_week: Column, flag: Column) -> Column:
    """Holiday flag; the calendar ends with the last observed week."""
    return F.when(day <= last_week, flag).otherwise(0.0)


def given_or_rule(rows: DataFrame, match: str) -> Column:
    """The flag of a holiday table where the rows carry one, else that of the rule."""
    return F.col(GIVEN) if GIVEN in rows.columns else week_holiday_flag(F.col("ds"), match)


def design(rows: DataFrame, by: list[str], holiday_match: str = "sunday") -> DataFrame:
    """Add scaling constants, ``t`` and the feature vector ``x`` to weekly rows.

    Constants come from the rows flagged ``is_train`` within each ``by`` group; all of them in
    one window over rows that are as many as the group has weeks.  Regressors are centred and
    scaled unless they are 0/1 or constant.
    """
    names = regressor_names(rows)
    # Ordered, so that rounding does not depend on how the rows arrive.
    group = (
        Window.partitionBy(*by)
        .orderBy("ds")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )

    def over_train(agg: str, value: str) -> Column:
        return F.expr(f"{agg}(if(is_train, {value}, null))").over(group)

    stats = {
        "t0": over_train("min", "ds"),
        "_t1": over_train("max", "ds"),
        "weeks": over_train("count", "1"),
        "_top": over_train("max", "abs(y)"),
    }
    for c in names:
        stats[f"_avg_{c}"] = over_train("avg", c)
        stats[f"_std_{c}"] = over_train("stddev_samp", c)
        stats[f"_min_{c}"] = over_train("min", c)
        stats[f"_max_{c}"] = over_train("max", c)
        stats[f"_binary_{c}"] = over_train("bool_and", f"{c} in (0, 1)")

    def unless_plain(c: str, scaled: str, plain: str) -> str:
        """0/1 and constant regressors stay as they are."""
        return f"if(_binary_{c} or _min_{c} = _max_{c}, {plain}, {scaled})"

    centers = ", ".join(unless_plain(c, f"_avg_{c}", "0D") for c in names)
    scales = ", ".join(unless_plain(c, f"_std_{c}", "1D") for c in names)
    measured = rows.withColumns(stats)
    scaled = measured.withColumns(
        {
            "t_span": F.expr("cast(greatest(datediff(_t1, t0), 1) as double)"),
            "y_scale": F.expr("if(_top > 0, _top, 1D)"),
            "centers": F.expr(f"array({centers})"),
            "scales": F.expr(f"array({scales})"),
            "_holiday": holiday_term(
                F.col("ds"), F.col("last_week"), given_or_rule(rows, holiday_match)
            ),
        }
    )
    yearly = [f"if(yearly, {term}, 0D)" for term in yearly_terms()]
    regressors = [f"({c} - centers[{i}]) / scales[{i}]" for i, c in enumerate(names)]
    features = ", ".join([*yearly, "_holiday", *regressors])
    helpers = [c for c in scaled.columns if c.startswith("_")]
    return scaled.withColumns(
        {"t": F.expr("datediff(ds, t0) / t_span"), "x": F.expr(f"array({features})")}
    ).drop(*helpers)


def knots(weeks: Column, changepoint_range: Column) -> Column:
    """Scaled times of the changepoints: even over the first part of a gap-free history."""
    reach = F.floor(weeks * changepoint_range).cast("int")
    count = F.least(F.lit(CHANGEPOINTS), reach - 1)
    placed = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda j: F.try_divide(F.rint(F.try_divide(j * (reach - 1), count)), weeks - 1),
    )
    return F.when(count > 0, placed).otherwise(F.array().cast("array<double>"))


def trend_at(t: Column) -> Column:
    """Piecewise linear trend from the model columns, on the scale of the fit."""
    bends = F.zip_with("knots", "deltas", lambda s, d: d * F.greatest(t - s, F.lit(0.0)))
    return F.col("offset") + F.col("slope") * t + F.aggregate(
        bends, F.lit(0.0), lambda a, b: a + b
    )


def yearly_effect(day: str = "ds") -> Column:
    return F.expr(" + ".join(f"beta[{i}] * {term}" for i, term in enumerate(yearly_terms(day))))


def regressor_effect(names: list[str]) -> Column:
    """Effect of the named regressors, which are the first ones of the model's list."""
    if not names:
        return F.lit(0.0)
    return F.expr(
        " + ".join(
            f"beta[{REGRESSORS_AT + i}] * ({c} - centers[{i}]) / scales[{i}]"
            for i, c in enumerate(names)
        )
    )
