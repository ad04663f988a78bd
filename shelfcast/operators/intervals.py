"""Prediction intervals from simulated trend paths, as JVM expressions.

A path carries the fitted trend on: changes arrive after the history at the rate of the possible
changes within it, with Laplace sizes of the fitted ones' mean; every week adds normal noise.
Draws are functions of (series, path, what is drawn), so rows are the same on every run, however the
table is partitioned, and a path is one and the same in all its weeks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import at_least_zero
from shelfcast.schemas import SERIES

#: Paths per series and share of them inside the interval.
PATHS = 1000
LEVEL = 0.8

#: Hexadecimal digits of the digest that make a draw, and how many values they can have.
DIGITS = 13
STEPS = float(16**DIGITS)


def uniform(*counter: Column) -> Column:
    """A number strictly between 0 and 1 that depends on the series and the counter only."""
    text = F.concat_ws("|", *[F.col(c) for c in SERIES], *[c.cast("string") for c in counter])
    digits = F.substring(F.md5(text), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / STEPS


def normal(*counter: Column) -> Column:
    radius = F.sqrt(F.log(uniform(F.lit("r"), *counter)) * -2.0)
    return radius * F.cos(uniform(F.lit("a"), *counter) * (2.0 * math.pi))


def laplace(scale: Column, *counter: Column) -> Column:
    centred = uniform(F.lit("s"), *counter) - 0.5
    return -scale * F.signum(centred) * F.log(1.0 - F.abs(centred) * 2.0)


def arrivals(mean: str, draw: Column) -> Column:
    """Poisson count whose distribution function first reaches ``draw``; ``mean`` names a column.

    The walk is longer than any count a draw of 52 bits can ask for.  The draw travels in the
    state: taken from outside, it would be computed again at every step.
    """
    rate = F.col(mean)
    longest = F.ceil(rate + F.sqrt(rate) * 10.0).cast("int") + 16
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), first.alias("below"), draw.alias("draw"), F.lit(0).alias("n"))

    def step(state: Column, j: Column) -> Column:
        p = state["p"] * rate / j
        passed = F.when(state["below"] < state["draw"], 1).otherwise(0)
        return F.struct(
            p.alias("p"),
            (state["below"] + p).alias("below"),
            state["draw"].alias("draw"),
            (state["n"] + passed).alias("n"),
        )

    return F.aggregate(F.sequence(F.lit(1), longest), start, step, lambda state: state["n"])


def with_trend_paths(rows: DataFrame, last_t: Column, name: str, paths: int = PATHS) -> DataFrame:
    """Add trend changes of every path up to scaled time ``last_t``: arrays of time and size.

    Rows carry the series and ``deltas``, the fitted sizes at the possible changes.
    """
    count = F.size("deltas")
    total = F.aggregate("deltas", F.lit(0.0), lambda a, d: a + F.abs(d))
    # Columns of their own, each used more than once, so that they are computed once a row.
    measured = rows.withColumn("_ahead", at_least_zero(last_t - 1.0)).withColumns(
        {"_mean": count * F.col("_ahead"), "_size": total / F.greatest(count, F.lit(1))}
    )

    def changes(path: Column) -> Column:
        n = arrivals("_mean", uniform(F.lit("n"), path))
        return F.transform(
            F.array_repeat(F.lit(1), n),
            lambda one, i: F.struct(
                (F.lit(1.0) + uniform(F.lit("t"), path, i + one) * F.col("_ahead")).alias("at"),
                laplace(F.col("_size"), path, i + one).alias("by"),
            ),
        )

    numbers = F.sequence(F.lit(1), F.lit(paths))
    return measured.withColumn(name, F.transform(numbers, changes)).drop("_ahead", "_mean", "_size")


def deviations(changes: str, lift: Column) -> Column:
    """Sorted deviations of all paths from the forecast of the row's week, on the fit's scale.

    ``changes`` names the column of :func:`with_trend_paths`; rows carry ``ds``, ``t`` and ``sigma``.
    ``lift`` is what a unit of trend adds to the forecast.
    """

    def deviation(path: Column, index: Column) -> Column:
        bend = F.aggregate(
            path, F.lit(0.0), lambda a, c: a + c["by"] * F.greatest(F.col("t") - c["at"], F.lit(0.0))
        )
        noise = F.col("sigma") * normal(index + 1, F.date_format("ds", "yyyy-MM-dd"))
        return lift * bend + noise

    return F.sort_array(F.transform(F.col(changes), deviation))


def quantile(ordered: Column, share: float, count: int) -> Column:
    """Value at ``share`` of a sorted array of ``count`` numbers, linear between neighbours."""
    place = share * (count - 1)
    low = min(int(place), count - 1)
    high = min(low + 1, count - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (place - low)
