"""Numeric expressions with the null, zero and infinity rules of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def at_least_zero(col: Column) -> Column:
    return F.greatest(col, F.lit(0.0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def is_finite(col: Column) -> Column:
    """True for a number that is neither NULL, NaN nor infinite."""
    return F.coalesce(~F.isnan(col) & (F.abs(col) < F.lit(INFINITY)), F.lit(False))


def to_log_scale(col: Column) -> Column:
    return F.log1p(col)


def from_log_scale(col: Column) -> Column:
    return F.expm1(col)
