"""Forecast accuracy as aggregate expressions over an actual and a forecast column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.functions.numeric import INFINITY, ratio_or_zero


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(F.abs(y - yhat))


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(F.avg((y - yhat) * (y - yhat)))


def smape(y: Column, yhat: Column) -> Column:
    """Fraction between 0 and 2; a point where both are 0 counts as 0."""
    return F.avg(ratio_or_zero(F.abs(y - yhat), (F.abs(y) + F.abs(yhat)) / 2))


def wape(y: Column, yhat: Column) -> Column:
    """Total absolute error over total absolute actuals; infinite when those are 0."""
    base = F.sum(F.abs(y))
    return F.when(base != 0, F.sum(F.abs(y - yhat)) / base).otherwise(F.lit(INFINITY))


def accuracy(y: str = "y", yhat: str = "yhat") -> list[Column]:
    """The four run metrics, named as in the result table."""
    a, f = F.col(y), F.col(yhat)
    return [
        mae(a, f).alias("MAE"),
        rmse(a, f).alias("RMSE"),
        smape(a, f).alias("sMAPE"),
        wape(a, f).alias("WAPE"),
    ]
