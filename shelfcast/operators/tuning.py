"""Scoring parameter records and choosing one per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.metrics import mae, rmse, smape
from shelfcast.functions.numeric import INFINITY, is_finite
from shelfcast.operators.fitting import held_out_sums
from shelfcast.schemas import PARAMETERS, SERIES

NUMERIC_PARAMETERS = [p for p in PARAMETERS if p != "seasonality_mode"]


def score_records(held_out: DataFrame, records: DataFrame) -> DataFrame:
    """MAE, RMSE and sMAPE of each record over all held-out weeks.

    A record with an error on any fold, or with no held-out week, gets infinite metrics.
    """
    y, yhat = F.col("y"), F.col("yhat")
    scored = held_out.groupBy(*SERIES, "param_id").agg(
        mae(y, yhat).alias("mae"),
        rmse(y, yhat).alias("rmse"),
        smape(y, yhat).alias("smape"),
        F.max("error").alias("error"),
    )
    failed = F.col("error").isNotNull() | F.col("mae").isNull()

    def or_infinite(name: str) -> Column:
        return F.when(failed, F.lit(INFINITY)).otherwise(F.col(name)).alias(name)

    return records.join(scored, [*SERIES, "param_id"], "left").select(
        *SERIES,
        "param_id",
        *PARAMETERS,
        *[or_infinite(m) for m in ("mae", "rmse", "smape")],
        "error",
    )


def tune(
    train: DataFrame, records: DataFrame, folds: DataFrame, holiday_match: str = "sunday"
) -> DataFrame:
    """Cross-validation results: one row per series and record.

    The sums of the folds are added up, and nothing is joined: every row brings its record.
    Series without a fold get infinite metrics, as records with an error do.
    """
    sums = held_out_sums(train, records, folds, holiday_match).groupBy(*SERIES, "param_id", *PARAMETERS).agg(
        *[F.sum(c).alias(c) for c in ("weeks", "absolute", "squared", "relative")],
        F.max("error").alias("error"),
    )
    never = records.join(folds.select(*SERIES).distinct(), SERIES, "left_anti").select(
        *SERIES, "param_id", *PARAMETERS, F.lit(0).cast("bigint").alias("weeks"),
        *[F.lit(None).cast("double").alias(c) for c in ("absolute", "squared", "relative")],
        F.lit(None).cast("string").alias("error"),
    )
    both = sums.unionByName(never)
    failed = F.col("error").isNotNull() | (F.col("weeks") == 0)

    def mean(name: str) -> Column:
        return F.try_divide(F.col(name), F.col("weeks"))

    metrics = {"mae": mean("absolute"), "rmse": F.sqrt(mean("squared")), "smape": mean("relative")}
    return both.select(
        *SERIES, "param_id", *PARAMETERS,
        *[F.when(failed, F.lit(INFINITY)).otherwise(m).alias(n) for n, m in metrics.items()],
        "error",
    )


def params_text() -> Column:
    """The record as text."""
    return F.to_json(F.struct(*PARAMETERS))


def best_params(results: DataFrame) -> DataFrame:
    """The record with the lowest sMAPE per series, ties to the lower ``param_id``.

    Also reports its MAE and the lowest MAE of any record.  Records without finite metrics do
    not count; a series that has only such records gets no row.
    """
    record = F.struct("param_id", *PARAMETERS, "smape", "mae")
    valid = results.where(is_finite(F.col("smape")))
    best = valid.groupBy(*SERIES).agg(
        F.min_by(record, F.struct("smape", "param_id")).alias("best"),
        F.min("mae").alias("lowest_mae"),
    )
    return best.select(*SERIES, "best.*", "lowest_mae")


def with_overrides(best: DataFrame, overrides: DataFrame) -> DataFrame:
    """Chosen parameters with a table of per-series overrides on top, column by column."""
    hand = overrides.select(*SERIES, *[F.col(p).alias(f"_{p}") for p in PARAMETERS])
    return best.join(hand, SERIES, "left").select(
        *SERIES,
        *[F.coalesce(F.col(f"_{p}"), F.col(p)).alias(p) for p in PARAMETERS],
    )


def tuned_beside_manual(results: DataFrame) -> DataFrame:
    """Per series and parameter: the tuned value next to the hand-picked one, with scores.

    ``results`` comes from a grid with the manual record in it.
    """
    is_manual = F.col("param_id") == -1
    tuned = best_params(results.where(~is_manual))
    manual = results.where(is_manual)
    keys = [*SERIES, "smape", "mae"]

    def long(df: DataFrame, name: str) -> DataFrame:
        texts = df.select(*keys, *[F.col(p).cast("string").alias(p) for p in PARAMETERS])
        return texts.unpivot(keys, PARAMETERS, "parameter", name).select(
            *SERIES,
            "parameter",
            name,
            F.col("smape").alias(f"{name}_smape"),
            F.col("mae").alias(f"{name}_mae"),
        )

    return long(tuned, "tuned").join(long(manual, "manual"), [*SERIES, "parameter"])


def param_impact(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean sMAPE and number of records per value of each parameter, infinite ones left out."""
    keys = by or []
    texts = results.where(is_finite(F.col("mae"))).select(
        *keys, "smape", *[F.col(p).cast("string").alias(p) for p in PARAMETERS]
    )
    long = texts.unpivot([*keys, "smape"], PARAMETERS, "parameter", "value")
    return long.groupBy(*keys, "parameter", "value").agg(
        F.avg("smape").alias("mean_smape"), F.count(F.lit(1)).alias("records")
    )


def param_scatter(results: DataFrame) -> DataFrame:
    """Points of the parameter plots: one per record and numeric parameter."""
    keys = [*SERIES, "param_id", "smape"]
    valid = results.where(is_finite(F.col("mae"))).select(*keys, *NUMERIC_PARAMETERS)
    return valid.unpivot(keys, NUMERIC_PARAMETERS, "parameter", "value")
