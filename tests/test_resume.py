"""A run that is killed and started again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import weekly
from shelfcast.plans import batch, resume
from shelfcast.schemas import METRICS, SERIES

GRID = {
    "changepoint_prior_scale": [0.5], "seasonality_prior_scale": [10.0], "holidays_prior_scale": [10.0],
    "seasonality_mode": ["additive"], "changepoint_range": [0.8],
}


def inputs(spark, names):
    first = dt.date(2024, 1, 1)
    rows = [
        (s, "TF", "U", first + dt.timedelta(days=i), float(3 + (i * (k + 2)) % 5), 0.0)
        for k, s in enumerate(names)
        for i in range(203 if s != "short" else 20)
    ]
    sales = spark.createDataFrame(
        rows, "SKU_ID string, channel string, unit string, date date, quantity double, Promo_discount_perc double"
    )
    listed = spark.createDataFrame([(s, "TF", "U") for s in [*names, "absent"]], "SKU_ID string, Channel string, Unit string")
    return sales, listed


def plain(df):
    return sorted((tuple(r[c] for c in batch.RESULT_COLUMNS) for r in df.collect()), key=str)


def test_killed_run_goes_on(spark, folder, monkeypatch):
    """The job dies after its first chunk; the next start fits the others only."""
    sales, listed = inputs(spark, ["a", "b", "c", "short"])
    folder = f"{folder}/run"
    original, seen = batch.run_cells, []

    def dying(cells, series, **options):
        if seen:
            raise RuntimeError("lost")
        seen.append(sorted(r.SKU_ID for r in series.collect()))
        return original(cells, series, **options)

    monkeypatch.setattr(batch, "run_cells", dying)
    with pytest.raises(RuntimeError):
        resume.run_resumable(sales, listed, folder, chunks=3, param_grid=GRID)
    finished = sorted(r.SKU_ID for r in resume.results(spark, folder).collect())
    assert finished == seen[0] and 0 < len(finished) < 5

    refitted = []

    def noting(cells, series, **options):
        refitted.extend(r.SKU_ID for r in series.collect())
        return original(cells, series, **options)

    monkeypatch.setattr(batch, "run_cells", noting)
    got = resume.run_resumable(sales, listed, folder, chunks=3, param_grid=GRID)
    assert sorted(refitted + finished) == ["a", "absent", "b", "c", "short"]
    assert plain(got) == plain(batch.run_batch(sales, listed, param_grid=GRID).results)
    assert {r.SKU_ID: r.Status for r in got.collect()}["short"] == weekly.SHORT_DATA
    assert {r.attempt for r in got.collect()} == {1, 2}
    # stored rows belong to the results: one model and two held-out weeks for each fitted series
    assert resume.rows_of(spark, folder, "models").groupBy(*SERIES).count().where("count <> 1").count() == 0
    assert resume.rows_of(spark, folder, "comparison").count() == 6

    # nothing left to do: no series is fitted, the results stay
    refitted.clear()
    again = resume.run_resumable(sales, listed, folder, chunks=3, param_grid=GRID)
    assert refitted == [] and plain(again) == plain(got)


def test_half_written_chunk_counts_for_nothing(spark, folder):
    """Forecasts without a result are left behind by readers and made again."""
    sales, listed = inputs(spark, ["a"])
    folder = f"{folder}/run"
    resume.run_resumable(sales, listed, folder, chunks=1, param_grid=GRID)
    stray = spark.read.parquet(f"{folder}/forecast").withColumn("attempt", F.lit(7)).withColumn("yhat", F.lit(-1.0))
    stray.write.mode("append").parquet(f"{folder}/forecast")
    kept = resume.rows_of(spark, folder, "forecast")
    assert kept.count() == 4 and kept.where("yhat < 0").count() == 0
    row = resume.results(spark, folder).where("SKU_ID = 'a'").first()
    assert all(row[m] is not None for m in METRICS)


def test_empty_list_and_failed_series(spark, folder):
    sales, listed = inputs(spark, ["a"])
    empty = resume.run_resumable(sales, listed.limit(0), f"{folder}/none", param_grid=GRID)
    assert empty.count() == 0 and empty.columns == [*batch.RESULT_COLUMNS, "attempt"]
    path = f"{folder}/failed"
    resume._ledger(spark, path, "results", resume.RESULTS)
    failed = listed.where("SKU_ID = 'a'").select(
        *SERIES, F.lit(weekly.FAILED).alias("Status"),
        *[F.lit(None).cast(resume.RESULTS[c].dataType).alias(c) for c in batch.RESULT_COLUMNS[4:]],
        F.lit(0).alias("attempt"),
    )
    failed.write.mode("append").parquet(f"{path}/results")
    stays = resume.run_resumable(sales, listed, path, chunks=1, param_grid=GRID)
    assert {r.SKU_ID: r.Status for r in stays.collect()} == {"a": weekly.FAILED, "absent": weekly.NO_DATA}
    tried = resume.run_resumable(sales, listed, path, chunks=1, retry_failed=True, param_grid=GRID)
    assert {r.SKU_ID: r.Status for r in tried.collect()} == {"a": weekly.SUCCESS, "absent": weekly.NO_DATA}
