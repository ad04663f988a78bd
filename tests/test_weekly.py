"""Weekly resample, gap fill, lag, gate and split on toy cases."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.operators import regressors, weekly

D = dt.date


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("SKU_ID", "ds").select(*columns).collect()]


def test_resample_fills_gaps_and_lags(daily_frame):
    daily = daily_frame(
        [
            ("a", "2024-01-01", 1, 10),
            ("a", "2024-01-07", 2, 0),
            ("a", "2024-01-08", 3, 5),
            ("a", "2024-01-28", 4, 7),
        ]
    )
    got = rows(weekly.weekly_features(daily), "ds", "y", "Promo_discount_perc", "is_promo", "y_lag1")
    assert got == [
        (D(2024, 1, 7), 3.0, 5.0, 1.0, 0.0),
        (D(2024, 1, 14), 3.0, 5.0, 1.0, 3.0),
        (D(2024, 1, 21), 0.0, 0.0, 0.0, 3.0),
        (D(2024, 1, 28), 4.0, 7.0, 1.0, 0.0),
    ]


def test_returns_count_for_the_range_only(daily_frame):
    daily = daily_frame(
        [
            ("a", "2024-01-01", -5, 0),
            ("a", "2024-01-10", 3, 0),
            ("a", "2024-01-11", -1, 50),
            ("a", "2024-02-20", -2, 0),
        ]
    )
    cells = weekly.weekly_cells(daily)
    assert rows(weekly.fill_weeks(cells), "ds", "y", "Promo_discount_perc") == [
        (D(2024, 1, 14), 3.0, 0.0)
    ]
    gate = weekly.series_gate(cells).collect()[0]
    assert (gate.min_date, gate.max_date, gate.span_days) == (D(2024, 1, 1), D(2024, 2, 20), 51)


def test_weather_by_day_and_by_row(spark, daily_frame):
    daily = daily_frame([("a", "2024-01-01", 1, 0), ("a", "2024-01-01", 2, 0), ("a", "2024-01-03", 1, 0)])
    weather = spark.createDataFrame(
        [(D(2024, 1, d), 3.0 * d, 1.0) for d in range(1, 8)],
        "ds date, temperature_2m_max double, precipitation_sum double",
    )
    by_day = weekly.weekly_features(daily, weather).collect()[0]
    assert (by_day.temperature_2m_max, by_day.precipitation_sum) == (12.0, 7.0)
    by_row = weekly.weekly_features(daily, weather, "row").collect()[0]
    assert (by_row.temperature_2m_max, by_row.precipitation_sum) == (5.0, 3.0)


def test_split_and_future_weeks(daily_frame):
    daily = daily_frame([("a", d, 1, 0) for d in ("2024-01-01", "2024-01-14", "2024-01-21", "2024-01-28")])
    split = weekly.split_holdout(weekly.weekly_features(daily))
    assert rows(split, "ds", "is_train") == [
        (D(2024, 1, 7), True),
        (D(2024, 1, 14), True),
        (D(2024, 1, 21), False),
        (D(2024, 1, 28), False),
    ]
    assert split.first().validation_start == D(2024, 1, 15)
    ahead = regressors.future_weeks(split.withColumn("train_end", F.lit("2024-01-07").cast("date")))
    assert [r.ds for r in ahead.orderBy("step").collect()] == [
        D(2024, 1, 14),
        D(2024, 1, 21),
        D(2024, 1, 28),
        D(2024, 2, 4),
    ]


def test_sundays(spark):
    days = spark.createDataFrame([("2024-01-06",), ("2024-01-07",), ("2024-01-08",)], "d string")
    day = F.col("d").cast("date")
    got = days.select(dates.latest_sunday(day).alias("l"), dates.closing_sunday(day).alias("c")).collect()
    assert [(r.l, r.c) for r in got] == [
        (D(2023, 12, 31), D(2024, 1, 7)),
        (D(2024, 1, 7), D(2024, 1, 7)),
        (D(2024, 1, 7), D(2024, 1, 14)),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 120), st.integers(-3, 9), st.integers(0, 4)),
        min_size=1,
        max_size=40,
    )
)
def test_same_as_pandas_resample(daily_frame, data):
    first = D(2024, 1, 1)
    listed = [(s, str(first + dt.timedelta(days=d)), y, p) for s, d, y, p in data]
    got = {
        (r.SKU_ID, r.ds): (r.y, round(r.Promo_discount_perc, 9), r.is_promo, r.y_lag1)
        for r in weekly.weekly_features(daily_frame(listed)).collect()
    }
    pdf = pd.DataFrame(listed, columns=["s", "ds", "y", "p"])
    pdf["ds"] = pd.to_datetime(pdf["ds"])
    want = {}
    for s, part in pdf[pdf["y"] >= 0].groupby("s"):
        part = part.assign(i=(part["p"] > 0).astype(float)).set_index("ds")
        w = part.resample("W-SUN").agg({"y": "sum", "p": "mean", "i": "max"}).fillna(0)
        w["lag"] = w["y"].shift(1).fillna(0)
        for ds, r in w.iterrows():
            want[(s, ds.date())] = (r.y, round(r.p, 9), r.i, r.lag)
    assert got == want


def test_hot_series_and_partitioning_change_nothing(spark, daily_frame):
    """One series with most of the rows; results do not depend on partition counts."""
    start = D(2024, 1, 1)
    hot = [("hot", str(start + dt.timedelta(days=i % 200)), 1, i % 3) for i in range(3000)]
    cold = [(f"s{i}", str(start + dt.timedelta(days=i * 3)), 2, 0) for i in range(50)]
    daily = daily_frame(hot + cold)
    one = rows(weekly.weekly_features(daily.coalesce(1)), "SKU_ID", "ds", "y", "y_lag1")
    many = rows(weekly.weekly_features(daily.repartition(13)), "SKU_ID", "ds", "y", "y_lag1")
    assert one == many
    alone = rows(weekly.weekly_features(daily.where("SKU_ID = 'hot'")), "SKU_ID", "ds", "y", "y_lag1")
    assert [r for r in one if r[0] == "hot"] == alone
    assert sum(r[2] for r in alone) == 3000


def test_status_of_series_without_their_weeks(spark, daily_frame):
    """The same as by the weeks in between, which are not made; a missing key has no training gate."""
    rows = [("gone", "2024-01-01", -1, 0), ("gone", "2024-05-01", -1, 0), ("once", "2024-01-01", 5, 0)]
    rows += [(f"s{n}", day, 5, 0) for n in range(60, 120, 3)
             for day in ("2024-01-01", str(D(2024, 1, 1) + dt.timedelta(n)))]
    daily = daily_frame(rows)
    daily = daily.unionByName(daily.where("SKU_ID = 's60'").withColumn("Unit", F.lit(None).cast("string")))
    cells = weekly.weekly_cells(daily)
    keys = ["SKU_ID", "Channel", "Unit"]
    for held in (0, 7, 8, 14, 21):
        long_way = weekly.split_summary(weekly.split_holdout(weekly.fill_weeks(cells), held))
        gate = weekly.series_gate(cells, held).withColumnRenamed("status", "gate")
        want = gate.join(long_way.select(*keys, "status"), keys, "left").select(
            *keys, F.coalesce("gate", "status", F.lit(weekly.SUCCESS))
        )
        want = sorted(map(str, want.collect()))
        for given in (cells, weekly.line_cells(daily)):
            got = weekly.series_status(given, held)
            assert [r.replace("Status=", "") for r in sorted(map(str, got.collect()))] == [
                r.replace("coalesce(gate, status, Success)=", "") for r in want
            ]
    plan = weekly.series_status(weekly.line_cells(daily))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and plan.count("Exchange") == 1
