"""Readers and writers."""

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfcast import durable, schemas
from shelfcast.functions import numeric, text
from shelfcast.sources import dimensions, sales, series_list, tables, weather

D = dt.date


def test_series_list_headers_and_values(spark, folder):
    with open(f"{folder}/list.csv", "w") as f:
        f.write(" sku_id ,CHANNEL,Unit ,note\n П-1 ,\tTF,Пермь  ,x\n7,KA,U,y\n")
    got = series_list.read_series_list(spark, f"{folder}/list.csv").collect()
    assert [tuple(r) for r in got] == [("П-1", "TF", "Пермь"), ("7", "KA", "U")]


def test_series_list_empty_or_incomplete(spark, folder):
    open(f"{folder}/empty.csv", "w").close()
    empty = series_list.read_series_list(spark, f"{folder}/empty.csv")
    assert (empty.columns, empty.count()) == (schemas.SERIES, 0)
    with open(f"{folder}/short.csv", "w") as f:
        f.write("SKU_ID,Unit\n1,2\n")
    with pytest.raises(ValueError, match="Channel"):
        series_list.read_series_list(spark, f"{folder}/short.csv")


def test_choose_series(spark):
    listed = spark.createDataFrame(
        [("b", "TF", "U", 1), ("a", "TF", "U", 2), ("c", "KA", "U", 3)],
        "SKU_ID string, Channel string, Unit string, n int",
    )
    def first(n):
        got = series_list.choose_series(listed, channel="TF", max_series=n, list_order=["n"])
        return [r.SKU_ID for r in got.orderBy("n").collect()]
    assert first(1) == ["b"]
    assert first(0) == first(None) == first(9) == ["b", "a"]


def test_weather_payload(spark, folder):
    with open(f"{folder}/w.json", "w") as f:
        json.dump(
            {"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [1.5, None]}}, f
        )
    history = weather.read_weather_history(spark, f"{folder}/w.json")
    assert [tuple(r) for r in history.collect()] == [(D(2024, 1, 1), 1.5), (D(2024, 1, 2), None)]
    ahead = weather.read_weather_forecast(spark, f"{folder}/w.json", "2024-01-02", 35)
    assert ahead.columns == ["ds", *schemas.WEATHER]
    with open(f"{folder}/none.json", "w") as f:
        json.dump({"reason": "no data"}, f)
    assert weather.read_weather_history(spark, f"{folder}/none.json").count() == 0


def test_missing_variables_are_zero_and_horizon_is_capped(spark):
    days = spark.createDataFrame(
        [(D(2024, 1, 1) + dt.timedelta(days=k), 1.0) for k in range(40)], "ds date, temperature_2m_min double"
    )
    got = weather.limit_forecast(weather.complete_variables(days), "2024-01-01", 35)
    assert got.count() == 16
    assert got.first().snowfall_sum == 0.0


def test_scan_reaches_the_files(spark, folder):
    """Date bounds are pushed down and only the needed columns are read."""
    rows = spark.range(100).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("s").alias("SKU_ID"), F.lit("TF").alias("channel"), F.lit("U").alias("unit"),
        F.col("id").cast("double").alias("quantity"), F.lit(None).cast("double").alias("Promo_discount_perc"),
        F.lit("long text").alias("comment"),
    )
    rows.write.parquet(f"{folder}/sales")
    df = sales.daily_sales(spark.read.parquet(f"{folder}/sales"), start_date="2024-01-11", end_date="2024-01-20")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-11)" in plan and "comment" not in plan
    assert df.count() == 10
    bad = sales.daily_sales(spark.read.parquet(f"{folder}/sales"), start_date="2024-99-99")
    assert (bad.count(), bad.columns[3:]) == (0, ["ds", "y", "Promo_discount_perc", "is_promo"])


def test_tables(spark, folder):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 2), 2)], "k string, day date, n int"
    )
    path = f"{folder}/t"
    tables.append(df, path, ["day"])
    tables.append(df, path, ["day"])
    assert tables.read_table(spark, path).count() == 4
    tables.replace_partitions(df.where("k = 'a'"), path, ["day"])
    assert tables.read_table(spark, path).count() == 3
    tables.overwrite(df, path, ["day"])
    assert tables.read_table(spark, path).count() == 2
    tables.write_csv(df, f"{folder}/csv", ["day"])
    assert spark.read.option("header", True).csv(f"{folder}/csv").count() == 2
    assert tables.empty_like(df).count() == 0


def test_create_table_with_partition_and_description(spark, folder):
    for replace in (False, True):
        tables.create_table(
            spark, "landing_s", schemas.STOCKS, "filename_end_date", f"{folder}/s", "stock files", replace
        )
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED landing_s").collect()}
    assert described["Comment"] == "stock files"
    assert spark.table("landing_s").columns[-1] == "filename_end_date"
    spark.sql("DROP TABLE landing_s")


def test_newest_model_counts(spark, folder):
    models = spark.createDataFrame([("a", "TF", "U", 1.0)], "SKU_ID string, Channel string, Unit string, slope double")
    tables.write_models(models, f"{folder}/m", dt.datetime(2024, 1, 1))
    tables.write_models(models.withColumn("slope", F.lit(2.0)), f"{folder}/m", dt.datetime(2024, 1, 2))
    stored = tables.read_table(spark, f"{folder}/m")
    assert stored.count() == 2
    assert tables.latest_models(stored).first().slope == 2.0
    tables.write_results(models, f"{folder}/r", "run1")
    assert tables.read_table(spark, f"{folder}/r").first().run_id == "run1"


def test_settle(spark):
    assert durable.settle(spark.range(10)).count() == 10


def test_text_and_numbers(spark):
    df = spark.createDataFrame([(" \ta\n", "1,234.5"), ("b ", "n/a"), (None, None)], "s string, n string")
    got = df.select(text.strip(F.col("s")).alias("s"), text.parse_number(F.col("n")).alias("n"),
                    text.number_or_zero(F.col("n")).alias("z")).collect()
    assert [tuple(r) for r in got] == [("a", 1234.5, 0.0), ("b", None, 0.0), (None, None, 0.0)]
    odd = spark.createDataFrame([(1.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert odd.where(numeric.is_finite(F.col("x"))).count() == 1


def test_goods_and_warehouses(spark):
    assert len(dimensions.GOODS_TEXTS) == 34 and len(dimensions.GOODS_NUMBERS) == 5
    assert dimensions.warehouse_units(spark).select("unit").distinct().count() == 5


def test_repeated_rows_are_whole(spark):
    """Small, exact-chunk and very frequent rows; equal rows included."""
    chunk = durable.REPEAT_CHUNK
    counts = [("a", 1), ("b", chunk), ("c", chunk + 1), ("hot", 50 * chunk + 7), ("a", 2), (None, 3)]
    df = spark.createDataFrame(counts, "k string, n bigint")
    got = {r.k: r["count"] for r in durable.repeat_rows(df, "n").groupBy("k").count().collect()}
    assert got == {"a": 3, "b": chunk, "c": chunk + 1, "hot": 50 * chunk + 7, None: 3}
    sizes = durable.repeat_rows(df, "n").groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 25 * chunk


def test_shared_folder_is_the_one_the_cluster_names():
    """A scratch folder is made in local mode only."""

    def session(master, named=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: named or default),
            sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
        )

    assert durable.shared_folder(session("spark://m:7077", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        durable.shared_folder(session("spark://m:7077"))
    local = durable.shared_folder(session("local[2]"))
    assert local == durable.shared_folder(session("local[2]"))


def test_stock_rows_are_made_in_many_tasks(spark, sf):
    """A part makes 70 stock rows: they are not all made in the task that reads the parts."""
    from shelfcast.plans import standins

    assert standins.landing_stocks(spark, sf).rdd.getNumPartitions() >= 8
