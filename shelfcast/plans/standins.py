"""The input tables of the jobs, derived by Spark from the star-schema test tables.

Only arithmetic that is exact in every engine is used, so that SQL run elsewhere sees the
same rows.  Region and nation have 5 and 25 rows by definition; the other joins carry no
hint, so Spark decides from sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.durable import settle, spread
from shelfcast.functions.dates import closing_sunday, month_key, weekday_name
from shelfcast.schemas import WEATHER
from shelfcast.operators.ingest import seed_except_month
from shelfcast.sources.dimensions import GOODS_NUMBERS, GOODS_TEXTS, goods_attributes

#: The last sales date of the test tables, used wherever a reporting day is needed.
AS_OF = "2001-11-04"

#: Two units are served by two warehouses each.
WAREHOUSES = [
    ("W1", "AFRICA"),
    ("W2", "AMERICA"),
    ("W3", "ASIA"),
    ("W4", "EUROPE"),
    ("W5", "EUROPE"),
    ("W6", "MIDDLE EAST"),
    ("W7", "AFRICA"),
]

STOCK_SUNDAYS = 5

#: The month whose files the seed of the sales table leaves out.
SEED_WITHOUT = "2001-11"


#: Columns of the test tables that are used; a given schema spares a job per read.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, "
    "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def sales(spark: SparkSession, sf: str, sku: str = "p_type") -> DataFrame:
    """Sales lines; ``sku`` is the part column used as SKU_ID."""
    region = _read(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("unit"))
    nation = (
        _read(spark, sf, "nation")
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("n_name").alias("town"), "unit")
    )
    customer = (
        _read(spark, sf, "customer")
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("c_mktsegment").alias("channel"), "town", "unit")
    )
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    part = _read(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("SKU"), F.col(sku).cast("string").alias("SKU_ID")
    )
    line = _read(spark, sf, "lineitem")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_orderkey").cast("string").alias("document"),
            "unit",
            "town",
            F.col("o_custkey").cast("string").alias("customer_ID"),
            "channel",
            "SKU",
            "SKU_ID",
            F.when(F.col("l_discount") != 0, F.col("l_discount") * 100).alias(
                "Promo_discount_perc"
            ),
            F.when(returned, -F.col("l_quantity"))
            .otherwise(F.col("l_quantity"))
            .alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("l_extendedprice").alias("amount"),
            "l_linestatus",
        )
    )


def sku_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales at the grain of single parts."""
    return sales(spark, sf, "p_partkey")


def landing_sales(
    spark: SparkSession, sf: str, of_files: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Weekly files of all sales; open lines come again, restated, in the next file.

    ``of_files``: condition on a file's day; lines in no such file are left out before any join.
    """
    lines = sku_sales(spark, sf)
    own_file = closing_sunday(F.col("date"))
    files = F.when(
        F.col("l_linestatus") == "O", F.array(own_file, F.date_add(own_file, 7))
    ).otherwise(F.array(own_file))
    if of_files is not None:
        lines = lines.where(F.exists(files, of_files))
    filed = lines.select("*", F.posexplode(files).alias("_restated", "filename_end_date"))

    def padded(name: str) -> Column:
        return F.concat(F.lit(" "), F.col(name), F.lit("  ")).alias(name)

    return filed.select(
        "date",
        padded("document"),
        padded("unit"),
        padded("town"),
        padded("customer_ID"),
        F.concat(F.lit("T"), F.col("customer_ID"), F.lit(" ")).alias("customer_Tax_ID"),
        padded("SKU"),
        F.lit(None).cast("string").alias("Sales Rep"),
        "Promo_discount_perc",
        F.lit(None).cast("double").alias("Promo_discount_RUR"),
        F.lit(None).cast("string").alias("Document_for_discount"),
        padded("SKU_ID"),
        (F.col("quantity") + F.col("_restated")).alias("quantity"),
        "price",
        "amount",
        F.concat(
            F.lit("sales_"), F.date_format("filename_end_date", "yyyy-MM-dd"), F.lit(".csv ")
        ).alias("filename"),
        "filename_end_date",
        weekday_name(F.col("filename_end_date")).alias("weekday"),
    )


def seeded_sales(landing: DataFrame) -> DataFrame:
    """The clean sales table before the newest file: every file but November 2001's."""
    return seed_except_month(landing, SEED_WITHOUT)


def unseeded(file_day: Column) -> Column:
    """Whether the seed leaves a file out; no file day counts as left out."""
    return F.coalesce(month_key(file_day) == SEED_WITHOUT, F.lit(True))


def unseeded_sales(landing: DataFrame) -> DataFrame:
    """All that :func:`seeded_sales` leaves out, rows of no file day among it."""
    return landing.where(unseeded(F.col("filename_end_date")))


def landing_stocks(spark: SparkSession, sf: str) -> DataFrame:
    """Stock of every part and warehouse on five Sundays; each file restates the last one."""
    # every use of the rows would look for the last day among all lines
    last = _read(spark, sf, "lineitem").agg(F.max("l_shipdate").cast("date").alias("last"))
    last = settle(last, "last-day").scalar()
    days = F.array(*[F.date_sub(closing_sunday(last), 7 * k) for k in range(STOCK_SUNDAYS)])
    numbers = F.array(*[F.lit(n + 1) for n in range(len(WAREHOUSES))])
    # one row becomes 70: a few files' splits would be as many tasks with all of them
    parts = spread(_read(spark, sf, "part").select("p_partkey", "p_retailprice"), [])
    rows = (
        parts.select("p_partkey", "p_retailprice", F.explode(days).alias("date"))
        .select("*", F.explode(numbers).alias("warehouse_no"))
        .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("restated"))
    )
    stock = (
        (F.col("p_partkey") * 37 + F.col("warehouse_no") * 11 + F.dayofyear("date")) % 500
        + F.col("restated")
    ).cast("double")
    file_day = F.date_add("date", F.col("restated") * 7)
    return rows.select(
        "date",
        F.concat(F.lit("W"), F.col("warehouse_no").cast("string")).alias("warehouse"),
        F.col("p_partkey").cast("string").alias("SKU_ID"),
        F.col("p_retailprice").alias("price"),
        stock.alias("stock"),
        (stock * F.col("p_retailprice")).alias("total"),
        F.concat(F.lit("stock_"), F.date_format(file_day, "yyyy-MM-dd"), F.lit(".csv")).alias(
            "filename"
        ),
        file_day.alias("filename_end_date"),
        weekday_name(file_day).alias("weekday"),
    )


#: Days of the stock files that seed the clean stock table.
STOCK_SEED_FILES = ["2001-10-14", "2001-11-11"]


def warehouse_map(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame(WAREHOUSES, "warehouse string, unit string")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    nation = _read(spark, sf, "nation").select("n_nationkey", "n_name")
    none = F.lit(None).cast("string")
    named = {"parent_1_name": F.col("n_name"), "parent_3_name": F.col("c_mktsegment")}
    parents = [c for i in range(1, 7) for c in (f"parent_{i}", f"parent_{i}_name")]
    return (
        _read(spark, sf, "customer")
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("child_code"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("tax_id"),
            F.upper("c_name").alias("full_name"),
            *[named.get(c, none).alias(c) for c in parents],
            F.lit("1").alias("level"),
        )
    )


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "part").select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" ")).alias("SKU_ID"),
        F.col("p_brand").alias("parent_1_document"),
    )


def trimmed_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return catalog(spark, sf).withColumn("SKU_ID", F.trim("SKU_ID"))


def goods_source(spark: SparkSession, sf: str) -> DataFrame:
    """Goods with padded texts and numbers written with thousands commas, some unreadable."""
    texts = {
        "Code": F.concat(F.lit(" "), F.col("p_partkey").cast("string")),
        "Name": F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")),
        "Brand": F.concat(F.col("p_brand"), F.lit(" ")),
        "Segment": F.concat(F.lit(" "), F.col("p_type")),
    }
    size = F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" "))
    price = F.format_number(F.col("p_retailprice"), 2)
    numbers = {
        "gl": F.when(F.col("p_size") == 13, F.lit("n/a")).otherwise(price),
        "NetWeight": F.format_number(F.col("p_size") * 1000, 0),
    }
    return _read(spark, sf, "part").select(
        *[texts.get(c, size).alias(c) for c in GOODS_TEXTS],
        *[numbers.get(c, F.col("p_size").cast("string")).alias(c) for c in GOODS_NUMBERS],
    )


def goods(spark: SparkSession, sf: str) -> DataFrame:
    return goods_attributes(goods_source(spark, sf))


def forecasts(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    """Forecasts for each channel and unit a part was sold in; small sizes are not planned.

    Written once: reports read them several times, and they are made from all lines.
    """
    sold = lines.select(F.col("SKU_ID").alias("sku_id"), "channel", "unit").distinct()
    part = (
        _read(spark, sf, "part")
        .where(F.col("p_size") > 10)
        .select(F.col("p_partkey").cast("string").alias("sku_id"), "p_size")
    )
    kind = F.when(F.col("p_size") > 25, "Accurate").otherwise("Rough")
    planned = sold.join(part, "sku_id").select(
        "sku_id",
        "channel",
        "unit",
        (F.col("p_size") * 14).cast("double").alias("predicted_quantity"),
        kind.alias("Type of Forecast"),
    )
    return settle(planned, "forecasts")


def series_list(spark: SparkSession, sf: str) -> DataFrame:
    """The sold series as a list with untidy headers and padded values."""
    sold = sales(spark, sf).select("SKU_ID", "channel", "unit").distinct()
    return sold.select(
        F.concat(F.lit(" "), F.col("SKU_ID"), F.lit("\t")).alias(" sku_id"),
        F.col("channel").alias("CHANNEL"),
        F.concat(F.col("unit"), F.lit(" ")).alias("Unit "),
    )


def weather_values(day: Column) -> dict[str, Column]:
    warm = (F.dayofyear(day) * 7 % 45) - 10
    return {
        "temperature_2m_max": warm.cast("double"),
        "temperature_2m_min": (warm - 8).cast("double"),
        "precipitation_sum": (F.dayofyear(day) * 3 % 11).cast("double"),
        "snowfall_sum": F.when(warm < 0, F.dayofyear(day) % 5).otherwise(0).cast("double"),
    }


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Daily weather over the span of the shipments, a week more on both sides."""
    bounds = _read(spark, sf, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("first"),
        F.max("l_shipdate").cast("date").alias("last"),
    )
    days = bounds.select(
        F.explode(F.sequence(F.date_sub("first", 7), F.date_add("last", 7))).alias("ds")
    )
    return days.select("ds", *[v.alias(c) for c, v in weather_values(F.col("ds")).items()])


def weather_payload(spark: SparkSession, sf: str) -> DataFrame:
    """One payload per town and year, as JSON text, over the days the town was sold to.

    A payload holds at most 366 days.
    """
    sold = sales(spark, sf).select("town", F.col("date").alias("ds")).distinct()
    values = weather_values(F.col("ds"))
    day = F.struct(F.date_format("ds", "yyyy-MM-dd").alias("time"), *[
        v.alias(c) for c, v in values.items()
    ])
    packed = sold.groupBy("town", F.year("ds").alias("year")).agg(
        F.array_sort(F.collect_list(day)).alias("days")
    )

    def variable(name: str) -> Column:
        return F.transform("days", lambda d: d[name]).alias(name)

    arrays = [variable(c) for c in ["time", *WEATHER]]
    return packed.select(
        "town", "year", F.to_json(F.struct(F.struct(*arrays).alias("daily"))).alias("payload")
    )
