"""Stock cover report and the queries on top of it.

The report has one row per sales line of the last sales day, but lines with the same SKU, name,
unit and channel have the same report row.  Lines are therefore counted per combination, which
collapses hot SKUs before anything is shuffled; values are looked up once per combination, and
the report rows are repeated at the end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.durable import repeat_rows
from shelfcast.functions.dates import as_of_day

#: Days looked back, days the totals are divided by, forecast kind used.
LOOK_BACK_DAYS = 15
AVERAGE_DAYS = 14
FORECAST_KIND = "Accurate"

AsOf = str | dt.date | Column | None

def recent_sales(sales: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Trimmed sales of the look-back window; the date bound prunes partitions."""
    return sales.where(F.col("date") >= F.date_sub(as_of_day(as_of), LOOK_BACK_DAYS)).select(
        "date",
        *[F.trim(c).alias(c) for c in ("unit", "customer_ID", "SKU", "SKU_ID")],
        "quantity",
        "amount",
    )


def window_by_day(recent: DataFrame) -> DataFrame:
    """Lines and totals of each SKU, unit, customer and day.

    Lines, last day and averages of the report all come from this one exchange.
    """
    return recent.groupBy("SKU_ID", "SKU", "unit", "customer_ID", "date").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.sum("amount").alias("amount"),
    )


def sales_averages(recent: DataFrame) -> DataFrame:
    """Daily averages per SKU and unit: window totals over 14."""
    return recent.groupBy("SKU_ID", "unit").agg(
        (F.sum("quantity") / AVERAGE_DAYS).alias("average_quantity"),
        (F.sum("amount") / AVERAGE_DAYS).alias("average_amount"),
    )


def latest_stock(
    stocks: DataFrame, warehouse_map: DataFrame, stock_by_unit: bool = False
) -> DataFrame:
    """Stock on the last stock date, per SKU and warehouse with the unit it serves.

    A unit with two warehouses has two rows per SKU, and the report repeats its lines for
    them.  ``stock_by_unit`` adds them up instead.
    """
    snapshot = stocks.where(F.col("date") == stocks.agg(F.max("date")).scalar())
    units = warehouse_map.select("warehouse", F.col("unit").alias("mapped_unit"))
    per_warehouse = (
        snapshot.groupBy("SKU_ID", "warehouse")
        .agg(F.sum("stock").alias("stock"))
        .join(units, "warehouse", "left")
    )
    if not stock_by_unit:
        return per_warehouse.select("SKU_ID", "warehouse", "mapped_unit", "stock")
    return per_warehouse.groupBy("SKU_ID", "mapped_unit").agg(F.sum("stock").alias("stock"))


def forecast_totals(forecasts: DataFrame) -> DataFrame:
    return (
        forecasts.where(F.col("Type of Forecast") == FORECAST_KIND)
        .groupBy("sku_id", "channel", "unit")
        .agg(F.sum("predicted_quantity").alias("predicted_quantity"))
    )


def report_by_combination(
    sales: DataFrame,
    stocks: DataFrame,
    customers: DataFrame,
    goods: DataFrame,
    catalog: DataFrame,
    forecasts: DataFrame,
    warehouse_map: DataFrame,
    as_of: AsOf = None,
    stock_by_unit: bool = False,
) -> DataFrame:
    """The report with equal lines folded into one row and counted in ``lines``."""
    recent = window_by_day(recent_sales(sales, as_of))
    channels = customers.select(
        F.col("child_code").alias("customer_ID"), F.col("parent_3_name").alias("channel")
    )
    sold = (
        recent.where(F.col("date") == recent.agg(F.max("date")).scalar())
        .groupBy("SKU_ID", "SKU", "unit", "customer_ID")
        .agg(F.sum("lines").alias("lines"))
        .join(channels, "customer_ID", "left")
        .groupBy("SKU_ID", "SKU", "unit", "channel")
        .agg(F.sum("lines").alias("lines"))
    )
    stock = latest_stock(stocks, warehouse_map, stock_by_unit).select(
        "SKU_ID", F.col("mapped_unit").alias("unit"), "stock"
    )
    volumes = goods.select(F.col("Код").alias("SKU_ID"), F.col("гл").alias("gl"))
    contracts = catalog.select(
        F.trim("SKU_ID").alias("SKU_ID"), F.col("parent_1_document").alias("contract")
    )
    predicted = forecast_totals(forecasts).select(
        F.trim("sku_id").alias("SKU_ID"),
        F.trim("unit").alias("unit"),
        F.trim("channel").alias("_channel"),
        "predicted_quantity",
    )
    items = F.coalesce(F.col("stock"), F.lit(0.0))
    pace = F.col("average_quantity")
    return (
        sold.withColumn("_channel", F.trim("channel"))
        .join(stock, ["SKU_ID", "unit"], "left")
        .join(sales_averages(recent), ["SKU_ID", "unit"], "left")
        .join(volumes, "SKU_ID", "left")
        .join(contracts, "SKU_ID", "left")
        .join(predicted, ["SKU_ID", "unit", "_channel"], "left")
        .select(
            as_of_day(as_of).alias("report_date"),
            F.col("SKU_ID").alias("sku_id"),
            F.col("SKU").alias("sku_name"),
            "channel",
            "contract",
            "unit",
            items.alias("current_stock_items"),
            F.round(items * F.col("gl"), 2).alias("current_stock_HL"),
            F.when(pace > 0, F.round(F.try_divide(items, pace))).alias("days_of_stock_remaining"),
            F.round(pace).alias("hist_avg_daily_quantity_14d"),
            F.round(F.col("predicted_quantity") / AVERAGE_DAYS).alias(
                "predicted_avg_daily_quantity_14d"
            ),
            "lines",
        )
    )


def stock_cover_report(*inputs: DataFrame, **options) -> DataFrame:
    """Stock, days of cover, recent and predicted daily averages for the last day's lines.

    Takes the arguments of :func:`report_by_combination` and has one row per sales line (and
    matching warehouse, goods, catalog and forecast row).
    """
    return repeat_rows(report_by_combination(*inputs, **options), "lines")


def with_forecast(report: DataFrame) -> DataFrame:
    return report.where(F.col("predicted_avg_daily_quantity_14d").isNotNull())


def skus_with_any_forecast(report: DataFrame, forecasts: DataFrame) -> DataFrame:
    """How many SKUs of the report have a forecast of any kind.

    Either form of the report will do.
    """
    known = forecasts.select(F.trim("sku_id").alias("_sku")).distinct()
    return (
        report.select("sku_id", F.trim("sku_id").alias("_sku"))
        .distinct()
        .join(known, "_sku", "left_semi")
        .agg(F.countDistinct("sku_id").alias("skus"))
    )


def forecast_beside_report(forecasts: DataFrame, combinations: DataFrame) -> DataFrame:
    """Forecast rows next to the report rows of the same SKU, whatever channel or unit.

    ``combinations`` is the folded report: the join sees each SKU, channel and unit once, and
    the rows are repeated after it.
    """
    rows = forecasts.where(F.col("Type of Forecast") == FORECAST_KIND).select(
        "sku_id", "channel", "unit", "predicted_quantity", F.trim("sku_id").alias("_sku")
    )
    beside = (
        combinations.groupBy(
            F.trim("sku_id").alias("_sku"),
            F.col("channel").alias("b_channel"),
            F.col("unit").alias("b_unit"),
        )
        .agg(F.sum("lines").alias("lines"))
    )
    return repeat_rows(rows.join(beside, "_sku").drop("_sku"), "lines")


def qualified_skus(
    sales: DataFrame, since: str, min_days: int, seen_by: str, seen_from: str
) -> DataFrame:
    """SKUs sold on more than ``min_days`` days since ``since``, both up to ``seen_by`` and
    from ``seen_from`` on, with their quantity range."""
    return (
        sales.where(F.col("date") >= F.lit(since).cast("date"))
        .groupBy("SKU_ID")
        .agg(
            F.countDistinct("date").alias("days"),
            F.min("date").alias("_first"),
            F.max("date").alias("_last"),
            F.min("quantity").alias("min_quantity"),
            F.max("quantity").alias("max_quantity"),
        )
        .where(
            (F.col("days") > min_days)
            & (F.col("_first") <= F.lit(seen_by).cast("date"))
            & (F.col("_last") >= F.lit(seen_from).cast("date"))
        )
        .drop("_first", "_last")
    )


def qualified_skus_by_contract(qualified: DataFrame, catalog: DataFrame) -> DataFrame:
    """Number of qualified SKUs per contract, most first."""
    contracts = catalog.select("SKU_ID", F.col("parent_1_document").alias("contract"))
    return (
        qualified.join(contracts, "SKU_ID")
        .groupBy("contract")
        .agg(F.countDistinct("SKU_ID").alias("skus"))
        .orderBy(F.desc("skus"), "contract")
    )
