"""Weekly snapshots of the last four complete weeks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import as_of_day, iso_day, latest_sunday
from shelfcast.operators.ingest import LOADED
from shelfcast.schemas import FROZEN_SALES, FROZEN_STOCKS

#: Fixed value: four weeks, the closing Sunday included.
DAYS_BACK = 27

AsOf = str | dt.date | Column | None


def in_window(as_of: AsOf) -> Column:
    last = latest_sunday(as_of_day(as_of))
    return F.col("date").between(F.date_sub(last, DAYS_BACK), last)


def window_note(as_of: AsOf) -> Column:
    """The window as text for the log."""
    last = latest_sunday(as_of_day(as_of))
    return F.format_string(
        "Latest Sunday: %s, Start date: %s",
        iso_day(last),
        iso_day(F.date_sub(last, DAYS_BACK)),
    )


def frozen_sales(
    sales: DataFrame, customers: DataFrame, catalog: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Sales of the window with contract and channel; unmatched lines keep NULL there.

    The date window prunes partitions before the joins.
    """
    lines = sales.where(in_window(as_of)).select(
        "date", "unit", "customer_ID", "SKU", "Promo_discount_perc", "SKU_ID",
        "quantity", "price", "amount",
    )
    channels = customers.select(
        F.col("child_code").alias("customer_ID"), F.col("parent_3_name").alias("channel")
    )
    contracts = catalog.select("SKU_ID", F.col("parent_1_document").alias("contract"))
    return (
        lines.join(channels, "customer_ID", "left")
        .join(contracts, "SKU_ID", "left")
        .select(*FROZEN_SALES.names)
    )


def empty_frozen_sales(sales: DataFrame) -> DataFrame:
    """The empty snapshot table: contract and channel are typed NULLs."""
    return sales.where(F.lit(False)).select(
        "date",
        "unit",
        "customer_ID",
        F.lit(None).cast("string").alias("contract"),
        F.lit(None).cast("string").alias("channel"),
        "SKU",
        "Promo_discount_perc",
        "SKU_ID",
        "quantity",
        "price",
        "amount",
    )


def frozen_stocks(stocks: DataFrame, as_of: AsOf = None) -> DataFrame:
    return stocks.where(in_window(as_of)).select(*FROZEN_STOCKS.names)


def refresh_audit(frozen: DataFrame, destination: str, as_of: AsOf = None) -> DataFrame:
    """One audit row with the number of rows in the snapshot, also when that is 0."""
    day = as_of_day(as_of)
    return frozen.agg(F.count(F.lit(1)).alias("n")).select(
        iso_day(day).alias("ingestion_date"),
        F.lit("weekly_refresh").alias("file_name"),
        F.lit(destination).alias("destination_table"),
        F.lit(LOADED).alias("status"),
        latest_sunday(day).cast("timestamp_ntz").alias("date_from_file_name"),
        F.lit("Sunday").alias("day_from_file_name"),
        F.col("n").alias("no_of_records"),
    )
