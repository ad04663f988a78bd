"""Column names and explicit schemas of the tables the jobs read and write.

Fixed values: the column names are part of the data contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ["SKU_ID", "Channel", "Unit"]
PROMO = ["Promo_discount_perc", "is_promo"]
TEMPERATURES = ["temperature_2m_max", "temperature_2m_min"]
PRECIPITATION = ["precipitation_sum", "snowfall_sum"]
WEATHER = TEMPERATURES + PRECIPITATION
LAG = "y_lag1"


_KINDS = {
    "date": T.DateType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _table(columns: str) -> T.StructType:
    """Schema from ``name kind`` pairs; built without a session, so importable anywhere."""
    pairs = (c.strip().rsplit(" ", 1) for c in columns.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


SALES = _table(
    "date date, document string, unit string, town string, customer_ID string, "
    "customer_Tax_ID string, SKU string, Sales Rep string, Promo_discount_perc double, "
    "Promo_discount_RUR double, Document_for_discount string, SKU_ID string, quantity double, "
    "price double, amount double, filename string, filename_end_date date, weekday string"
)

STOCKS = _table(
    "date date, warehouse string, SKU_ID string, price double, stock double, total double, "
    "filename string, filename_end_date date, weekday string"
)

LOAD_AUDIT = _table(
    "ingestion_date string, file_name string, destination_table string, status string, "
    "date_from_file_name timestamp_ntz, day_from_file_name string, no_of_records bigint"
)

FROZEN_SALES = _table(
    "date date, unit string, customer_ID string, contract string, channel string, SKU string, "
    "Promo_discount_perc double, SKU_ID string, quantity double, price double, amount double"
)

FROZEN_STOCKS = _table(
    "date date, warehouse string, SKU_ID string, price double, stock double, total double"
)

CUSTOMERS = _table(
    "child_code string, name string, tax_id string, full_name string, "
    + ", ".join(f"parent_{i} string, parent_{i}_name string" for i in range(1, 7))
    + ", level string"
)

CATALOG = _table("SKU_ID string, parent_1_document string")

FORECASTS = _table(
    "sku_id string, channel string, unit string, predicted_quantity double, "
    "Type of Forecast string"
)

SERIES_LIST = _table("SKU_ID string, Channel string, Unit string")

WEATHER_PAYLOAD = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in WEATHER]
            ),
        )
    ]
)

HOLIDAYS = _table("ds date, holiday string, lower_window int, upper_window int")

PARAMETERS = [
    "changepoint_prior_scale",
    "seasonality_prior_scale",
    "holidays_prior_scale",
    "seasonality_mode",
    "changepoint_range",
]

METRICS = ["MAE", "RMSE", "sMAPE", "WAPE"]
