"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\r\n\x0b\x0c"


def strip(col: Column) -> Column:
    """Remove blanks, tabs and line ends on both sides (``trim`` removes blanks only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def parse_number(col: Column) -> Column:
    """Text with thousands commas as double; NULL where it is no number."""
    return F.replace(col, F.lit(","), F.lit("")).try_cast("double")


def number_or_zero(col: Column) -> Column:
    """Anything as double; 0 where it is missing or no number."""
    return F.coalesce(col.try_cast("double"), F.lit(0.0))


def trim_text_columns(df: DataFrame) -> DataFrame:
    """Trim every string column, leaving column order and the other types alone."""
    return df.select(
        *[
            F.trim(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def match_headers(found: list[str], wanted: list[str]) -> dict[str, str]:
    """Map each wanted name to the column that carries it, ignoring case and outer blanks."""
    by_key = {name.strip().lower(): name for name in found}
    missing = [name for name in wanted if name.lower() not in by_key]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return {name: by_key[name.lower()] for name in wanted}
