"""Public holidays as a rule on dates, so that no calendar has to be joined to the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import closing_sunday

#: Russian public holidays (labour code), month and day.
RU_HOLIDAYS = [
    "01-01",
    "01-02",
    "01-03",
    "01-04",
    "01-05",
    "01-06",
    "01-07",
    "01-08",
    "02-23",
    "03-08",
    "05-01",
    "05-09",
    "06-12",
    "11-04",
]
LABEL = "RU_Holiday"


def is_holiday(day: Column) -> Column:
    return F.date_format(day, "MM-dd").isin(RU_HOLIDAYS)


def week_holiday_flag(week: Column, match: str = "sunday") -> Column:
    """1.0 where the week counts as a holiday week, else 0.0.

    Weeks carry their closing Sunday's date and holidays have no extra days around them, so
    with ``'sunday'`` only a holiday on that very Sunday counts.  ``'week'`` flags a holiday
    on any of the seven days.
    """
    if match == "sunday":
        hit = is_holiday(week)
    elif match == "week":
        hit = is_holiday(week)
        for back in range(1, 7):
            hit = hit | is_holiday(F.date_sub(week, back))
    else:
        raise ValueError("match is 'sunday' or 'week'")
    return hit.cast("double")


#: Column with the flag of weeks that a holiday table decides.
GIVEN = "holiday"


def with_holiday_table(weekly: DataFrame, days: DataFrame, match: str = "sunday") -> DataFrame:
    """Weekly rows with ``holiday`` from a table of days off (``ds``), in place of the rule.

    For calendars that a rule cannot give, such as moved days off.  The table is reduced to its
    weeks, whose number the calendar bounds.
    """
    if match not in ("sunday", "week"):
        raise ValueError("match is 'sunday' or 'week'")
    week = closing_sunday(F.col("ds")) if match == "week" else F.col("ds")
    flagged = days.where("ds is not null").select(week.alias("ds")).distinct()
    flagged = flagged.withColumn(GIVEN, F.lit(1.0))
    joined = weekly.join(F.broadcast(flagged), "ds", "left")
    return joined.select(*weekly.columns, F.coalesce(GIVEN, F.lit(0.0)).alias(GIVEN))


def holiday_calendar(weekly: DataFrame, by: list[str], extra: DataFrame | None = None) -> DataFrame:
    """Holidays of each series within its first and last week.

    ``extra`` adds days from a table with a ``ds`` column, such as moved days off.
    """
    ranges = weekly.groupBy(*by).agg(F.min("ds").alias("_first"), F.max("ds").alias("_last"))
    years = ranges.select(
        "*", F.explode(F.sequence(F.year("_first"), F.year("_last"))).alias("_year")
    )
    month_days = F.explode(F.array(*[F.lit(d) for d in RU_HOLIDAYS]))
    days = years.select("*", month_days.alias("_md")).select(
        *by,
        "_first",
        "_last",
        F.concat_ws("-", F.lpad(F.col("_year").cast("string"), 4, "0"), "_md")
        .cast("date")
        .alias("ds"),
    )
    days = days.where(F.col("ds").between(F.col("_first"), F.col("_last"))).select(*by, "ds")
    if extra is not None:
        # One row per calendar day at most.
        moved = F.broadcast(
            extra.select(F.col("ds").alias("_day"), F.year("ds").alias("_year")).distinct()
        )
        more = years.join(moved, "_year").where(
            F.col("_day").between(F.col("_first"), F.col("_last"))
        )
        days = days.unionByName(more.select(*by, F.col("_day").alias("ds"))).distinct()
    return days.select(
        *by,
        "ds",
        F.lit(LABEL).alias("holiday"),
        F.lit(0).alias("lower_window"),
        F.lit(0).alias("upper_window"),
    )


def series_years(weekly: DataFrame, by: list[str]) -> DataFrame:
    """The years each series touches."""
    return weekly.select(*by, F.year("ds").alias("year")).distinct()


