"""Folding daily files into the clean, date-partitioned tables.

A file restates every date it contains.  The daily merge loads the newest file; the replay
loads all files at once with the outcome of loading them one after the other.

Scalars (latest file date and the like) stay inside the plan as scalar subqueries.  The only
joins are with a set of calendar dates, whose size is bounded by the calendar and not by the
data, so the fact rows are never shuffled, even when one date holds a third of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import as_of_day, iso_day, month_key, weekday_name
from shelfcast.functions.text import trim_text_columns
from shelfcast.sources import published
from shelfcast.sources.tables import read_table, replace_partitions

# Fixed values of the audit and placeholder rows.
PLACEHOLDER = "placeholder_for_missing_date"
LOADED = "success"
NOTHING_NEW = "No newer data available in landing table"

FILE_DAY = "filename_end_date"

#: Sorts before every real file date.
SEED_PRIORITY = "0001-01-01"


def seed_except_month(landing: DataFrame, month: str) -> DataFrame:
    """First load: every file but those of one month (``yyyy-MM``)."""
    return landing.where(month_key(F.col(FILE_DAY)) != month)


def seed_from_files(landing: DataFrame, file_days: list[str]) -> DataFrame:
    """First load: only the files of the given days."""
    return landing.where(F.col(FILE_DAY).isin([F.lit(d).cast("date") for d in file_days]))


def latest_file_day(table: DataFrame) -> Column:
    return table.agg(F.max(FILE_DAY)).scalar()


def loaded_upto(audit: DataFrame, destination: str) -> Column:
    """The newest file day that the load audit has for a table."""
    mine = audit.where((F.col("destination_table") == destination) & (F.col("status") == LOADED))
    return mine.agg(F.max("date_from_file_name").cast("date")).scalar()


def newest_file(
    main: DataFrame, landing: DataFrame, upto: Column | None = None
) -> DataFrame:
    """Rows of the newest landing file, or none unless it is newer than all of ``main``.

    ``upto`` is the newest file day of ``main`` where something knows it (see
    :func:`loaded_upto`); otherwise a column of ``main`` is read for it.  With an empty ``main``
    the comparison is unknown and nothing is loaded.
    """
    latest = latest_file_day(landing)
    known = latest_file_day(main) if upto is None else upto
    return landing.where((F.col(FILE_DAY) == latest) & (latest > known))


def restated_days(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("date").isNotNull()).select("date").distinct()


def placeholder_row(newest: DataFrame) -> DataFrame:
    """One row for the file's end date when its data stops earlier; otherwise none.

    Everything is NULL except the dates, a marker as file name and the weekday's name.
    """
    reach = newest.agg(F.max(FILE_DAY).alias("_end"), F.max("date").alias("_last")).where(
        F.col("_last") < F.col("_end")
    )
    known = {
        "date": F.col("_end"),
        FILE_DAY: F.col("_end"),
        "filename": F.lit(PLACEHOLDER),
        "weekday": weekday_name(F.col("_end")),
    }
    return reach.select(
        *[
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in newest.schema.fields
        ]
    )


def replace_days(main: DataFrame, rows: DataFrame) -> DataFrame:
    """``main`` with every date present in ``rows`` replaced by those rows.

    Rows without a date never match a date: old ones stay and new ones are added.
    """
    kept = main.join(F.broadcast(restated_days(rows)), "date", "left_anti")
    return kept.select(*main.columns).unionByName(rows)


def daily_merge(
    main: DataFrame,
    landing: DataFrame,
    trim: bool = False,
    placeholder: bool = False,
    upto: Column | None = None,
) -> DataFrame:
    """``main`` after the newest landing file has been folded in.

    The sales table uses ``trim`` and ``placeholder``, the stock table neither.
    """
    newest = newest_file(main, landing, upto)
    loaded = trim_text_columns(newest) if trim else newest
    merged = replace_days(main, loaded)
    return merged.unionByName(placeholder_row(newest)) if placeholder else merged


def load_audit(
    rows: DataFrame,
    destination: str,
    as_of: str | dt.date | Column | None = None,
    trim: bool = True,
) -> DataFrame:
    """One audit row per loaded file; none when nothing was loaded.

    ``trim`` cleans the file name, as the sales load does and the stock load does not.
    """
    name = F.trim("filename") if trim else F.col("filename")
    # Counted by name first: a maximum of texts sorts what it reads, which are then a few names.
    return (
        rows.groupBy(FILE_DAY, name.alias("file_name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(FILE_DAY)
        .agg(F.max("file_name").alias("file_name"), F.sum("n").alias("n"))
        .select(
            iso_day(as_of_day(as_of)).alias("ingestion_date"),
            "file_name",
            F.lit(destination).alias("destination_table"),
            F.lit(LOADED).alias("status"),
            F.col(FILE_DAY).cast("timestamp_ntz").alias("date_from_file_name"),
            weekday_name(F.col(FILE_DAY)).alias("day_from_file_name"),
            F.col("n").alias("no_of_records"),
        )
    )


def load_status(main: DataFrame, landing: DataFrame) -> DataFrame:
    """One row: ``success``, or the message that there is nothing newer."""
    reach = landing.agg(F.max(FILE_DAY).alias("landing_day")).select(
        "landing_day", latest_file_day(main).alias("main_day")
    )
    return reach.withColumn(
        "status",
        F.when(F.col("landing_day") > F.col("main_day"), LOADED).otherwise(NOTHING_NEW),
    )


def with_priority(landing: DataFrame, seed_days: list[str]) -> DataFrame:
    """Seed files come first whatever their own date, the others by file date."""
    seeded = F.col(FILE_DAY).isin([F.lit(d).cast("date") for d in seed_days])
    priority = F.when(seeded, F.lit(SEED_PRIORITY).cast("date")).otherwise(F.col(FILE_DAY))
    return landing.where(F.col(FILE_DAY).isNotNull()).withColumn("_priority", priority)


def replay(landing: DataFrame, seed_days: list[str] | None = None) -> DataFrame:
    """The table after loading the seed files and then every other file by date.

    Per date the last file wins; rows without a date are never deleted, so all of them stay.
    """
    ranked = with_priority(landing, seed_days or [])
    winners = (
        ranked.where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(F.max("_priority").alias("_wins"))
    )
    judged = ranked.join(F.broadcast(winners), "date", "left")
    keep = F.col("date").isNull() | (F.col("_priority") == F.col("_wins"))
    return judged.where(keep).select(*landing.columns)


def replay_audit(
    landing: DataFrame,
    destination: str,
    seed_days: list[str] | None = None,
    as_of: str | dt.date | Column | None = None,
) -> DataFrame:
    """One audit row per file loaded after the seed."""
    later = with_priority(landing, seed_days or []).where(F.col("_priority") != SEED_PRIORITY)
    return load_audit(later.select(*landing.columns), destination, as_of, trim=False)


def merged_partitions(
    main: DataFrame,
    landing: DataFrame,
    trim: bool = False,
    placeholder: bool = False,
    upto: Column | None = None,
) -> DataFrame:
    """All rows of the partitions of ``main`` that the newest landing file changes.

    Rows that the file does not restate but that share a partition with new ones are among
    them: those without a date, and those of the placeholder's date.
    """
    newest = newest_file(main, landing, upto)
    changed = trim_text_columns(newest) if trim else newest
    undated = changed.where(F.col("date").isNull()).agg(F.count(F.lit(1))).scalar()
    beside = main.where(F.col("date").isNull() & (undated > 0))
    if placeholder:
        extra = placeholder_row(newest)
        same_day = main.where(F.col("date") == extra.agg(F.max("date")).scalar())
        changed = changed.unionByName(extra).unionByName(same_day)
    return changed.unionByName(beside)


def merge_into_table(
    landing: DataFrame,
    main_path: str,
    trim: bool = False,
    placeholder: bool = False,
    upto: Column | None = None,
) -> None:
    """Fold the newest landing file into a stored table, touching only its own dates.

    All changed dates go out in one write.  The storage must commit a dynamic partition
    overwrite at once, or readers must wait for it: the partitions are read and replaced in
    place.  :func:`merge_and_publish` asks neither.
    """
    main = read_table(landing.sparkSession, main_path, landing.schema)
    replace_partitions(merged_partitions(main, landing, trim, placeholder, upto), main_path, ["date"])


def merge_and_publish(
    landing: DataFrame,
    main_path: str,
    trim: bool = False,
    placeholder: bool = False,
    upto: Column | None = None,
) -> int:
    """The same for a published table: readers see it before or after the file, never between."""
    spark = landing.sparkSession
    base = published.latest(spark, main_path)
    main = published.read(spark, main_path, landing.schema, base)
    changed = merged_partitions(main, landing, trim, placeholder, upto)
    return published.publish(changed, main_path, ["date"], base)
