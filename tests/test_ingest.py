"""File merges, replay, snapshots of stored tables, arriving files."""

import datetime as dt
import random
from pathlib import Path

from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import frozen, ingest
from shelfcast.sources import tables
from shelfcast.streaming import landing as arriving

D = dt.date
STOCK = "date date, warehouse string, SKU_ID string, price double, stock double, total double, filename string, filename_end_date date, weekday string"


def stock_rows(spark, rows):
    """Rows from ``(day or None, file day, stock)``."""
    data = [(d, "W1", "s", 1.0, float(n), float(n), f"f_{f}.csv", f, "x") for d, f, n in rows]
    return spark.createDataFrame(data, STOCK)


def content(df):
    return sorted(
        (str(r.date), str(r.filename_end_date), r.stock) for r in df.select("date", "filename_end_date", "stock").collect()
    )


def one_by_one(rows, seeds):
    """Delete and append, file after file."""
    table = [r for r in rows if r[1] in seeds]
    for f in sorted({r[1] for r in rows} - set(seeds)):
        fresh = [r for r in rows if r[1] == f]
        days = {r[0] for r in fresh if r[0] is not None}
        table = [r for r in table if r[0] not in days] + fresh
    return sorted((str(d), str(f), float(n)) for d, f, n in table)


def random_files(seed):
    rng = random.Random(seed)
    rows = []
    for f in range(1, 8):
        for _ in range(rng.randint(1, 6)):
            day = None if rng.random() < 0.2 else D(2024, 1, rng.randint(1, 6))
            rows.append((day, D(2024, 2, f), rng.randint(0, 99)))
    return rows, [D(2024, 2, 3), D(2024, 2, 6)]


def test_replay_equals_loading_one_by_one(spark):
    for seed in range(5):
        rows, seeds = random_files(seed)
        got = ingest.replay(stock_rows(spark, rows), [str(s) for s in seeds])
        assert content(got) == one_by_one(rows, seeds)


def test_merge_loads_newest_file_only(spark):
    main = stock_rows(spark, [(D(2024, 1, 1), D(2024, 1, 1), 1), (D(2024, 1, 2), D(2024, 1, 2), 2)])
    landing = stock_rows(
        spark,
        [(D(2024, 1, 1), D(2024, 1, 3), 30), (D(2024, 1, 2), D(2024, 1, 4), 40), (None, D(2024, 1, 4), 41)],
    )
    assert content(ingest.daily_merge(main, landing)) == [
        ("2024-01-01", "2024-01-01", 1.0),
        ("2024-01-02", "2024-01-04", 40.0),
        ("None", "2024-01-04", 41.0),
    ]
    again = ingest.daily_merge(landing, landing)
    assert content(again) == content(landing)
    empty = ingest.daily_merge(main.limit(0), landing)
    assert content(empty) == []
    assert ingest.load_status(main, landing).first().status == ingest.LOADED
    assert ingest.load_status(landing, landing).first().status == ingest.NOTHING_NEW


def test_placeholder_only_when_data_stops_early(spark):
    short = stock_rows(spark, [(D(2024, 1, 5), D(2024, 1, 7), 1)])
    got = ingest.placeholder_row(short).collect()
    assert [(r.date, r.filename, r.weekday, r.stock) for r in got] == [
        (D(2024, 1, 7), ingest.PLACEHOLDER, "Sunday", None)
    ]
    assert ingest.placeholder_row(stock_rows(spark, [(D(2024, 1, 7), D(2024, 1, 7), 1)])).count() == 0


def test_hot_date_keeps_every_row(spark):
    """A third of all rows on one date, in one file that wins and one that loses."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(
            F.date_add(F.lit("2024-01-02").cast("date"), (F.col("id") % 200).cast("int")).cast("string")
        ).cast("date").alias("date"),
        F.lit("W1").alias("warehouse"), F.lit("s").alias("SKU_ID"), F.lit(1.0).alias("price"),
        F.col("id").cast("double").alias("stock"), F.lit(1.0).alias("total"), F.lit("f").alias("filename"),
        F.lit("2024-02-01").cast("date").alias("filename_end_date"), F.lit("x").alias("weekday"),
    )
    older = base.withColumn("filename_end_date", F.lit("2024-01-31").cast("date"))
    got = ingest.replay(older.unionByName(base))
    assert got.count() == 3000
    assert got.where("date = '2024-01-01'").count() == 1000
    assert got.select("filename_end_date").distinct().count() == 1


def test_stored_table_rewrites_only_restated_dates(spark, folder):
    path = f"{folder}/main"
    main = stock_rows(
        spark,
        [(D(2024, 1, 1), D(2024, 1, 1), 1), (D(2024, 1, 2), D(2024, 1, 2), 2), (D(2024, 1, 7), D(2024, 1, 2), 7)],
    )
    tables.overwrite(main, path, ["date"])
    landing = stock_rows(spark, [(D(2024, 1, 2), D(2024, 1, 7), 20)])
    ingest.merge_into_table(landing, path, trim=True, placeholder=True)
    got = tables.read_table(spark, path, landing.schema)
    want = [
        ("2024-01-01", "1.0", "f_2024-01-01.csv"),
        ("2024-01-02", "20.0", "f_2024-01-07.csv"),
        ("2024-01-07", "7.0", "f_2024-01-02.csv"),
        ("2024-01-07", "None", ingest.PLACEHOLDER),
    ]
    assert sorted((str(r.date), str(r.stock), r.filename) for r in got.collect()) == want
    ingest.merge_into_table(landing, path, trim=True, placeholder=True)
    assert tables.read_table(spark, path, landing.schema).count() == 4


def test_merge_scan_prunes_partitions(spark, folder):
    """The newest file is found by a partition filter, not by reading all files."""
    path = f"{folder}/landing"
    rows = [(D(2024, 1, d), D(2024, 2, d), d) for d in range(1, 8)]
    tables.overwrite(stock_rows(spark, rows), path, ["filename_end_date"])
    landing = tables.read_table(spark, path, stock_rows(spark, rows).schema)
    newest = ingest.newest_file(landing.where("filename_end_date < '2024-02-07'"), landing)
    assert content(newest) == [("2024-01-07", "2024-02-07", 7.0)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(filename_end_date" in plan


def test_arriving_files_end_in_the_replayed_table(spark, folder):
    """File days in many part files, one part file in a micro-batch, and a batch run twice."""
    rows, _ = random_files(11)
    landing, main, state = (f"{folder}/{n}" for n in ("landing", "main", "state"))
    schema = stock_rows(spark, rows).schema
    tables.overwrite(stock_rows(spark, []), main, ["date"])
    files = sorted({r[1] for r in rows})
    for some in (files[:2], files[2:4], files[4:]):
        for f in some:
            parts = stock_rows(spark, [r for r in rows if r[1] == f]).repartition(3)
            parts.write.mode("append").parquet(landing)
        query = arriving.fold_arriving_files(spark, landing, schema, main, state, max_files_per_batch=1)
        query.awaitTermination(300)
        assert query.exception() is None
    got = tables.read_table(spark, main, schema)
    assert content(got) == one_by_one(rows, [])
    arrived = spark.read.parquet(f"{state}-arrived")
    for number in (0, 5):
        again = arrived.where(arrived["_batch"] == number).select(*schema.names)
        again = spark.createDataFrame(again.collect(), schema)
        arriving.fold_batch(again, main, f"{state}-arrived", number)
        assert content(tables.read_table(spark, main, schema)) == one_by_one(rows, [])


def test_stored_merge_equals_the_merge_of_frames(spark, folder):
    """Files one after the other, with undated rows and placeholders."""
    for seed, placeholder in ((1, False), (2, True), (3, True)):
        rows, _ = random_files(seed)
        files = sorted({r[1] for r in rows})
        path = f"{folder}/main{seed}"
        main = stock_rows(spark, [r for r in rows if r[1] == files[0]])
        tables.overwrite(main, path, ["date"])
        for upto in range(2, len(files) + 1):
            landing = stock_rows(spark, [r for r in rows if r[1] in files[:upto]])
            ingest.merge_into_table(landing, path, placeholder=placeholder)
            merged = ingest.daily_merge(main, landing, placeholder=placeholder)
            main = spark.createDataFrame(merged.collect(), landing.schema)
            key = lambda df: sorted(map(str, df.select("date", "filename", "stock").collect()))
            assert key(tables.read_table(spark, path, landing.schema)) == key(main)


def test_audit_schema_and_partition_day(spark):
    audit = ingest.load_audit(stock_rows(spark, [(D(2024, 1, 7), D(2024, 1, 7), 1)]), "main", "2024-01-08")
    assert [(f.name, f.dataType) for f in audit.schema] == [
        (f.name, f.dataType) for f in schemas.LOAD_AUDIT
    ]
    row = tables.with_partition_day(audit, "date_from_file_name", "day").first()
    assert (row.day, row.ingestion_date, row.no_of_records) == (D(2024, 1, 7), "2024-01-08", 1)


def test_empty_snapshot_has_typed_columns(spark):
    sales = spark.createDataFrame([], schemas.SALES)
    empty = frozen.empty_frozen_sales(sales)
    assert [(f.name, f.dataType) for f in empty.schema] == [
        (f.name, f.dataType) for f in schemas.FROZEN_SALES
    ]


def test_arriving_batch_reads_only_near_partitions(spark, folder):
    """Stored partitions outside the span of the batch are not listed for reading."""
    path = f"{folder}/main"
    rows = [(D(2024, 1, d), D(2024, 1, d), d) for d in range(1, 20)]
    tables.overwrite(stock_rows(spark, rows), path, ["date"])
    before = {p.name: p.stat().st_mtime_ns for p in Path(path).glob("date=*")}
    arriving.fold_batch(
        stock_rows(spark, [(D(2024, 1, 5), D(2024, 2, 1), 50)]), path, f"{folder}/arrived", 0
    )
    after = {p.name: p.stat().st_mtime_ns for p in Path(path).glob("date=*")}
    assert {n for n in before if before[n] != after[n]} == {"date=2024-01-05"}
    assert tables.read_table(spark, path).where("date = '2024-01-05'").first().stock == 50.0


def test_audit_sorts_names_and_not_rows(spark):
    """Rows are counted by hash under each name; the largest name of a file day is found among names."""
    rows = spark.createDataFrame(
        [(D(2024, 1, 7), n) for n in ("b.csv", "a.csv", None, "b.csv ")] + [(D(2024, 1, 14), None)],
        "filename_end_date date, filename string",
    )
    got = ingest.load_audit(rows, "main", "2024-02-01", trim=False)
    assert [(r.file_name, r.no_of_records) for r in got.orderBy("date_from_file_name").collect()] == [
        ("b.csv ", 4), (None, 1),
    ]
    first = got._jdf.queryExecution().executedPlan().toString().strip().splitlines()
    first = [line for line in first if "Aggregate" in line or "Sort" in line]
    assert "HashAggregate" in first[-1] and "HashAggregate" in first[-2]
