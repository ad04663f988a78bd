"""Run registered queries against their SQL and compare whole results.

    python tests/check_oracles.py [sf] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, decimal.Decimal):
        return f"D{value}"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"f{value + 0.0!r}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, (dt.date, dt.datetime)):
        return f"d{value}"
    return str(value)


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple("" if v is None else v for v in r),
    )


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def sql_result(con, sql):
    cur = con.execute(sql)
    return table_rows([c[0] for c in cur.description], cur.fetchall())


def compare(con, df, sql):
    """None when equal, else a short text."""
    names, got = table_rows(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = sql_result(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}: {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ: {bad[0]}"
    return None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = argv[0] if argv else "0.01"
    wanted = argv[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    extra = set(oracles) - set(queries)
    assert not extra, extra
    failed = []
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in oracles:
                problem = compare(con, query(spark, sf_dir), oracles[name])
                n = "=" if problem is None else "!"
            else:
                rows = query(spark, sf_dir).collect()
                problem = None if rows else "no rows"
                n = f"rows {len(rows)}"
        except Exception as e:  # noqa: BLE001 - report every query
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", "!"
        print(f"{name:32s} {time.time() - began:6.1f}s {n} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
