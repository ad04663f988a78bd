"""What the physical plans must and must not contain."""

import __spark_entry__ as entry

QUERIES = entry.queries()

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_shuffle_partial_sums(spark, sf):
    """Lines are summed before the exchange, and only cells are exchanged again."""
    plan = plan_of(QUERIES["weekly_lag"](spark, sf))
    assert "partial_sum" in plan
    assert plan.count("Exchange hashpartitioning(SKU_ID") == 2


def test_replay_does_not_shuffle_the_facts(spark, sf):
    plan = plan_of(QUERIES["stock_backfill_replay"](spark, sf))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("hashpartitioning(date" in line for line in shuffles)
    assert "partial_max" in plan


def test_scan_reads_needed_columns_only(spark, sf):
    plan = plan_of(QUERIES["date_range"](spark, sf))
    assert "l_extendedprice" not in plan and "l_discount" not in plan


def test_large_dimensions_join_by_shuffle(spark, sf):
    """Without broadcasts the joins shuffle, with the same rows."""
    from check_oracles import compare, connect

    con, sql = connect(sf), entry.oracle_sql()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("stock_cover_report", "frozen_sales", "sales_scan"):
            df = QUERIES[name](spark, sf)
            assert "SortMergeJoin" in plan_of(df)
            assert "CartesianProduct" not in plan_of(df)
            assert compare(con, df, sql[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def cells_of_listed(spark, sf):
    """The cells of listed series, as the batch run takes them."""
    from shelfcast.operators import weekly
    from shelfcast.plans import standins
    from shelfcast.schemas import SERIES
    from shelfcast.sources import series_list
    from shelfcast.sources.sales import daily_sales

    listed = series_list.normalise_series_list(standins.series_list(spark, sf))
    cells = weekly.weekly_cells(daily_sales(standins.sales(spark, sf)))
    return cells.join(listed.select(*SERIES).distinct(), SERIES, "left_semi")


def test_long_series_lists_meet_cells_and_not_lines(spark, sf):
    """No exchange on the way to the filter carries raw lines, however long the list is."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(cells_of_listed(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = plan.splitlines()
    on_series = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(SKU_ID" in line]
    assert on_series
    for i in on_series:  # what is dealt out by series has been aggregated below
        assert any("HashAggregate" in line for line in lines[i + 1 : i + 4]), lines[i : i + 4]


def test_inputs_of_merge_and_report_are_read_once(spark, sf):
    """Stand-ins are stored first: what is left of them in the plan are plain scans."""
    for name in ("daily_sales_merge", "stock_cover_report"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_shipdate" not in plan and "o_custkey" not in plan, name


def test_report_writes_the_window_only(spark, sf, monkeypatch):
    """The report uses 16 days of the sales and one of the stocks, and writes no more aside."""
    from shelfcast.operators import inventory
    from shelfcast.plans import registry, standins

    written, stored = [], registry.stored
    monkeypatch.setattr(registry, "stored", lambda df: written.append(stored(df)) or written[-1])
    assert registry.report(spark, sf).count() > 0
    window = inventory.recent_sales(standins.sku_sales(spark, sf), registry.AS_OF)
    assert [w.count() for w in written] == [window.count()]


def test_merge_writes_the_landing_rows_once(spark, sf, monkeypatch):
    from shelfcast.plans import registry

    written, stored = [], registry.stored
    monkeypatch.setattr(registry, "stored", lambda df: written.append(df) or stored(df))
    registry.QUERIES["daily_sales_merge"](spark, sf)
    assert len(written) == 1
