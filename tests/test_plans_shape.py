"""Plan-shape guards: no cartesian / nested-loop joins, pruned scans, no Python on the data path."""

from marketlake import catalog

FILE_QUERIES = {"raw_report_scan", "raw_lineage", "batch_ledger", "raw_report_stream", "raw_stream_ledger", "pull_csv_scan", "raw_export",
                "mcp_response_scan", "metric_column_identify"}
BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


def test_no_cartesian_or_python_and_pruned_scans(spark):
    qs = catalog.QUERIES
    for name, fn in qs.items():
        if name in FILE_QUERIES:
            continue
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        for bad in BAD:
            assert bad not in plan, (name, bad)
        for line in plan.splitlines():
            if "FileScan parquet" in line and "lineitem" in line:
                cols = line.split("[", 1)[1].split("]", 1)[0].split(",")
                assert len(cols) < 11, (name, cols)  # never all lineitem columns


def test_scaled_views_have_no_window_and_ad_facts_one_fan_out(spark):
    def plan(name):
        return catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()

    for name in ("growth_adset_daily", "growth_ad_daily", "activity_campaign_daily", "activity_adset_daily", "activity_ad_daily"):
        assert "Window" not in plan(name), name
    assert plan("marketing_fact_ad").count("Generate explode") == 2  # the KPIs of an order, the models of an ad day
    for name in ("growth_daily_totals", "cost_preserving_replace", "export_parity"):
        assert "RoundRobin" not in plan(name) and "RepartitionByExpression" not in plan(name)
