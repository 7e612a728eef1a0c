import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from marketlake import constants as K
from marketlake.sources import export, mcp_text, pull_csv, raw_json


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_raw_scan_list_and_rows_bodies(spark, tmp_dir):
    write(f"{tmp_dir}/aggregated_performance/dt=2026-01-01/a.json", json.dumps([{"cost": 1}, {"cost": 2}]))
    write(f"{tmp_dir}/in_app_events/dt=2026-01-02/b.json", json.dumps({"rows": [{"event_name": "x", "n": {"a": 1}}]}))
    df = raw_json.raw_report_scan(spark, f"{tmp_dir}/*/dt=*/*.json")
    rows = sorted((r._report_name, str(r._extract_date), json.loads(r._payload).get("cost")) for r in df.collect())
    assert rows == [("aggregated_performance", "2026-01-01", 1), ("aggregated_performance", "2026-01-01", 2),
                    ("in_app_events", "2026-01-02", None)]
    nested = df.filter("_report_name = 'in_app_events'").first()._payload
    assert json.loads(nested) == {"event_name": "x", "n": {"a": 1}}


def test_raw_scan_bad_partition_and_unknown_report_fail(spark, tmp_dir):
    write(f"{tmp_dir}/bad/aggregated_performance/day=2026-01-01/a.json", "[]\n[{}]")
    write(f"{tmp_dir}/bad/aggregated_performance/day=2026-01-01/a.json", json.dumps([{"x": 1}]))
    with pytest.raises(Exception):
        raw_json.raw_report_scan(spark, f"{tmp_dir}/bad/*/*/*.json").collect()
    write(f"{tmp_dir}/unk/mystery/dt=2026-01-01/a.json", json.dumps([{"x": 1}]))
    with pytest.raises(Exception):
        raw_json.raw_report_scan(spark, f"{tmp_dir}/unk/*/*/*.json").collect()


def test_lineage_and_ledger(spark, tmp_dir):
    path = f"{tmp_dir}/aggregated_performance/dt=2026-01-01/a.json"
    write(path, json.dumps([{"b": 1, "a": "x"}, {"a": "y"}]))
    scan = raw_json.raw_report_scan(spark, path)
    lin = raw_json.with_lineage(scan).collect()
    file_path = scan.first()._file_path
    assert {r._batch_id for r in lin} == {hashlib.sha256(file_path.encode()).hexdigest()[:16]}
    expect = hashlib.sha256(json.dumps({"report_name": "aggregated_performance", "extract_date": "2026-01-01",
                                        "payload": {"b": 1, "a": "x"}}, sort_keys=True,
                                       separators=(",", ":")).encode()).hexdigest()
    assert expect in {r._row_hash for r in lin}
    led = raw_json.batch_ledger(scan).first()
    assert (led.row_count, led.status, led.report_name) == (2, "loaded", "aggregated_performance")
    merged = raw_json.merge_ledger(raw_json.batch_ledger(scan), raw_json.batch_ledger(scan))
    assert merged.count() == 1


def test_pull_header_map():
    f = pull_csv.field_for_header
    assert f("Media Source (pid)") == "media_source"
    assert f("af_subscribe (Unique users)") == "af_subscribe"
    assert f("af_subscribe (Event counter)") is None
    assert f("Conversions") == "installs" and f("  ") is None and f("Total Cost") == "cost"
    assert pull_csv.header_plan(["Installs", "Conversions"]) == {"installs": 1}


def test_pull_csv_scan(spark, tmp_dir):
    a = f"{tmp_dir}/p1.csv"
    write(a, "Date,Media Source (pid),Campaign (c),Installs,Total Cost,af_subscribe (Unique users),"
             "af_subscribe (Event counter)\n"
             "2026-01-01, fb ,None,12,N/A,3,99\n"
             ",fb,c,1,1,1,1\n"
             "2026-01-02,(not set),c2, 3.5 ,\"1,234\",,7\n")
    b = f"{tmp_dir}/p2.csv"
    write(b, "Date,Media Source,Cost\n2026-01-03,g,5d\n")
    df = pull_csv.pull_csv_scan(spark, [a, b], fetched_at="t0")
    rows = {str(r.fact_date): r for r in df.collect()}
    assert set(rows) == {"2026-01-01", "2026-01-02", "2026-01-03"}
    r1 = rows["2026-01-01"]
    assert (r1.media_source, r1.campaign, r1.installs, r1.cost, r1.af_subscribe) == ("fb", "", 12.0, None, 3.0)
    r2 = rows["2026-01-02"]
    assert (r2.media_source, r2.installs, r2.cost, r2.af_subscribe) == ("", 3.5, None, None)
    assert rows["2026-01-03"].cost is None and rows["2026-01-03"].adset == ""
    assert r1.timezone == K.DEFAULT_BUSINESS_TZ and r1.fetched_at == "t0"


RESP_SCHEMA = ("kpi_name string, fetch_window_from string, fetch_window_to string, fetched_at string, "
               "response_text string")


def test_mcp_response_scan(spark):
    ok = ("Result ## Data:Date,Media source,Campaign,Adset,Unique users,Cost,Installs\n"
          "2026-01-01,fb,c1,as1,5,10.5,3\n\n,fb,c1,as2,,2,1\n"
          "; ## Metadata:{\"timezone\": \"UTC\", \"currency\": \"USD\"}")
    badmeta = "## Data:Media source,Unique users\ng,4; ## Metadata:not json"
    nomark = "nothing here"
    df = spark.createDataFrame([("k1", "2026-01-01", "2026-01-01", "f1", ok),
                                ("k2", "2026-01-01", "2026-01-03", "f2", badmeta),
                                ("k3", "2026-01-01", "2026-01-01", "f3", nomark)], RESP_SCHEMA)
    out = mcp_text.mcp_response_scan(df).collect()
    k1 = sorted([r for r in out if r.kpi_name == "k1"], key=lambda r: r.adset)
    assert len(k1) == 2
    assert (str(k1[0].fact_date), k1[0].media_source, k1[0].metric_column, k1[0].metric_value, k1[0].cost,
            k1[0].installs, k1[0].timezone, k1[0].currency) == ("2026-01-01", "fb", "Unique users", 5.0, 10.5, 3.0,
                                                                 "UTC", "USD")
    assert str(k1[1].fact_date) == "2026-01-01" and k1[1].metric_value is None and k1[1].metric_column == ""
    k2 = [r for r in out if r.kpi_name == "k2"]
    assert len(k2) == 1 and k2[0].fact_date is None and json.loads(k2[0].raw_metadata_json) == {"raw": "not json"}
    assert k2[0].metric_value == 4.0 and k2[0].timezone is None
    assert not [r for r in out if r.kpi_name == "k3"]
    assert json.loads(k1[0].raw_row_json)["Adset"] == "as1"


def test_raw_export_round_trip(spark, tmp_dir):
    from marketlake import catalog
    bronze = catalog.Inputs(spark, "/root/testdata/sf0.001").mcp.withColumn(
        "period", F.when(F.col("kpi_name").endswith("_activity"), F.lit("activity")).otherwise(F.lit("ltv"))
    ).withColumn("raw_row_json", F.to_json(F.struct("media_source", "campaign", "metric_value")))
    rows = export.raw_export_rows(bronze)
    root = f"{tmp_dir}/raw"
    export.write_raw_export(rows, root)
    back = raw_json.raw_report_scan(spark, f"{root}/*/dt=*/*.txt", body="lines", unwrap="row")
    assert back.count() == bronze.count()
    summary = export.export_summary(rows, bronze).first()
    assert summary.raw_snapshot_partitions_written == rows.select("report_name", "dt").distinct().count()


def test_fact_export_normalises(spark, tmp_dir):
    from tests.test_silver_gold import SILVER_SCHEMA, silver_row
    s = spark.createDataFrame([silver_row(dt.date(2026, 1, 2), 1.0, ms="None"), silver_row(dt.date(2026, 1, 1), 1.0, ms="")],
                              SILVER_SCHEMA)
    rows = export.fact_export_rows(s)
    export.write_fact_export(rows, f"{tmp_dir}/facts")
    back = spark.read.parquet(f"{tmp_dir}/facts").collect()
    assert all(r.media_source is None for r in back) and len(back) == 2
    assert [str(r.fact_date) for r in rows.collect()] == ["2026-01-01", "2026-01-02"]


def test_pull_csv_scan_many_files_one_header_job(spark, tmp_dir):
    paths = []
    for i in range(10):
        p = f"{tmp_dir}/many/p{i}.csv"
        if i % 2:
            write(p, f"Date,Media Source (pid),Installs\n2026-01-{i + 1:02d},fb,{i}\n")
        else:
            write(p, f"Date,Installs,Media Source\n2026-01-{i + 1:02d},{i},g\n")
        paths.append(p)
    assert len(pull_csv.header_lines(spark, paths)) == 10
    rows = {r.fact_date.day: (r.media_source, r.installs) for r in pull_csv.pull_csv_scan(spark, paths).collect()}
    assert rows == {i + 1: ("fb" if i % 2 else "g", float(i)) for i in range(10)}


def test_mcp_response_quoted_newline(spark):
    text = ('## Data:Date,Media source,Campaign,Unique users\n2026-01-01,fb,"Spring\nSale",5\n'
            '2026-01-01,g,"a,b",6; ## Metadata:{"timezone": "UTC"}')
    df = spark.createDataFrame([("k", "2026-01-01", "2026-01-01", "f", text)], RESP_SCHEMA)
    out = {r.media_source: (r.campaign, r.metric_value) for r in mcp_text.mcp_response_scan(df).collect()}
    assert out == {"fb": ("Spring\nSale", 5.0), "g": ("a,b", 6.0)}


def test_raw_scan_fails_on_bad_files_whatever_is_selected(spark, tmp_dir):
    write(f"{tmp_dir}/ok/aggregated_performance/dt=2026-01-01/a.json", json.dumps([{"x": 1}]))
    bad = {"cut": '[{"x": 1}, {"y"', "text": "no json", "number": "3"}
    for name, body in bad.items():
        write(f"{tmp_dir}/{name}/aggregated_performance/dt=2026-01-01/a.json", body)
    write(f"{tmp_dir}/report/mystery/dt=2026-01-01/a.json", "[{}]")
    write(f"{tmp_dir}/day/aggregated_performance/dt=2026-13-01/a.json", "[{}]")
    for name in (*bad, "report", "day"):
        df = raw_json.raw_report_scan(spark, [f"{tmp_dir}/ok/*/*/*.json", f"{tmp_dir}/{name}/*/*/*.json"])
        with pytest.raises(Exception, match="unreadable report body|no known report"):
            df.count()
        with pytest.raises(Exception, match="unreadable report body|no known report"):
            df.select("_payload").collect()


def test_ledger_has_a_row_for_an_empty_batch(spark, tmp_dir):
    write(f"{tmp_dir}/aggregated_performance/dt=2026-01-01/a.json", "[]")
    write(f"{tmp_dir}/aggregated_performance/dt=2026-01-02/a.json", '{"rows": [{"a": 1}, {"a": 2}]}')
    write(f"{tmp_dir}/aggregated_performance/dt=2026-01-03/a.json", '{"other": 1}')
    scan = raw_json.raw_report_scan(spark, f"{tmp_dir}/*/*/*.json", keep_empty=True)
    assert sorted(r.row_count for r in raw_json.batch_ledger(scan).collect()) == [0, 0, 2]
    assert raw_json.raw_report_scan(spark, f"{tmp_dir}/*/*/*.json").count() == 2


def test_pull_csv_quotes_folders_with_spaces_and_bad_dates(spark, tmp_dir):
    paths = []
    for i in range(12):
        p = f"{tmp_dir}/p q/f{i}.csv"
        write(p, f'Date,Campaign (c),Installs\n2026-01-{i + 1:02d},"x ""y"", z\nw",{i}\n01/02/2026,c,1\n')
        paths.append(p)
    rows = {r.fact_date.day: (r.campaign, r.installs) for r in pull_csv.pull_csv_scan(spark, paths).collect()}
    assert rows == {i + 1: ('x "y", z\nw', float(i)) for i in range(12)}


def test_mcp_response_leading_newline_quotes_and_many_columns(spark):
    head = ",".join(["Date", "Campaign", *[f"p{i}" for i in range(80)], "Users"])
    one = '2026-01-01,"a ""b"", c",' + "," * 80 + "79"
    text = f"## Data:\n{head}\r\n{one}\r\n2026-01-01,plain,{',' * 80}78 ; ## Metadata: {{\"timezone\": \"UTC\"}}\n"
    df = spark.createDataFrame([("k", "2026-01-01", "2026-01-01", "f", text), ("e", "2026-01-01", "2026-01-01", "f", "## Data: \n")], RESP_SCHEMA)
    out = {r.campaign: (r.metric_column, r.metric_value, r.timezone) for r in mcp_text.mcp_response_scan(df).collect()}
    assert out == {'a "b", c': ("Users", 79.0, "UTC"), "plain": ("Users", 78.0, "UTC")}


def test_mcp_response_of_many_quoted_records(spark):
    text = "## Data:Date,Campaign,Users\n" + "\n".join(f'2026-01-01,"c {i}",{i}' for i in range(20_000))
    df = spark.createDataFrame([("k", "2026-01-01", "2026-01-01", "f", text)], RESP_SCHEMA)
    got = mcp_text.mcp_response_scan(df).agg(F.count("*").alias("n"), F.sum("metric_value").alias("s")).first()
    assert (got.n, got.s) == (20_000, sum(range(20_000)))
