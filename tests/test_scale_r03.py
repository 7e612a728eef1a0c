"""Figures that must not grow with the rows: landed files, batches of parsed responses, bytes of exports."""

import os

import pyarrow as pa
from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.sources import export, mcp_text


def test_landed_files_follow_days_not_rows(spark, monkeypatch):
    payload = F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}"))
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    perf = spark.range(0, 6000, 1, 4).select(day.alias("_extract_date"), payload.alias("_payload"))

    class Rows:
        def __init__(self, *_):
            self.raw_perf, self.raw_events = perf, perf.limit(0)

    monkeypatch.setattr(catalog, "Inputs", Rows)
    lines, documents = catalog.land_documents(spark, "")
    files = [f for root in (lines, documents) for _, _, fs in os.walk(root.removeprefix("file:")) for f in fs if f.endswith(".txt")]
    assert len(files) == 5
    monkeypatch.setattr(catalog, "DOCUMENT_ROWS", 500)
    lines, documents = catalog.land_documents(spark, "")
    files = [f for root in (lines, documents) for _, _, fs in os.walk(root.removeprefix("file:")) for f in fs if f.endswith(".txt")]
    assert 8 <= len(files) <= 15  # lines of a day that one task holds share a file
    catalog._LANDED[(spark.sparkContext.applicationId, "made")] = (lines, documents)
    back = catalog._scan_landing(spark, "made")
    assert back.count() == 6000 and back.select("_payload").distinct().count() == 6000


def _batch(texts):
    n = len(texts)
    return pa.RecordBatch.from_arrays([pa.array([{"k": i} for i in range(n)]), pa.array([None] * n, pa.string()), pa.array(texts)],
                                      names=["row", "header", "text"])


def test_records_of_many_responses_share_a_batch():
    texts = [f"Date,Cost,Ad,Cost\n2026-01-0{i % 9 + 1},x,a{i},{i}" for i in range(500)] + ["Ad\ninf\n\nb", "", "Cost,Date\n7"]
    (out,) = mcp_text._parser(mcp_text.DIMS)(iter([_batch(texts)]))
    rows = out.to_pylist()
    assert len(rows) == 503
    # the last of equal names counts, at the place of the first
    assert rows[3]["row"] == {"k": 3} and rows[3]["names"] == ["Date", "Cost", "Ad"] and rows[3]["vals"] == ["2026-01-04", "3", "a3"]
    assert rows[3]["dims"] == ["2026-01-04", None, None, None, "a3"]
    assert rows[3]["named"] == ["Date", "Cost", "Ad"] and rows[3]["tried"] == ["2026-01-04", "3", "a3"]
    assert rows[500]["tried"] == ["inf"] and rows[501]["tried"] == [] and rows[501]["vals"] == ["b"]
    assert rows[502]["vals"] == ["7", None] and rows[502]["dims"] == ["", None, None, None, None]


def test_no_raw_rows_same_columns(spark):
    text = "## Data:\u00a0\nDate,Ad,Pad,Unique users,Cost,Installs\n2026-01-01,a1,x, 1_0 ,2e1,Infinity\n2026-01-02,a2,x,,,\u2003\n"
    df = spark.createDataFrame([("k", "2026-01-01", "2026-01-02", "f", text)],
                               "kpi_name string, fetch_window_from string, fetch_window_to string, fetched_at string, response_text string")
    whole = mcp_text.mcp_response_scan(df)
    slim = mcp_text.mcp_response_scan(df, raw_rows=False)
    assert set(whole.columns) - set(slim.columns) == {"raw_row_json"}
    assert sorted(map(tuple, whole.drop("raw_row_json").collect()), key=str) == sorted(map(tuple, slim.collect()), key=str)
    row = slim.where("ad = 'a1'").first()
    assert (row.metric_column, row.metric_value, row.cost, row.installs) == ("Unique users", 10.0, 20.0, float("inf"))


def test_landed_lines_and_exports_are_compressed(spark, tmp_dir, monkeypatch):
    perf = spark.range(300).select(F.lit("2026-01-03").cast("date").alias("_extract_date"), F.lit('{"a":1}').alias("_payload"))

    class Rows:
        def __init__(self, *_):
            self.raw_perf, self.raw_events = perf, perf

    monkeypatch.setattr(catalog, "Inputs", Rows)
    names = [f for _, _, fs in os.walk(catalog.land_raw(spark, "").removeprefix("file:")) for f in fs if f.startswith("part-")]
    assert names and all(f.endswith(".txt.gz") for f in names)
    bronze = spark.range(300).select(F.lit("ltv").alias("period"), F.lit("2026-01-03").cast("date").alias("fact_date"),
                                     F.lit("2026-01-03").cast("date").alias("fetch_window_from"), F.lit('{"a":1}').alias("raw_row_json"))
    sizes = {}
    for codec in ("none", "gzip"):
        export.write_raw_export(export.raw_export_rows(bronze), f"{tmp_dir}/{codec}", codec)
        sizes[codec] = sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(f"{tmp_dir}/{codec}") for f in fs if f.startswith("part-"))
    assert 0 < sizes["gzip"] < sizes["none"] / 5
