"""Work that must not grow faster than the rows: scans of text, rows sent before they are folded, inputs computed twice."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from marketlake.functions import py_strip
from marketlake.sources import quoted_text


def test_line_functions_of_whole_arrays():
    rng = random.Random(5)
    lines = ["".join(rng.choice('""""",,ab \r') for _ in range(rng.randint(0, 12))) for _ in range(20_000)]
    out0, out1 = quoted_text.line_functions(pa.array(lines))
    assert out0.tolist() == [quoted_text.ends_inside(t, False) for t in lines]
    assert out1.tolist() == [quoted_text.ends_inside(t, True) for t in lines]
    for inside in (False, True):
        want, state = [], inside
        for t in lines:
            state = quoted_text.ends_inside(t, state)
            want.append(state)
        assert quoted_text.states_after(out0, out1, inside).tolist() == want


def test_text_is_scanned_once_for_its_functions(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('h1,h2\n"x\ny",2\n')
    df = quoted_text.file_records(spark, [f"{tmp_dir}/a.csv"])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2  # the records, and the fragments
    assert [r.record for r in df.where("NOT first").collect()] == ['"x\ny",2']


def test_strip_without_regex(spark):
    c = py_strip("t")
    assert "regexp" not in c._jc.toString()
    points = [(chr(i),) for i in range(1, 0x3100)]
    rows = spark.createDataFrame(points, "c string").select(F.concat("c", F.lit("a "), "c", F.lit("b"), "c", F.lit("\r\n")).alias("t"))
    assert rows.where(~c.eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""))).count() == 0


SOURCE = ("kpi_name string, fetch_window_from date, fetch_window_to date, grain_rank int, v int")


def test_grain_fallback_sends_no_source_row(spark, monkeypatch):
    import datetime as dt

    from marketlake.operators import silver
    d, e = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    rows = [("k", d, e, 1, 1), ("k", d, e, 0, 2), ("k", d, e, 0, 3), ("j", d, e, 3, 4), ("j", d, e, None, 5), (None, d, e, 0, 6), ("k", e, None, 0, 7)]
    source = spark.createDataFrame(rows, SOURCE)
    df = silver.grain_fallback(source)
    assert "hashpartitioning(kpi_name" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in df.collect()) == [2, 3, 4]
    monkeypatch.setattr(silver, "BROADCAST_ROWS", 0)
    assert sorted(r.v for r in silver.grain_fallback(source).collect()) == [2, 3, 4]


def orders(spark, path, n):
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 5).cast("int")).cast("timestamp")
    spark.range(n).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 7 > 0, F.col("id") % 90).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        (F.col("id") * 1.5).alias("o_totalprice"), F.when(F.col("id") % 11 > 0, day).alias("o_orderdate")).write.parquet(f"{path}/orders.parquet")
    return path


def test_orders_are_dealt_by_key_before_their_fan_out(spark, tmp_dir, monkeypatch):
    from marketlake import catalog
    from marketlake.sources import adapters
    d = orders(spark, tmp_dir, 400)
    want = sorted(map(str, adapters.Inputs(spark, d).mcp.collect()))
    upserted = sorted(map(str, catalog.QUERIES["source_upsert"](spark, d).collect()))
    monkeypatch.setattr(adapters, "ORDERS_A_TASK", 100)
    assert sorted(map(str, adapters.Inputs(spark, d).mcp_by_key.collect())) == want and len(want) == 7200
    df = catalog.QUERIES["source_upsert"](spark, d)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(" in plan and not [x for x in plan.splitlines() if "Exchange" in x and "kpi_name" in x]  # no KPI row is sent
    assert sorted(map(str, df.collect())) == upserted


def test_silver_is_computed_once(spark, tmp_dir):
    from marketlake import catalog
    d = orders(spark, tmp_dir, 60)
    df = catalog.QUERIES["export_parity_samples"](spark, d)
    assert "explode" not in df._jdf.queryExecution().optimizedPlan().toString()
    for name in ("growth_ad_daily", "activity_ad_daily"):
        df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert "explode" not in df._jdf.queryExecution().optimizedPlan().toString(), name
