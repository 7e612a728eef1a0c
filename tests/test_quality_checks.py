"""Spike decisions and parity over digests, on rows whose answer is known."""

import datetime as dt
import statistics

from pyspark.sql import functions as F

from marketlake.operators import quality

DAY = dt.date(2024, 1, 1)


def test_null_rate_spikes(spark):
    rates = [0.02, 0.03, 0.02, 0.02, 0.04, 0.03, 0.02, 0.02, 0.5, 0.6, 0.03, 0.06, 0.11]
    rows = [(DAY + dt.timedelta(days=n), 100, r, 0.0) for n, r in enumerate(rates)]
    rows += [(DAY + dt.timedelta(days=n), 100, 0.9, 0.0) for n in (80, 81)] + [(None, 5, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "report_date date, row_count long, a_null_rate double, b_null_rate double")
    got = {(r.report_date, r.field): r for r in quality.null_rate_spikes(df, cols=("a", "b")).collect()}
    assert len(got) == 2 * (len(rows) - 1)
    for n, rate in enumerate(rates):
        r, past = got[DAY + dt.timedelta(days=n), "a"], rates[:n]
        assert r.days_before == n and r.null_rate == rate
        if n:
            usual = statistics.median(past)
            spread = statistics.median(abs(x - usual) for x in past)
            assert abs(r.usual - usual) < 1e-12 and abs(r.spread - spread) < 1e-12
        assert r.spike == (None if n < 7 else n in (8, 9, 12)), n  # the second bad day is found beside the first
        assert got[DAY + dt.timedelta(days=n), "b"].spike == (None if n < 7 else False)
    assert got[DAY + dt.timedelta(days=81), "a"].spike is None  # one day in the window before it


SILVER = ("fact_date date, source_system string, media_source string, campaign string, adset string, ad string, installs double, spend double, "
          "af_start_trial double, af_subscribe double, af_tutorial_completion double, rc_trial_converted_event double, arpu_ltv double, "
          "currency string, timezone string")


def fact(day, ms, spend=1.0, currency="USD"):
    return (None if day is None else DAY + dt.timedelta(days=day), "s", ms, "c", None, "", 1.0, spend, 0.0, 0.0, 0.0, 0.0, None, currency, "UTC")


def test_parity_tree_equals_parity(spark, tmp_dir):
    left = [fact(d, f"m{k}") for d in range(70) for k in range(3)] + [fact(None, "x"), fact(3, "twice"), fact(3, "twice")]
    cases = [
        left, left[1:], [*left, fact(40, "new")], [fact(d, f"m{k}", 2.0 if (d, k) == (35, 1) else 1.0) for d in range(70) for k in range(3)] + left[-3:],
        [*left[:-3], fact(None, "y"), *left[-2:]], [r[:2] + ("None" if r[2] is None else r[2],) + r[3:4] + ("None", None) + r[6:] for r in left],
        [r[:7] + (-0.0 if r[8] else r[7], -0.0) + r[9:] for r in left], [], [fact(500, "z")],
    ]
    lf = spark.createDataFrame(left, SILVER)
    touched = []
    for right in cases:
        rf = spark.createDataFrame(right, SILVER)
        got = quality.export_parity_tree(lf, rf).first()
        want = quality.export_parity(lf, rf).first()
        assert [got[c] or 0 for c in want.__fields__] == [want[c] or 0 for c in want.__fields__]
        touched.append((got.unequal_months, got.unequal_dates))
    assert touched[0] == touched[5] == touched[6] == (0, 0)
    assert touched[1] == touched[2] == touched[3] == touched[4] == (1, 1) and touched[7] == (4, 71)


def test_parity_tree_reads_unequal_dates_only(spark, tmp_dir):
    left = spark.createDataFrame([fact(d, f"m{k}") for d in range(70) for k in range(3)], SILVER)
    right = left.withColumn("spend", F.when(F.col("fact_date") == F.lit(DAY + dt.timedelta(days=9)), F.lit(5.0)).otherwise(F.col("spend")))
    for name, df in (("l", left), ("r", right)):
        df.write.partitionBy("fact_date").parquet(f"{tmp_dir}/{name}")
    lf, rf = (spark.read.schema(left.schema).parquet(f"{tmp_dir}/{n}") for n in "lr")
    digests = [spark.createDataFrame(quality.date_digests(df).collect(), quality.date_digests(df).schema) for df in (lf, rf)]
    out = quality.export_parity_tree(lf, rf, left_digests=digests[0], right_digests=digests[1])
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and all("PartitionFilters: [" in s and "PartitionFilters: []" not in s for s in scans)
    r = out.first()
    assert (r.metric_mismatches, r.unequal_dates, r.left_unique_keys, r.parity_ok) == (3, 1, 210, False)
