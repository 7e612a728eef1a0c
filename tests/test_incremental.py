import datetime as dt
import os

from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.operators import pull as pull_ops, silver
from marketlake.plans import incremental, materialize

SF = "/root/testdata/sf0.001"


def window(inp, today, days):
    lo = today - dt.timedelta(days=days - 1)
    win = F.col("fact_date").between(F.lit(lo), F.lit(today))
    pull = inp.pull.filter(win & (F.col("report_segment") == "partners_by_date_report"))
    reattr = pull_ops.retarget_rewrite(inp.pull.filter(win & (F.col("report_segment") != "partners_by_date_report")))
    return pull, reattr, inp.mcp.filter(win).withColumn("ingest_seq", F.lit(1))


def days(spark, base):
    return materialize.manifest(spark, base)["days"]


def stored(spark, base, like):
    return materialize.read_table(spark, base, like)


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_runs_touch_their_window_only(spark, tmp_dir):
    inp = catalog.Inputs(spark, SF)
    stores = incremental.Stores(*[f"{tmp_dir}/{n}" for n in ("pull", "src", "silver", "map", "silver_ad", "gold")])
    first = dt.date(1996, 3, 31)
    out = incremental.run_incremental(spark, stores, *window(inp, first, 42), inp.ad_map_rows, first, 42)
    assert out["freshness"].first().max_fact_date <= first
    before = {t: days(spark, f"{tmp_dir}/{t}") for t in ("pull", "src", "silver", "silver_ad", "gold/growth_daily_totals")}
    old_weeks = rows(out["growth_weekly_totals"])

    # the same fetches again over a shorter window: equal rows, and older partitions keep their files
    lo = first - dt.timedelta(days=6)
    again = incremental.run_incremental(spark, stores, *window(inp, first, 7), inp.ad_map_rows, first, 7)
    for t, had in before.items():
        now = days(spark, f"{tmp_dir}/{t}")
        old = {d: r for d, r in had.items() if d < str(lo)}
        assert old and old == {d: r for d, r in now.items() if d < str(lo)} and now != had
    assert rows(again["growth_weekly_totals"]) == old_weeks
    whole = silver.marketing_fact_daily(inp.mcp, date_from=first - dt.timedelta(days=41), date_to=first)
    assert stored(spark, stores.silver, whole).count() == whole.count()
    assert len(materialize.versions(spark, stores.ad_map)) == 2

    # a day that the source no longer has vanishes
    src = stored(spark, stores.source_rows, window(inp, first, 7)[2])
    seen = sorted(r.fact_date for r in again["growth_breakdowns"].select("fact_date").distinct().collect() if lo <= r.fact_date <= first)
    gone, stays = seen[0], seen[-1]
    assert gone < stays
    incremental.rebuild_window(spark, stores, stored(spark, stores.pull, window(inp, first, 7)[0]), src.filter(F.col("fact_date") != F.lit(gone)),
                               materialize.read_latest(spark, stores.ad_map), lo, first)
    assert str(gone) not in days(spark, stores.silver)
    assert str(stays) in days(spark, stores.silver)


def test_stream_batches_rebuild_touched_dates(spark, tmp_dir):
    from marketlake.streaming import raw_stream

    inp = catalog.Inputs(spark, SF)
    stores = incremental.Stores(*[f"{tmp_dir}/{n}" for n in ("pull", "src", "silver", "map", "silver_ad", "gold")])
    landing = f"{tmp_dir}/landing"
    for day in ("1996-03-05", "1996-03-06"):
        os.makedirs(f"{landing}/aggregated_performance/dt={day}")
        with open(f"{landing}/aggregated_performance/dt={day}/a.json", "w") as f:
            f.write('[{"cost": 1}]')
    ad_map = silver.adset_ad_map(inp.ad_map_rows)

    def recompute(dates, epoch_id):
        lo, hi = dates.agg(F.min("fact_date"), F.max("fact_date")).first()
        incremental.rebuild_window(spark, stores, inp.pull, inp.mcp, ad_map, lo, hi)

    q = (raw_stream.raw_report_stream(spark, landing).writeStream
         .foreachBatch(raw_stream.recompute_on_batch(recompute))
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = days(spark, f"{stores.gold}/growth_daily_totals")
    assert set(got) == {str(d) for d in (dt.date(1996, 3, 5), dt.date(1996, 3, 6))}


DAY = dt.date(2024, 1, 1)


def dated(spark, *rows):
    return spark.createDataFrame([(DAY + dt.timedelta(days=n), v) for n, v in rows], "fact_date date, v int")


def test_versions_switch_at_once(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    a = dated(spark, (0, 1), (1, 2), (1, 3), (2, 4))
    like = a.limit(0)
    assert materialize.read_table(spark, base, like).collect() == []
    assert materialize.replace_window(a, base, DAY, DAY + dt.timedelta(days=1)) == 1  # the third day is outside
    first = materialize.read_table(spark, base, like)
    assert rows(first) == [(DAY, 1), (DAY + dt.timedelta(days=1), 2), (DAY + dt.timedelta(days=1), 3)]
    # rows derived from the table itself replace it; an old version stays readable as it was
    assert materialize.replace_dates(first.withColumn("v", F.col("v") * 10), base, [DAY]) == 2
    assert rows(materialize.read_table(spark, base, like, 1)) == rows(first)
    assert [v for _, v in rows(materialize.read_table(spark, base, like))] == [10, 2, 3]
    assert rows(materialize.read_table(spark, base, like, days=[DAY])) == [(DAY, 10)]
    # a date without rows goes; two versions and their files stay
    assert materialize.replace_dates(like, base, [DAY]) == 3
    assert materialize.table_versions(spark, base) == [2, 3]
    assert [v for _, v in rows(materialize.read_table(spark, base, like, 2))] == [10, 2, 3]
    assert [v for _, v in rows(materialize.read_table(spark, base, like))] == [2, 3]
    held = {d for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")}
    assert {d.split("fact_date=")[1] for d in held} == {str(DAY), str(DAY + dt.timedelta(days=1))}


def test_two_writers(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/t"
    materialize.replace_window(dated(spark, (0, 1), (1, 2)), base, DAY, DAY + dt.timedelta(days=1))
    real = materialize._commit
    raced = []

    def race(spark_, base_, version, content):
        if not raced:
            raced.append(1)
            materialize.replace_dates(dated(spark, other), base, [DAY + dt.timedelta(days=other[0])])
        return real(spark_, base_, version, content)

    monkeypatch.setattr(materialize, "_commit", race)
    other = (1, 20)
    assert materialize.replace_dates(dated(spark, (0, 10)), base, [DAY]) == 3  # on top of the other's version
    assert [v for _, v in rows(materialize.read_table(spark, base, dated(spark)))] == [10, 20]
    raced.clear()
    other = (0, 7)
    try:
        materialize.replace_dates(dated(spark, (0, 8)), base, [DAY])
        raise AssertionError("both replaced one date")
    except RuntimeError:
        pass
    assert [v for _, v in rows(materialize.read_table(spark, base, dated(spark)))] == [7, 20]


def test_change_goes_on_to_weeks_and_months(spark, tmp_dir):
    from marketlake.plans import gold_refresh
    from marketlake.operators import gold, marts

    inp = catalog.Inputs(spark, SF)
    lo, hi = dt.date(1996, 1, 20), dt.date(1996, 2, 12)
    day = F.col("fact_date").between(F.lit(lo), F.lit(hi))
    pull, sil = inp.pull.filter(day), silver.marketing_fact_daily(inp.mcp.filter(day))
    sil_ad = silver.marketing_fact_ad(inp.mcp.filter(day), silver.adset_ad_map(inp.ad_map_rows))
    at = F.col("_extract_date").between(F.lit(lo), F.lit(hi))
    perf = marts.daily_performance_metrics(marts.stage_performance(inp.raw_perf.filter(at)))
    events = marts.daily_event_metrics(marts.stage_events(inp.raw_events.filter(at)))
    every = spark.createDataFrame([(d,) for d in materialize.window_days(lo, hi)], "fact_date date")
    base = f"{tmp_dir}/g"
    incremental.propagate(spark, base, every, pull, sil, sil_ad, perf, events)
    before = {n: days(spark, f"{base}/{n}") for n in ("growth_adset_daily", "growth_weekly_totals", "weekly_acquisition", "monthly_acquisition")}

    # two days change, in one week of January and another of February
    touched = [dt.date(1996, 1, 31), dt.date(1996, 2, 6)]
    changed = F.col("fact_date").isin(touched)
    pull2 = pull.withColumn("cost", F.when(changed, F.col("cost") + 1000).otherwise(F.col("cost")))
    perf2 = perf.withColumn("cost", F.when(F.col("report_date").isin(touched), F.col("cost") + 7).otherwise(F.col("cost")))
    dates = spark.createDataFrame([(d,) for d in touched] * 2 + [(None,)], "fact_date date")
    incremental.propagate(spark, base, dates, pull2, sil, sil_ad, perf2, events)
    want = gold_refresh.gold_datasets(pull2, sil, sil_ad, None)
    daily = marts.daily_acquisition(perf2, marts.event_pivot(events))
    want |= {"growth_weekly_totals": gold.weekly_totals(want["growth_daily_totals"]), "daily_acquisition": daily,
             "weekly_acquisition": marts.weekly_acquisition(daily), "monthly_acquisition": marts.monthly_acquisition(daily)}
    for name in ("growth_daily_totals", "growth_adset_daily", "growth_weekly_totals", "daily_acquisition", "weekly_acquisition", "monthly_acquisition"):
        got = materialize.read_table(spark, f"{base}/{name}", want[name])
        close = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())
        assert close(got) == close(want[name]), name
    for name, kept in (("growth_adset_daily", lambda d: d not in touched), ("weekly_acquisition", lambda d: d not in incremental.weeks_of(touched)),
                       ("growth_weekly_totals", lambda d: d not in incremental.weeks_of(touched)), ("monthly_acquisition", lambda d: False)):
        now = days(spark, f"{base}/{name}")
        for d, run in before[name].items():
            assert (now[d] == run) == kept(dt.date.fromisoformat(d)), (name, d)
    assert incremental.propagate(spark, base, dates.where("false"), pull2, sil, sil_ad, perf2, events) == {}
