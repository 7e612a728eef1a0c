import datetime as dt

from pyspark.sql import functions as F

from marketlake import constants as K
from marketlake.operators import gold, silver

D1 = dt.date(2026, 1, 1)
SRC_SCHEMA = ("fetch_window_from date, fetch_window_to date, fact_date date, media_source string, campaign string, "
              "adset string, ad string, kpi_name string, metric_value double, installs double, cost double, "
              "timezone string, currency string, fetched_at string")
PULL_SCHEMA = ("fact_date date, media_source string, campaign string, adset string, ad string, installs double, "
               "clicks double, impressions double, cost double, revenue double, af_start_trial double, "
               "af_subscribe double, rc_trial_converted_event double, af_tutorial_completion double, "
               "timezone string, currency string, report_segment string, fetched_at string, ingest_seq long")


def src_row(kpi, value, ms="fb", adset="as1", ad=None, width=0, fetched="2026-02-01T00", installs=5.0, cost=10.0,
            day=D1):
    return (day - dt.timedelta(days=width), day, day, ms, "c1", adset, ad, kpi, value, installs, cost, "UTC", "USD",
            fetched)


def test_canonical_rows_prefer_narrow_window_then_latest(spark):
    rows = [src_row("af_subscribe_unique_users", 1.0, width=2, fetched="2026-02-03"),
            src_row("af_subscribe_unique_users", 2.0, width=0, fetched="2026-02-01"),
            src_row("af_subscribe_unique_users", 3.0, width=0, fetched="2026-02-02")]
    df = spark.createDataFrame(rows, SRC_SCHEMA)
    out = silver.canonical_source_rows(df, silver.ADSET_GRAIN_DIMS, ad_grain=False).collect()
    assert [r.metric_value for r in out] == [3.0]


def test_marketing_fact_daily_wide(spark):
    rows = [src_row("af_subscribe_unique_users", 2.0), src_row("af_start_trial_unique_users", 4.0, cost=12.0),
            src_row("arpu_ltv", 1.5), src_row("af_subscribe_unique_users_activity", 7.0),
            src_row("af_subscribe_unique_users", 9.0, ms=None), src_row("ad_performance", 1.0, adset=None, ad="a1")]
    df = spark.createDataFrame(rows, SRC_SCHEMA)
    out = {(r.media_source, r.attribution_model): r for r in silver.marketing_fact_daily(df).collect()}
    assert set(out) == {("fb", "ltv"), ("fb", "activity"), (None, "ltv")}
    ltv = out[("fb", "ltv")]
    assert (ltv.af_subscribe, ltv.af_start_trial, ltv.spend, ltv.installs, ltv.arpu_ltv) == (2.0, 4.0, 12.0, 5.0, 1.5)
    assert out[("fb", "activity")].arpu_ltv is None and out[("fb", "activity")].af_subscribe == 7.0
    assert ltv.timezone == K.DEFAULT_BUSINESS_TZ and ltv.source_system == K.SRC_MCP


def test_marketing_fact_ad_perf_and_events(spark):
    rows = [src_row("ad_performance", 0.0, adset=None, ad="a1", installs=3.0, cost=9.0),
            src_row("ad_af_subscribe_unique_users", 2.0, adset=None, ad="a1"),
            src_row("ad_performance", 0.0, adset=None, ad="a2", installs=4.0, cost=8.0),  # no event row -> no row
            src_row("ad_af_start_trial_unique_users_activity", 5.0, adset=None, ad="a3", ms=None)]  # no perf
    df = spark.createDataFrame(rows, SRC_SCHEMA)
    amap = spark.createDataFrame([("fb", "c1", "as9", "a1", 1.0, 1)],
                                 "media_source string, campaign string, adset string, ad string, installs double, ingest_seq long")
    out = {r.ad: r for r in silver.marketing_fact_ad(df, silver.adset_ad_map(amap)).collect()}
    assert set(out) == {"a1", "a3"}
    assert (out["a1"].installs, out["a1"].spend, out["a1"].adset, out["a1"].af_subscribe) == (3.0, 9.0, "as9", 2.0)
    assert (out["a3"].installs, out["a3"].spend, out["a3"].adset, out["a3"].attribution_model) == (0.0, 0.0, "", "activity")


def test_adset_map_last_row_wins(spark):
    amap = spark.createDataFrame([("fb", "c1", "old", "a1", 1.0, 1), ("fb", "c1", "new", "a1", 2.0, 2),
                                  (None, "c1", "x", "a2", 1.0, 3)],
                                 "media_source string, campaign string, adset string, ad string, installs double, ingest_seq long")
    out = {(r.media_source, r.ad): r.adset for r in silver.adset_ad_map(amap).collect()}
    assert out == {("fb", "a1"): "new", ("", "a2"): "x"}


def pull_row(day, spend, ms="fb", tz=K.DEFAULT_BUSINESS_TZ, subs=1.0, trials=2.0, installs=3.0):
    return (day, ms, "c1", "", "", installs, 0.0, 0.0, spend, 1.0, trials, subs, 0.0, 0.0, tz, None,
            K.DEFAULT_REPORT_SEGMENT, "2026-01-01T00:00:00+00:00", 1)


def silver_row(day, spend, ms="fb", model="ltv", subs=1.0, trials=2.0, installs=3.0, adset="as1"):
    return (day, K.SRC_MCP, ms, "c1", adset, None, model, installs, spend, trials, subs, 0.0, 0.0, None, "USD",
            K.DEFAULT_BUSINESS_TZ, "2026-02-01")


SILVER_SCHEMA = ("fact_date date, source_system string, media_source string, campaign string, adset string, "
                 "ad string, attribution_model string, installs double, spend double, af_start_trial double, "
                 "af_subscribe double, af_tutorial_completion double, rc_trial_converted_event double, "
                 "arpu_ltv double, currency string, timezone string, fetched_at string")


def test_daily_totals_winner_rules(spark):
    d = [D1 + dt.timedelta(days=i) for i in range(4)]
    pull = spark.createDataFrame([pull_row(d[0], 10.0), pull_row(d[1], 0.0), pull_row(d[2], 0.0)], PULL_SCHEMA)
    sil = spark.createDataFrame([silver_row(d[0], 5.0), silver_row(d[1], 5.0), silver_row(d[3], 0.0, subs=0.0)], SILVER_SCHEMA)
    out = {r.fact_date: r for r in gold.daily_totals(pull, sil).collect()}
    assert [out[x].primary_source for x in d] == [K.SRC_PULL, K.SRC_MCP, K.SRC_PULL, K.SRC_MCP]
    assert out[d[1]].spend == 5.0 and out[d[1]].revenue == 1.0  # revenue always Pull
    assert out[d[0]].cac == 10.0 and out[d[3]].cac is None
    assert out[d[1]].fetched_at == "2026-01-01T00:00:00+00:00"  # Pull's stamp even when MCP wins


def test_scaled_adset_factors(spark):
    pull = spark.createDataFrame([pull_row(D1, 0.0, ms="zero"), pull_row(D1, 30.0, ms="fb")], PULL_SCHEMA)
    sil = spark.createDataFrame([
        silver_row(D1, 10.0, ms="fb", adset="a"), silver_row(D1, 20.0, ms="fb", adset="b"),
        silver_row(D1, 5.0, ms="zero"),               # Pull 0, own 5 -> scaled to 0
        silver_row(D1, 0.0, ms="own0", subs=0.0),      # no Pull row -> raw
        silver_row(D1, 7.0, ms=None),                  # NULL media source -> raw
    ], SILVER_SCHEMA)
    out = {(r.media_source, r.adset): r for r in gold.scaled_daily(pull, sil, gold.ADSET).collect()}
    assert out[("fb", "a")].spend == 10.0 and out[("fb", "b")].spend == 20.0
    assert out[("fb", "a")].primary_source == K.SRC_MCP + "_scaled"
    assert out[("zero", "as1")].spend == 0.0
    assert out[("own0", "as1")].primary_source == K.SRC_MCP + "_raw" and out[("own0", "as1")].spend == 0.0
    assert out[(None, "as1")].spend == 7.0 and out[(None, "as1")].source_confidence == K.CONF_MEDIUM


def test_scaled_spend_sums_to_pull(spark):
    from marketlake import catalog
    m = catalog.Model(spark, "/root/testdata/sf0.001")
    scaled = gold.scaled_daily(m.pull, m.silver, gold.ADSET)
    s = scaled.groupBy("fact_date", "media_source").agg(F.sum("spend").alias("s"))
    p = gold.pull_media_source_day(m.pull).select("fact_date", "media_source", "pull_spend")
    own = m.silver.filter("attribution_model = 'ltv'").groupBy("fact_date", "media_source").agg(F.sum("spend").alias("o"))
    j = s.join(p, ["fact_date", "media_source"]).join(own, ["fact_date", "media_source"]).filter("pull_spend > 0 and o > 0")
    bad = j.filter(F.abs(F.col("s") - F.col("pull_spend")) > 1e-6 * F.greatest(F.lit(1.0), F.col("pull_spend"))).count()
    assert j.count() > 0 and bad == 0


def test_weekly_sums_equal_daily(spark):
    from marketlake import catalog
    m = catalog.Model(spark, "/root/testdata/sf0.001")
    daily = m.daily_totals
    weekly = gold.weekly_totals(daily)
    a = daily.agg(F.sum("spend")).first()[0]
    b = weekly.agg(F.sum("spend")).first()[0]
    assert abs(a - b) < 1e-6
