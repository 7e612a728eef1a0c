import datetime as dt
import json

from marketlake.operators import marts, quality, reports
from tests.test_silver_gold import SILVER_SCHEMA, silver_row

D1 = dt.date(2026, 1, 1)


def raw(spark, payloads):
    return spark.createDataFrame([(D1, json.dumps(p)) for p in payloads], "_extract_date date, _payload string")


BASE = {"app_id": "a", "app_name": "A", "platform": "ios", "media_source": "fb", "campaign": "C",
        "campaign_id": "1", "adset": "S", "adset_id": "2", "ad": "D", "ad_id": "3", "country": "US"}


def test_staging_lenient_casts(spark):
    p = marts.stage_performance(raw(spark, [dict(BASE, impressions=10, clicks="n/a", installs="4", cost=2.5,
                                                  app_id=None)])).first()
    assert (p.impressions, p.clicks, p.installs, p.cost, p.app_id) == (10.0, None, 4.0, 2.5, None)


def test_events_only_ratio_null_daily_zero_weekly(spark):
    perf = marts.daily_performance_metrics(marts.stage_performance(raw(spark, [dict(BASE, impressions=1, clicks=1,
                                                                                    installs=2, cost=10)])))
    ev = marts.event_pivot(marts.daily_event_metrics(marts.stage_events(raw(spark, [
        dict(BASE, event_name="af_start_trial", event_count=3, revenue=0),
        dict(BASE, country="DE", event_name="af_start_trial", event_count=3, revenue=0)]))))
    daily = marts.daily_acquisition(perf, ev)
    rows = {r.country: r for r in daily.collect()}
    assert rows["US"].cost_per_install == 5.0 and rows["US"].cost_per_af_start_trial == 10.0 / 3
    assert rows["DE"].cost_per_af_start_trial is None and rows["DE"].af_start_trial == 3.0
    weekly = {r.country: r for r in marts.weekly_acquisition(daily).collect()}
    assert weekly["DE"].cost_per_af_start_trial == 0.0
    assert str(weekly["DE"].week_start) == "2025-12-29"


def test_full_outer_coalesced_keys(spark):
    perf = marts.daily_performance_metrics(marts.stage_performance(raw(spark, [dict(BASE, campaign_id=None, cost=1)])))
    ev = marts.event_pivot(marts.daily_event_metrics(marts.stage_events(raw(spark, [
        dict(BASE, campaign_id="C", event_name="af_subscribe", event_count=1)]))))
    assert marts.daily_acquisition(perf, ev).count() == 1  # COALESCE(id, name) matches


def test_duplicate_keys_check(spark):
    perf = marts.daily_performance_metrics(marts.stage_performance(raw(spark, [dict(BASE, cost=1),
                                                                               dict(BASE, campaign="C2", cost=1)])))
    ev = marts.event_pivot(marts.daily_event_metrics(marts.stage_events(raw(spark, [dict(BASE, event_name="x")]))))
    dup = quality.validate_duplicate_keys(marts.daily_acquisition(perf, ev)).collect()
    assert len(dup) == 1 and dup[0].row_count == 2


def test_report_summary_empty_window_is_null(spark):
    s = spark.createDataFrame([silver_row(D1, 5.0)], SILVER_SCHEMA)
    r = reports.report_summary(s, dt.date(2020, 1, 1), dt.date(2020, 1, 2)).first()
    assert r.spend is None and r.cac is None
    r2 = reports.report_summary(s, D1, D1).first()
    assert (r2.spend, r2.cac) == (5.0, 5.0)


def test_top_entities_unknown_and_bad_entity(spark):
    s = spark.createDataFrame([silver_row(D1, 5.0, ms=None), silver_row(D1, 1.0, subs=3.0)], SILVER_SCHEMA)
    top = reports.top_entities(s, D1, D1, "media_source", 10).collect()
    assert [r.entity for r in top] == ["fb", "(unknown)"]
    try:
        reports.top_entities(s, D1, D1, "country")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_freshness(spark):
    s = spark.createDataFrame([(D1,), (D1 + dt.timedelta(days=1),)], "fact_date date")
    r = reports.freshness(s, D1 + dt.timedelta(days=1)).first()
    assert (r.max_fact_date, r.yesterday_row_count, r.row_count, r.yesterday_present) == (D1 + dt.timedelta(days=1), 1, 2, True)
