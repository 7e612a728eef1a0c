import datetime as dt

from pyspark.sql import functions as F

from marketlake.functions import (
    dim_normalize, fact_date_fallback, is_utc_like, lenient_float_mcp, lenient_float_pull, lookback_bounds,
    ratio_if_nonzero, ratio_if_positive, utc_to_business_date, week_label_monday,
)
from marketlake.functions.kpi import attribution_model_of, base_kpi_of, is_ad_grain


def col_values(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_utc_to_business_date_goldens(spark):
    days = [dt.date(2026, 3, 31), dt.date(2026, 1, 15), dt.date(2026, 7, 15), dt.date(2026, 3, 9)]
    got = col_values(spark, days, lambda c: utc_to_business_date(c, "America/Los_Angeles"), "date")
    assert got == [dt.date(2026, 3, 30), dt.date(2026, 1, 14), dt.date(2026, 7, 14), dt.date(2026, 3, 8)]


def test_utc_to_business_date_session_tz_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = col_values(spark, [dt.date(2026, 3, 31)], lambda c: utc_to_business_date(c, "America/Los_Angeles"), "date")
            assert got == [dt.date(2026, 3, 30)], tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_is_utc_like(spark):
    got = col_values(spark, [None, "", "UTC", "Etc/UTC", " gmt ", "America/Los_Angeles"], is_utc_like)
    assert got == [True, True, True, True, True, False]


def test_lenient_float_pull(spark):
    vals = ["12", " 3.5 ", "N/A", "-", "1,234", "5d", "nan", None, "—", "1_000", "1e3", "na"]
    got = col_values(spark, vals, lenient_float_pull)
    assert got == [12.0, 3.5, None, None, None, None, None, None, None, 1000.0, 1000.0, None]


def test_lenient_float_mcp(spark):
    got = col_values(spark, ["", " 7 ", "abc", None, "-2.5"], lenient_float_mcp)
    assert got == [None, 7.0, None, None, -2.5]


def test_dim_normalize(spark):
    got = col_values(spark, [None, " ", "None", "(not set)", " fb ", "N/A", "NULL", "x"], dim_normalize)
    assert got == ["", "", "", "", "fb", "", "", "x"]


def test_week_label_monday(spark):
    days = [dt.date(2026, 1, 1), dt.date(2026, 1, 4), dt.date(2026, 1, 5), dt.date(2024, 12, 30)]
    got = col_values(spark, days, week_label_monday, "date")
    assert got == ["2026-W00", "2026-W00", "2026-W01", "2024-W53"]


def test_week_label_matches_strftime_over_years(spark):
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(0, 7 * 365, 3)]
    got = col_values(spark, days, week_label_monday, "date")
    assert got == [d.strftime("%Y-W%W") for d in days]


def test_kpi_helpers(spark):
    df = spark.createDataFrame([("ad_af_subscribe_unique_users_activity",), ("adset_x",), ("arpu_ltv",)], "k string")
    rows = df.select(is_ad_grain("k"), attribution_model_of("k"), base_kpi_of("k")).collect()
    assert [tuple(r) for r in rows] == [
        (True, "activity", "ad_af_subscribe_unique_users"),
        (False, "ltv", "adset_x"),
        (False, "ltv", "arpu_ltv"),
    ]


def test_fact_date_fallback(spark):
    df = spark.createDataFrame([("2026-01-02", "2026-01-01", "2026-01-01"), ("", "2026-01-01", "2026-01-01"),
                                (None, "2026-01-01", "2026-01-03")], "d string, f string, t string")
    got = [r[0] for r in df.select(fact_date_fallback("d", "f", "t")).collect()]
    assert got == ["2026-01-02", "2026-01-01", None]


def test_ratios(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (10.0, None), (0.0, -2.0)], "n double, d double")
    assert [r[0] for r in df.select(ratio_if_positive("n", "d")).collect()] == [5.0, None, None, None]
    assert [r[0] for r in df.select(ratio_if_nonzero("n", "d")).collect()] == [5.0, None, None, -0.0]


def test_lookback_bounds():
    assert lookback_bounds(dt.date(2026, 1, 14), 14) == (dt.date(2026, 1, 1), dt.date(2026, 1, 14))
    assert lookback_bounds(dt.date(2026, 1, 14), 1) == (dt.date(2026, 1, 14), dt.date(2026, 1, 14))


def test_storage_date_remaps_utc_reports_on_request(spark):
    from marketlake.functions import storage_date

    df = spark.createDataFrame([("2026-01-15", "UTC"), ("2026-01-15", None), ("2026-01-15", "America/Los_Angeles")], "d string, tz string")
    plain = [str(r[0]) for r in df.select(storage_date(F.to_date("d"), F.col("tz"), "America/Los_Angeles")).collect()]
    moved = [str(r[0]) for r in df.select(storage_date(F.to_date("d"), F.col("tz"), "America/Los_Angeles", True)).collect()]
    assert plain == ["2026-01-15"] * 3 and moved == ["2026-01-14", "2026-01-14", "2026-01-15"]


def test_reports_of_one_attribution_model(spark):
    import datetime as dt

    from marketlake.operators import reports

    rows = [(dt.date(2026, 1, 1), m, "fb", 10.0, 1.0, 1.0, 2.0) for m in ("ltv", "activity")]
    df = spark.createDataFrame(rows, "fact_date date, attribution_model string, media_source string, spend double, af_subscribe double, af_start_trial double, installs double")
    span = (dt.date(2026, 1, 1), dt.date(2026, 1, 2))
    assert reports.report_summary(df, *span).first().spend == 20.0
    assert reports.report_summary(df, *span, attribution_model="ltv").first().spend == 10.0
    assert reports.report_daily_cac(df, *span, attribution_model="ltv").first().cac == 10.0
    assert reports.top_entities(df, *span, "media_source", attribution_model="activity").first().spend == 10.0
