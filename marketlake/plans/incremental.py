"""One incremental run over a lookback window.

Pull: cost-preserving replace of the new fetch (J8), reattribution replace (J9),
dedupe (W1). Tool source: upsert of the new source rows (J10), then the window of
silver (A18, A20) and, with the ad map (J12), of ad-grain silver (A19). Gold (S10)
is rebuilt for the window's dates and the weeks they belong to, and freshness
reported (A26).

Every table is partitioned by date and replaced by version (``materialize``). A run
reads and writes the window's dates only; a stored week is read whole for the weekly
rollup. The ad map is one small table without dates: it is written as a new version.
``propagate`` does the same for a set of touched dates, and goes on to weeks and months.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as K
from marketlake.functions import lookback_bounds
from marketlake.operators import gold, marts, pull as pull_ops, reports, silver, upserts
from marketlake.plans import gold_refresh
from marketlake.plans.materialize import (
    in_window, read_latest, read_table, replace_dates, replace_window, window_days, write_new_version,
)


@dataclass
class Stores:
    """Base paths (shared storage) of the persisted tables."""

    pull: str
    source_rows: str
    silver: str
    ad_map: str
    silver_ad: str
    gold: str


def _stored(df: DataFrame, base: str, date_from: _dt.date, date_to: _dt.date) -> DataFrame:
    """Write the window of ``df`` and give the table's window back."""
    version = replace_window(df, base, date_from, date_to)
    return read_table(df.sparkSession, base, df, version, window_days(date_from, date_to))


def rebuild_window(spark: SparkSession, stores: Stores, pull: DataFrame, source: DataFrame, ad_map: DataFrame,
                   date_from: _dt.date, date_to: _dt.date, tz: str = K.DEFAULT_BUSINESS_TZ) -> dict[str, DataFrame]:
    """Silver and gold of the window from the stored Pull and source rows; the tables, by name."""
    day = in_window(date_from, date_to)
    sil = _stored(silver.marketing_fact_daily(source, tz, date_from, date_to), stores.silver, date_from, date_to)
    sil_ad = _stored(silver.marketing_fact_ad(source, ad_map, tz, date_from, date_to), stores.silver_ad, date_from, date_to)
    out = {}
    for name, df in gold_refresh.gold_datasets(pull.filter(day), sil, sil_ad, None, tz).items():
        if name == "growth_weekly_totals":
            continue
        path = f"{stores.gold.rstrip('/')}/{name}"
        replace_window(df, path, date_from, date_to)
        out[name] = read_table(spark, path, df)
    # weeks that hold a date of the window, from all their stored days
    monday = date_from - _dt.timedelta(days=date_from.weekday())
    sunday = date_to + _dt.timedelta(days=6 - date_to.weekday())
    weekly = gold.weekly_totals(out["growth_daily_totals"].filter(in_window(monday, sunday)))
    path = f"{stores.gold.rstrip('/')}/growth_weekly_totals"
    replace_window(weekly, path, monday, sunday, "week_start")
    out["growth_weekly_totals"] = read_table(spark, path, weekly)
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out


def weeks_of(days) -> list[_dt.date]:
    """All days of the ISO weeks that hold one of ``days``."""
    mondays = {d - _dt.timedelta(days=d.weekday()) for d in days}
    return sorted(m + _dt.timedelta(days=n) for m in mondays for n in range(7))


def months_of(days) -> list[_dt.date]:
    """All days of the months that hold one of ``days``."""
    firsts = {d.replace(day=1) for d in days}
    return sorted(f + _dt.timedelta(days=n) for f in firsts for n in range(31) if (f + _dt.timedelta(days=n)).month == f.month)


def propagate(spark: SparkSession, base: str, touched: DataFrame, pull: DataFrame, silver_rows: DataFrame, silver_ad: DataFrame,
              perf: DataFrame, events: DataFrame, tz: str = K.DEFAULT_BUSINESS_TZ) -> dict[str, int]:
    """Carry a change of some dates (``touched.fact_date``) to every dataset that depends on them; versions written, by name.

    Gold and the daily mart are rebuilt for the touched dates alone, wherever they lie, weekly datasets for
    the weeks that hold them and the monthly mart for the months, both from the stored daily ones. Inputs are
    whole tables: the dates become a filter that prunes them. The touched dates are days: a bounded list.
    """
    base = base.rstrip("/")
    days = sorted(r[0] for r in touched.select("fact_date").where("fact_date IS NOT NULL").distinct().collect())
    if not days:
        return {}
    out: dict[str, int] = {}

    def only(df: DataFrame, date_col: str = "fact_date") -> DataFrame:
        return df.where(F.col(date_col).isin(days))

    def put(name: str, df: DataFrame, dates, date_col: str) -> DataFrame:
        out[name] = replace_dates(df, f"{base}/{name}", dates, date_col)
        return df

    made = gold_refresh.gold_datasets(only(pull), only(silver_rows), only(silver_ad), None, tz)
    for name, df in made.items():
        if name != "growth_weekly_totals":
            put(name, df, days, "fact_date")
    week_days, month_days = weeks_of(days), months_of(days)
    daily = read_table(spark, f"{base}/growth_daily_totals", made["growth_daily_totals"], days=week_days)
    put("growth_weekly_totals", gold.weekly_totals(daily), week_days, "week_start")

    mart = put("daily_acquisition", marts.daily_acquisition(only(perf, "report_date"), marts.event_pivot(only(events, "report_date"))),
               days, "report_date")
    stored = f"{base}/daily_acquisition"
    put("weekly_acquisition", marts.weekly_acquisition(read_table(spark, stored, mart, days=week_days)), week_days, "week_start")
    put("monthly_acquisition", marts.monthly_acquisition(read_table(spark, stored, mart, days=month_days)), month_days, "month_start")
    return out


def run_incremental(spark: SparkSession, stores: Stores, pull_fetch: DataFrame, reattr_fetch: DataFrame,
                    source_fetch: DataFrame, map_fetch: DataFrame, today: _dt.date,
                    lookback_days: int = 14, tz: str = K.DEFAULT_BUSINESS_TZ) -> dict[str, DataFrame]:
    """One run: fetched rows outside the window are not taken (another window is another run)."""
    date_from, date_to = lookback_bounds(today, lookback_days)
    day = in_window(date_from, date_to)

    days = window_days(date_from, date_to)
    stored = read_table(spark, stores.pull, pull_fetch, days=days)
    merged = pull_ops.cost_preserving_replace(stored, pull_fetch.filter(day), date_from, date_to, tz=tz)
    merged = pull_ops.reattr_replace(merged, reattr_fetch.filter(day), date_from, date_to, tz=tz)
    pull = _stored(pull_ops.pull_dedupe(merged), stores.pull, date_from, date_to)

    stored_src = read_table(spark, stores.source_rows, source_fetch, days=days)
    source = _stored(upserts.source_upsert(stored_src, source_fetch.filter(day)), stores.source_rows, date_from, date_to)

    stored_map = read_latest(spark, stores.ad_map)
    map_rows = map_fetch if stored_map is None else stored_map.unionByName(map_fetch, allowMissingColumns=True)
    ad_map = spark.read.parquet(write_new_version(silver.adset_ad_map(map_rows.fillna({"ingest_seq": 0})), stores.ad_map))

    out = rebuild_window(spark, stores, pull, source, ad_map, date_from, date_to, tz)
    out["freshness"] = reports.freshness(out["growth_daily_totals"], today)
    return out
