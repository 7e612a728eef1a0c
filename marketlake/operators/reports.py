"""Reporting queries over the silver and gold layers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.constants import UNKNOWN_ENTITY
from marketlake.functions import ratio_if_positive, week_label_monday

ENTITIES = ("media_source", "campaign", "adset", "ad")


def _window(df: DataFrame, date_from: _dt.date, date_to: _dt.date, model: str | None = None) -> DataFrame:
    """Rows of the window; of one attribution model if given. Without a model the rows of both
    count, so spend that both models carry counts twice."""
    rows = df.filter(F.col("fact_date").between(F.lit(date_from), F.lit(date_to)))
    return rows if model is None else rows.filter(F.col("attribution_model") == model)


def _totals() -> list[Column]:
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return [F.sum(z("spend")).alias("spend"), F.sum(z("af_subscribe")).alias("af_subscribe"),
            F.sum(z("af_start_trial")).alias("af_start_trial"), F.sum(z("installs")).alias("installs")]


def _cac() -> Column:
    return ratio_if_positive("spend", "af_subscribe").alias("cac")


def report_summary(silver: DataFrame, date_from: _dt.date, date_to: _dt.date, attribution_model: str | None = None) -> DataFrame:
    """One row of window totals + cac (NULL sums on an empty window)."""
    return _window(silver, date_from, date_to, attribution_model).agg(*_totals()).select(
        F.lit(date_from).alias("date_from"), F.lit(date_to).alias("date_to"),
        "spend", "af_subscribe", "af_start_trial", "installs", _cac())


def report_daily_cac(silver: DataFrame, date_from: _dt.date, date_to: _dt.date, attribution_model: str | None = None) -> DataFrame:
    """Totals + cac per date."""
    return (_window(silver, date_from, date_to, attribution_model).groupBy("fact_date").agg(*_totals())
            .select("fact_date", "spend", "af_subscribe", "af_start_trial", "installs", _cac())
            .orderBy("fact_date"))


def report_weekly_cac(silver: DataFrame, date_from: _dt.date, date_to: _dt.date, attribution_model: str | None = None) -> DataFrame:
    """Totals + cac per Monday-week label."""
    return (_window(silver, date_from, date_to, attribution_model)
            .groupBy(week_label_monday("fact_date").alias("year_week"))
            .agg(F.min("fact_date").alias("week_start"), F.max("fact_date").alias("week_end"), *_totals())
            .select("year_week", "week_start", "week_end", "spend", "af_subscribe", "af_start_trial",
                    "installs", _cac())
            .orderBy("week_start"))


def top_entities(silver: DataFrame, date_from: _dt.date, date_to: _dt.date, entity: str,
                 limit: int = 10, attribution_model: str | None = None) -> DataFrame:
    """Top-n entities by subscribes, then spend (entity as final tiebreak)."""
    if entity not in ENTITIES:
        raise ValueError(f"no such entity: {entity!r} (known: {list(ENTITIES)})")
    g = (_window(silver, date_from, date_to, attribution_model)
         .groupBy(F.coalesce(F.col(entity), F.lit(UNKNOWN_ENTITY)).alias("entity"))
         .agg(*_totals()))
    return (g.select("entity", "spend", "af_subscribe", "af_start_trial", "installs", _cac())
            .orderBy(F.col("af_subscribe").desc(), F.col("spend").desc(), F.col("entity").asc())
            .limit(limit))


def growth_totals_summary(daily_totals: DataFrame, date_from: _dt.date, date_to: _dt.date) -> DataFrame:
    """Window over the day totals: day count, 0-filled totals, cost per trial, cac,
    and the latest date on or before the window end (not bounded by its start)."""
    in_win = F.col("fact_date").between(F.lit(date_from), F.lit(date_to))
    s = lambda c: F.coalesce(F.sum(F.when(in_win, F.col(c))), F.lit(0.0)).alias(c)
    g = daily_totals.filter(F.col("fact_date") <= F.lit(date_to)).agg(
        F.count(F.when(in_win, 1)).alias("day_count"),
        s("installs"), s("spend"), s("af_start_trial"), s("af_subscribe"), s("revenue"),
        F.max("fact_date").alias("max_fact_date_on_or_before_end"),
    )
    return g.select(
        F.lit(date_from).alias("date_from"), F.lit(date_to).alias("date_to"), "day_count",
        "installs", "spend", "af_start_trial", "af_subscribe", "revenue",
        F.when(F.col("af_start_trial") != 0, F.col("spend") / F.col("af_start_trial")).alias("cost_per_trial"),
        F.when(F.col("af_subscribe") != 0, F.col("spend") / F.col("af_subscribe")).alias("cac_subscribe"),
        "max_fact_date_on_or_before_end",
    )


def freshness(daily_totals: DataFrame, today: _dt.date | None = None,
              tz: str = "America/Los_Angeles") -> DataFrame:
    """Latest date, rows for yesterday (business calendar), total rows, yesterday_present.
    ``today`` defaults to the current date in the business time zone."""
    from marketlake.functions import business_today
    yesterday = F.lit(today - _dt.timedelta(days=1)) if today is not None else F.date_sub(business_today(tz), 1)
    g = daily_totals.agg(
        F.max("fact_date").alias("max_fact_date"),
        F.count(F.when(F.col("fact_date") == yesterday, 1)).alias("yesterday_row_count"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return g.select("max_fact_date", yesterday.alias("yesterday"), "yesterday_row_count", "row_count",
                    (F.col("yesterday_row_count") > 0).alias("yesterday_present"))
