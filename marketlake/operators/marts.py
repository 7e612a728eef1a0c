"""Warehouse path: staging views over raw JSON payloads, intermediate daily
metrics, event pivot and the acquisition marts (P1, P2, A1-A6, J1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import iso_week_start, month_start, ratio_if_nonzero

RAW_DIMS = ("app_id", "app_name", "platform", "media_source", "campaign", "campaign_id",
            "adset", "adset_id", "ad", "ad_id", "country")
MART_DIMS = ("app_key", "platform", "media_source", "campaign", "campaign_id",
             "adset", "adset_id", "ad", "ad_id", "country")
PERF_METRICS = ("impressions", "clicks", "installs", "cost")
EVENT_COLS = ("af_start_trial", "af_subscribe", "af_tutorial_completion", "rc_trial_converted_event")

# A strict numeric literal (what an SQL TRY_CAST to DOUBLE accepts); the JVM parser
# alone would also take suffixes such as '5d'.
_SQL_NUMBER = r"^\s*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$|^(?i)\s*[+-]?(?:inf|infinity|nan)\s*$"


PERF_FIELDS = (*RAW_DIMS, *PERF_METRICS)
EVENT_FIELDS = (*RAW_DIMS, "event_name", "event_count", "revenue")


def _parsed(raw: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """One JSON parse per row: every field read as text (numbers keep their literal text,
    JSON null -> NULL, nested values -> JSON text), like a JSON 'extract string'."""
    schema = ", ".join(f"`{f}` string" for f in fields)
    return raw.withColumn("_p", F.from_json(F.col("_payload"), schema))


def _field(name: str) -> Column:
    return F.col("_p")[name]


def try_double(text: Column) -> Column:
    """TRY_CAST(text AS DOUBLE): unparsable -> NULL."""
    return F.when(text.rlike(_SQL_NUMBER), F.trim(text).try_cast("double"))


def _lineage(raw: DataFrame) -> list[Column]:
    return [F.col(c) for c in ("_batch_id", "_ingested_at") if c in raw.columns]


def stage_performance(raw: DataFrame) -> DataFrame:
    """Typed view over the performance payload."""
    tail = [F.col("_row_hash")] if "_row_hash" in raw.columns else []
    return _parsed(raw, PERF_FIELDS).select(
        *_lineage(raw),
        F.col("_extract_date").alias("report_date"),
        *[_field(d).alias(d) for d in RAW_DIMS],
        *[try_double(_field(m)).alias(m) for m in PERF_METRICS],
        *tail,
    )


def stage_events(raw: DataFrame) -> DataFrame:
    """Typed view over the in-app-event payload."""
    tail = [F.col("_row_hash")] if "_row_hash" in raw.columns else []
    return _parsed(raw, EVENT_FIELDS).select(
        *_lineage(raw),
        F.col("_extract_date").alias("report_date"),
        *[_field(d).alias(d) for d in RAW_DIMS],
        _field("event_name").alias("event_name"),
        try_double(_field("event_count")).alias("event_count"),
        try_double(_field("revenue")).alias("revenue"),
        *tail,
    )


def _keyed(stg: DataFrame) -> DataFrame:
    return stg.withColumn("app_key", F.coalesce(F.col("app_id"), F.col("app_name")))


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def daily_event_metrics(stg_events: DataFrame) -> DataFrame:
    """A1: event rows summed per date, app key, dims and event name (NULL -> 0)."""
    return _keyed(stg_events).groupBy("report_date", *MART_DIMS, "event_name").agg(
        F.sum(_z("event_count")).alias("event_count"), F.sum(_z("revenue")).alias("revenue"))


def daily_performance_metrics(stg_perf: DataFrame) -> DataFrame:
    """A2: performance rows summed per date, app key and dims (NULL -> 0)."""
    return _keyed(stg_perf).groupBy("report_date", *MART_DIMS).agg(
        *[F.sum(_z(m)).alias(m) for m in PERF_METRICS])


def event_pivot(event_metrics: DataFrame) -> DataFrame:
    """A3: event rows -> one column per tracked event (fixed list, no pivot scan) + revenue."""
    ev = F.col("event_name")
    return event_metrics.groupBy("report_date", *MART_DIMS).agg(
        *[F.sum(F.when(ev == e, F.col("event_count")).otherwise(F.lit(0.0))).alias(e) for e in EVENT_COLS],
        F.sum(_z("revenue")).alias("revenue"),
    )


def daily_acquisition(perf: DataFrame, events: DataFrame) -> DataFrame:
    """Performance FULL OUTER event pivot.

    Keys: report_date and app_key by plain equality (NULL app_key never matches);
    platform, media_source, country compared as COALESCE(x, ''); campaign, adset, ad
    as COALESCE(id, name, ''). Metrics 0-filled; ratios use the raw performance cost,
    so event-only rows get NULL ratios.
    """
    p = perf.select(*[F.col(c).alias("p_" + c) for c in perf.columns])
    e = events.select(*[F.col(c).alias("e_" + c) for c in events.columns])

    def blank(prefix: str, c: str) -> Column:
        return F.coalesce(F.col(prefix + c), F.lit(""))

    def ident(prefix: str, c: str) -> Column:
        return F.coalesce(F.col(f"{prefix}{c}_id"), F.col(prefix + c), F.lit(""))

    cond = (
        (F.col("p_report_date") == F.col("e_report_date"))
        & (F.col("p_app_key") == F.col("e_app_key"))
        & (blank("p_", "platform") == blank("e_", "platform"))
        & (blank("p_", "media_source") == blank("e_", "media_source"))
        & (ident("p_", "campaign") == ident("e_", "campaign"))
        & (ident("p_", "adset") == ident("e_", "adset"))
        & (ident("p_", "ad") == ident("e_", "ad"))
        & (blank("p_", "country") == blank("e_", "country"))
    )
    j = p.join(e, cond, "full_outer")
    return j.select(
        F.coalesce("p_report_date", "e_report_date").alias("report_date"),
        *[F.coalesce("p_" + d, "e_" + d).alias(d) for d in MART_DIMS],
        *[_z("p_" + m).alias(m) for m in PERF_METRICS],
        *[_z("e_" + c).alias(c) for c in EVENT_COLS],
        _z("e_revenue").alias("revenue"),
        F.when(_z("p_installs") != 0, F.col("p_cost") / F.nullif(F.col("p_installs"), F.lit(0.0)))
        .alias("cost_per_install"),
        F.when(_z("e_af_start_trial") != 0, F.col("p_cost") / F.nullif(F.col("e_af_start_trial"), F.lit(0.0)))
        .alias("cost_per_af_start_trial"),
        F.when(_z("e_af_subscribe") != 0, F.col("p_cost") / F.nullif(F.col("e_af_subscribe"), F.lit(0.0)))
        .alias("cost_per_af_subscribe"),
    )


def _period_rollup(daily: DataFrame, period: Column, name: str) -> DataFrame:
    sums = (*PERF_METRICS, *EVENT_COLS, "revenue")
    g = daily.groupBy(period.alias(name), *MART_DIMS).agg(*[F.sum(c).alias(c) for c in sums])
    return g.select(
        name, *MART_DIMS, *sums,
        ratio_if_nonzero("cost", "installs").alias("cost_per_install"),
        ratio_if_nonzero("cost", "af_start_trial").alias("cost_per_af_start_trial"),
        ratio_if_nonzero("cost", "af_subscribe").alias("cost_per_af_subscribe"),
    )


def weekly_acquisition(daily: DataFrame) -> DataFrame:
    """A5: ISO-week (Monday) rollup; ratios of sums (event-only weeks -> 0.0, not NULL)."""
    return _period_rollup(daily, iso_week_start("report_date"), "week_start")


def monthly_acquisition(daily: DataFrame) -> DataFrame:
    """Month rollup."""
    return _period_rollup(daily, month_start("report_date"), "month_start")
