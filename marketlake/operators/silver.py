"""Silver rebuilds from the long source rows."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import constants as K
from marketlake.functions import attribution_model_of, base_kpi_of, is_ad_grain
from marketlake.operators.latest import ascending_number, descending, keep_preferred
from marketlake.session import scratch_path

ADSET_GRAIN_DIMS = ("media_source", "campaign", "adset", "ad")
AD_GRAIN_DIMS = ("media_source", "campaign", "ad")
BROADCAST_ROWS = 500_000  # short rows (a KPI name, two dates, a rank) that every executor may hold
SOURCE_VALUE_COLS = ("metric_value", "installs", "cost", "currency", "fetched_at")


def _in_window(df: DataFrame, date_from: _dt.date | None, date_to: _dt.date | None) -> DataFrame:
    df = df.filter(F.col("fact_date").isNotNull())
    if date_from is not None:
        df = df.filter(F.col("fact_date") >= F.lit(date_from))
    if date_to is not None:
        df = df.filter(F.col("fact_date") <= F.lit(date_to))
    return df


def canonical_source_rows(
    source: DataFrame,
    dims: Sequence[str],
    ad_grain: bool,
    date_from: _dt.date | None = None,
    date_to: _dt.date | None = None,
) -> DataFrame:
    """Per (fact_date, dims, kpi_name) the row of the narrowest fetch window,
    latest fetch first."""
    grain = is_ad_grain("kpi_name")
    rows = _in_window(source.filter(grain if ad_grain else ~grain), date_from, date_to)
    width = F.datediff("fetch_window_to", "fetch_window_from")
    return keep_preferred(
        rows,
        ["fact_date", *dims, "kpi_name"],
        prefer=[ascending_number(width), descending("fetched_at")],
        keep=list(SOURCE_VALUE_COLS),
    )


def _event_sum(base: Column, kpi: str) -> Column:
    return F.sum(F.when(base == kpi, F.coalesce(F.col("metric_value"), F.lit(0.0))).otherwise(F.lit(0.0)))


def marketing_fact_daily(
    source: DataFrame,
    business_tz: str = K.DEFAULT_BUSINESS_TZ,
    date_from: _dt.date | None = None,
    date_to: _dt.date | None = None,
) -> DataFrame:
    """Adset-grain source rows (long, one per KPI) -> wide daily facts per model."""
    canon = canonical_source_rows(source, ADSET_GRAIN_DIMS, ad_grain=False, date_from=date_from, date_to=date_to)
    canon = canon.withColumn("attribution_model", attribution_model_of("kpi_name")).withColumn(
        "base_kpi", base_kpi_of("kpi_name"))
    base = F.col("base_kpi")
    keys = ["fact_date", *ADSET_GRAIN_DIMS, "attribution_model"]
    agg = canon.groupBy(*keys).agg(
        F.max("currency").alias("currency"),
        F.max("fetched_at").alias("fetched_at"),
        F.coalesce(F.max("installs"), F.lit(0.0)).alias("installs"),
        F.coalesce(F.max("cost"), F.lit(0.0)).alias("spend"),
        *[_event_sum(base, e + K.KPI_UNIQUE_USERS_SUFFIX).alias(e) for e in K.EVENT_NAMES],
        F.max(F.when(base == K.KPI_ARPU, F.col("metric_value"))).alias("arpu_ltv"),
    )
    return agg.select(
        "fact_date",
        F.lit(K.SRC_MCP).alias("source_system"),
        *ADSET_GRAIN_DIMS,
        "attribution_model",
        "installs", "spend",
        "af_start_trial", "af_subscribe", "af_tutorial_completion", "rc_trial_converted_event",
        "arpu_ltv", "currency",
        F.lit(business_tz).alias("timezone"),
        "fetched_at",
    )


def adset_ad_map(map_rows: DataFrame) -> DataFrame:
    """The last row (largest ingest_seq) per (media_source, campaign, ad); NULL dims -> ''."""
    rows = map_rows.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("media_source", "campaign", "adset", "ad")],
        "installs", "ingest_seq",
    )
    return keep_preferred(
        rows, ["media_source", "campaign", "ad"], prefer=[descending("ingest_seq")], keep=["adset", "installs"]
    ).select("media_source", "campaign", "adset", "ad", "installs")


def _ad_parts(source: DataFrame, date_from, date_to) -> tuple[DataFrame, DataFrame]:
    canon = canonical_source_rows(source, AD_GRAIN_DIMS, ad_grain=True, date_from=date_from, date_to=date_to)
    perf = canon.filter(F.col("kpi_name") == K.KPI_AD_PERFORMANCE).select(
        F.col("fact_date").alias("p_date"), F.col("media_source").alias("p_ms"),
        F.col("campaign").alias("p_campaign"), F.col("ad").alias("p_ad"),
        F.coalesce(F.col("installs"), F.lit(0.0)).alias("p_installs"),
        F.coalesce(F.col("cost"), F.lit(0.0)).alias("p_spend"),
        F.col("currency").alias("p_currency"),
    )
    events = canon.filter(F.col("kpi_name") != K.KPI_AD_PERFORMANCE).withColumn(
        "attribution_model", attribution_model_of("kpi_name")).withColumn("base_kpi", base_kpi_of("kpi_name"))
    base = F.col("base_kpi")
    ev = events.groupBy("fact_date", *AD_GRAIN_DIMS, "attribution_model").agg(
        *[_event_sum(base, K.KPI_AD_PREFIX + e + K.KPI_UNIQUE_USERS_SUFFIX).alias(e) for e in K.EVENT_NAMES],
        F.max(F.nullif(F.col("fetched_at"), F.lit(""))).alias("fetched_at"),
    )
    return ev, perf


def ad_perf_join(ev: DataFrame, perf: DataFrame) -> DataFrame:
    """Event rows LEFT JOIN ad performance, null-safe on (date, media source, campaign,
    ad); missing performance -> 0 installs, 0 spend, NULL currency. Ads with performance but
    no event row do not appear."""
    j = ev.join(
        perf,
        (ev.fact_date.eqNullSafe(perf.p_date)) & (ev.media_source.eqNullSafe(perf.p_ms))
        & (ev.campaign.eqNullSafe(perf.p_campaign)) & (ev.ad.eqNullSafe(perf.p_ad)),
        "left",
    )
    return j.withColumn("installs", F.coalesce(F.col("p_installs"), F.lit(0.0))).withColumn(
        "spend", F.coalesce(F.col("p_spend"), F.lit(0.0))).withColumn("currency", F.col("p_currency")).drop(
        "p_date", "p_ms", "p_campaign", "p_ad", "p_installs", "p_spend", "p_currency")


def ad_map_lookup(rows: DataFrame, ad_map: DataFrame) -> DataFrame:
    """Adset from the map by plain (media_source, campaign, ad); default ''."""
    m = ad_map.select(F.col("media_source").alias("m_ms"), F.col("campaign").alias("m_campaign"),
                      F.col("ad").alias("m_ad"), F.col("adset").alias("m_adset"))
    j = rows.join(m, (rows.media_source == m.m_ms) & (rows.campaign == m.m_campaign) & (rows.ad == m.m_ad), "left")
    return j.withColumn("adset", F.coalesce(F.col("m_adset"), F.lit(""))).drop("m_ms", "m_campaign", "m_ad", "m_adset")


def marketing_fact_ad(
    source: DataFrame,
    ad_map: DataFrame,
    business_tz: str = K.DEFAULT_BUSINESS_TZ,
    date_from: _dt.date | None = None,
    date_to: _dt.date | None = None,
) -> DataFrame:
    """Ad-grain facts. Event KPIs make the rows (per model); performance (installs,
    spend, currency) is looked up null-safely (J5); adset comes from the map (J6)."""
    canon = canonical_source_rows(source, AD_GRAIN_DIMS, ad_grain=True, date_from=date_from, date_to=date_to)
    perf = F.col("kpi_name") == K.KPI_AD_PERFORMANCE
    model, base = attribution_model_of("kpi_name"), base_kpi_of("kpi_name")

    def of(m: str) -> list[Column]:
        mine = ~perf & (model == m)
        sums = [F.sum(F.when(mine & (base == K.KPI_AD_PREFIX + e + K.KPI_UNIQUE_USERS_SUFFIX), F.coalesce("metric_value", F.lit(0.0)))
                      .otherwise(0.0)).alias(e) for e in K.EVENT_NAMES]
        latest = F.max(F.when(mine, F.nullif(F.col("fetched_at"), F.lit("")))).alias("fetched_at")
        return [F.struct(F.count(F.when(mine, 1)).alias("n"), F.lit(m).alias("attribution_model"), *sums, latest)]

    # one pass: performance and both models' events are folds of the same group
    days = canon.groupBy("fact_date", *AD_GRAIN_DIMS).agg(
        F.coalesce(F.max(F.when(perf, F.col("installs"))), F.lit(0.0)).alias("installs"),
        F.coalesce(F.max(F.when(perf, F.col("cost"))), F.lit(0.0)).alias("spend"),
        F.max(F.when(perf, F.col("currency"))).alias("currency"),
        F.array(*of(K.MODEL_LTV), *of(K.MODEL_ACTIVITY)).alias("models"))
    rows = days.withColumn("m", F.explode(F.filter("models", lambda x: x["n"] > 0))).select("*", "m.*").drop("models", "m", "n")
    joined = ad_map_lookup(rows, ad_map)
    return joined.select(
        "fact_date",
        F.lit(K.SRC_MCP_AD).alias("source_system"),
        "media_source", "campaign", "adset", "ad", "attribution_model",
        "installs", "spend",
        "af_start_trial", "af_subscribe", "af_tutorial_completion", "rc_trial_converted_event",
        "currency",
        F.lit(business_tz).alias("timezone"),
        F.coalesce(F.col("fetched_at"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
        .alias("fetched_at"),
    )


def silver_window_rebuild(stored: DataFrame, rebuilt: DataFrame, date_from: _dt.date, date_to: _dt.date,
                          source_system: str | None = None) -> DataFrame:
    """Drop every stored row in [from, to] (of ``source_system`` if given), add the
    rebuilt rows. Dates in the window without rebuilt rows end up empty."""
    in_window = F.col("fact_date").between(F.lit(date_from), F.lit(date_to))
    if source_system is not None:
        in_window = in_window & (F.col("source_system") == source_system)
    kept = stored.filter(~F.coalesce(in_window, F.lit(False)))
    return kept.unionByName(rebuilt.filter(F.col("fact_date").between(F.lit(date_from), F.lit(date_to))))


def backfill_attribution_model(old_silver: DataFrame, key_dims: Sequence[str] = ADSET_GRAIN_DIMS,
                               order_col: str = "ingest_seq") -> DataFrame:
    """M2: legacy silver without attribution_model -> model 'ltv'; on a duplicate unique key
    the first row (smallest ``order_col``) is kept. NULL key parts never collide
    (unique constraints treat NULLs as distinct), so such rows are all kept."""
    df = old_silver.withColumn("attribution_model", F.lit(K.MODEL_LTV))
    keys = ["fact_date", "source_system", *key_dims, "attribution_model"]
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    nullable = df.filter(has_null)
    keyed = df.filter(~has_null)
    keep = [c for c in df.columns if c not in keys]
    first = keep_preferred(keyed, keys, prefer=[ascending_number(order_col)], keep=keep)
    return first.select(*df.columns).unionByName(nullable)


def grain_fallback(source: DataFrame, grain_col: str = "grain_rank") -> DataFrame:
    """M3: per (kpi_name, fetch window) keep only the rows of the most preferred grouping
    (smallest ``grain_rank``) that returned rows.

    The best groupings, a row for each window, are written and counted first: up to ``BROADCAST_ROWS``
    they are broadcast, so that no source row is shuffled; more are met by a shuffled join."""
    keys = ["kpi_name", "fetch_window_from", "fetch_window_to"]
    spark = source.sparkSession
    best = source.groupBy(*keys).agg(F.min(grain_col).alias(grain_col))
    path = scratch_path(spark, f"best-grain-{uuid.uuid4().hex}")
    best.write.parquet(path)
    stored = spark.read.schema(best.schema).parquet(path)
    if stored.count() <= BROADCAST_ROWS:
        stored = F.broadcast(stored)
    return source.join(stored, [*keys, grain_col], "left_semi")
