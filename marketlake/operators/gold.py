"""Gold layer: day totals with a winner per day, proportional scaling, weekly and
campaign rollups, row-level union and breakdowns (A7-A17, P15-P17, U1, U2, J2-J4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import constants as K
from marketlake.functions import ratio_if_positive, scale_factor, week_label_monday


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def _sum0(c: str, alias: str | None = None) -> Column:
    return F.sum(_z(c)).alias(alias or c)


# ---------------------------------------------------------------------------
# Per-day sums of each source
# ---------------------------------------------------------------------------

def pull_day(pull: DataFrame, tz: str = K.DEFAULT_BUSINESS_TZ, with_revenue: bool = True) -> DataFrame:
    """Pull sums per date (all report segments) for rows fetched in ``tz``."""
    metrics = [_sum0("installs"), _sum0("cost", "spend"), _sum0("af_start_trial"), _sum0("af_subscribe")]
    if with_revenue:
        metrics.append(_sum0("revenue"))
    metrics += [_sum0("rc_trial_converted_event"), _sum0("af_tutorial_completion"),
                F.max("fetched_at").alias("fetched_at")]
    return pull.filter(F.col("timezone") == tz).groupBy("fact_date").agg(*metrics)


def mcp_day(silver: DataFrame, model: str = K.MODEL_LTV) -> DataFrame:
    """Silver sums per date for one attribution model."""
    return (
        silver.filter((F.col("source_system") == K.SRC_MCP) & (F.col("attribution_model") == model))
        .groupBy("fact_date")
        .agg(_sum0("installs"), _sum0("spend"), _sum0("af_start_trial"), _sum0("af_subscribe"),
             _sum0("rc_trial_converted_event"), _sum0("af_tutorial_completion"),
             F.max("fetched_at").alias("fetched_at"))
    )


# ---------------------------------------------------------------------------
# Winner per day
# ---------------------------------------------------------------------------

def source_priority(pull: DataFrame, silver: DataFrame, model: str = K.MODEL_LTV,
                    tz: str = K.DEFAULT_BUSINESS_TZ) -> DataFrame:
    """Pull day sums FULL OUTER silver day sums on fact_date (both unique per date, so
    one full outer join equals "union of days + two left joins"), with the winner flag:
    Pull wins when its spend > 0, or when it has the day and the silver spend (0 when
    absent) is 0."""
    ltv = model == K.MODEL_LTV
    p = pull_day(pull, tz, with_revenue=ltv)
    p = p.select("fact_date", *[F.col(c).alias("pull_" + c) for c in p.columns if c != "fact_date"],
                 F.lit(True).alias("pull_present"))
    m = mcp_day(silver, model)
    m = m.select("fact_date", *[F.col(c).alias("own_" + c) for c in m.columns if c != "fact_date"])
    j = p.join(m, "fact_date", "full_outer")
    takes_pull = (_z("pull_spend") > 0) | (F.col("pull_present").isNotNull() & (_z("own_spend") == 0))
    return j.withColumn("takes_pull", takes_pull)


def daily_totals(pull: DataFrame, silver: DataFrame, model: str = K.MODEL_LTV,
                 tz: str = K.DEFAULT_BUSINESS_TZ) -> DataFrame:
    """A9 (ltv) / A14 (activity): every metric from the day's winner (J2); revenue (ltv
    only) is always Pull's; fetched_at is Pull's when Pull has the day."""
    ltv = model == K.MODEL_LTV
    m_src = K.SRC_MCP if ltv else K.SRC_MCP + "_activity"
    j = source_priority(pull, silver, model, tz)

    def pick(c: str) -> Column:
        return F.when(F.col("takes_pull"), _z("pull_" + c)).otherwise(_z("own_" + c))

    cols = [
        "fact_date",
        F.lit(tz).alias("timezone"),
        F.lit(model).alias("attribution_model"),
        pick("installs").alias("installs"),
        pick("spend").alias("spend"),
        pick("af_start_trial").alias("af_start_trial"),
        pick("af_subscribe").alias("af_subscribe"),
    ]
    if ltv:
        cols.append(_z("pull_revenue").alias("revenue"))
    cols += [
        pick("rc_trial_converted_event").alias("rc_trial_converted_event"),
        pick("af_tutorial_completion").alias("af_tutorial_completion"),
        ratio_if_positive(pick("spend"), pick("af_subscribe")).alias("cac"),
        F.when(F.col("takes_pull"), F.lit(K.SRC_PULL)).otherwise(F.lit(m_src)).alias("primary_source"),
        F.when(F.col("takes_pull"), F.lit(K.CONF_HIGH)).otherwise(F.lit(K.CONF_MEDIUM)).alias("source_confidence"),
        F.coalesce(F.col("pull_fetched_at"), F.col("own_fetched_at")).alias("fetched_at"),
    ]
    return j.select(*cols)


def weekly_totals(daily: DataFrame) -> DataFrame:
    """A10: day totals per Monday-week label ('%Y-W%W'); week_start/end are the first and
    last date present in the week."""
    return (
        daily.groupBy(week_label_monday("fact_date").alias("year_week"))
        .agg(
            F.min("fact_date").alias("week_start"),
            F.max("fact_date").alias("week_end"),
            _sum0("installs"), _sum0("spend"), _sum0("af_start_trial"), _sum0("af_subscribe"), _sum0("revenue"),
        )
        .select(
            "year_week", "week_start", "week_end",
            F.lit(K.MODEL_LTV).alias("attribution_model"),
            "installs", "spend", "af_start_trial", "af_subscribe", "revenue",
            ratio_if_positive("spend", "af_subscribe").alias("cac"),
            ratio_if_positive("spend", "af_start_trial").alias("cost_per_af_start_trial"),
            F.lit("growth_daily_totals").alias("source_layer"),
            F.lit(K.CONF_HIGH).alias("source_confidence"),
        )
    )


def campaign_daily(pull: DataFrame, tz: str = K.DEFAULT_BUSINESS_TZ) -> DataFrame:
    """Pull by date, media source, campaign with three cost ratios."""
    g = (
        pull.filter(F.col("timezone") == tz)
        .groupBy("fact_date", "media_source", "campaign")
        .agg(_sum0("installs"), _sum0("cost", "spend"), _sum0("revenue"), _sum0("clicks"), _sum0("impressions"),
             _sum0("af_start_trial"), _sum0("af_subscribe"), _sum0("rc_trial_converted_event"),
             _sum0("af_tutorial_completion"),
             F.sum("installs").alias("_n_installs"), F.sum("af_start_trial").alias("_n_trials"),
             F.sum("af_subscribe").alias("_n_subs"),
             F.max("fetched_at").alias("fetched_at"))
    )
    return g.select(
        "fact_date", F.lit(tz).alias("timezone"), F.lit(K.MODEL_LTV).alias("attribution_model"),
        "media_source", "campaign", "installs", "spend", "revenue", "clicks", "impressions",
        "af_start_trial", "af_subscribe", "rc_trial_converted_event", "af_tutorial_completion",
        F.when(F.col("installs") > 0, F.col("spend") / F.col("_n_installs")).alias("cost_per_install"),
        F.when(F.col("af_start_trial") > 0, F.col("spend") / F.col("_n_trials")).alias("cost_per_trial"),
        F.when(F.col("af_subscribe") > 0, F.col("spend") / F.col("_n_subs")).alias("cost_per_subscriber"),
        F.lit(K.SRC_PULL).alias("primary_source"), F.lit(K.CONF_HIGH).alias("source_confidence"),
        "fetched_at",
    )


# ---------------------------------------------------------------------------
# Proportional scaling to Pull media-source totals
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Grain:
    name: str
    dims: tuple[str, ...]


CAMPAIGN = Grain("campaign", ("media_source", "campaign"))
ADSET = Grain("adset", ("media_source", "campaign", "adset"))
AD = Grain("ad", ("media_source", "campaign", "adset", "ad"))

_SCALED = (("spend", "spend"), ("installs", "installs"), ("af_start_trial", "trials"), ("af_subscribe", "subs"))


def pull_media_source_day(pull: DataFrame, tz: str = K.DEFAULT_BUSINESS_TZ) -> DataFrame:
    """Pull totals per (fact_date, media_source): the scaling target. Computed once and
    passed to every scaled view (the five views share it)."""
    return (
        pull.filter(F.col("timezone") == tz)
        .groupBy("fact_date", "media_source")
        .agg(_sum0("cost", "pull_spend"), _sum0("installs", "pull_installs"),
             _sum0("af_start_trial", "pull_trials"), _sum0("af_subscribe", "pull_subs"))
    )


def _detail_from_daily(silver: DataFrame, grain: Grain, model: str) -> DataFrame:
    return (
        silver.filter((F.col("source_system") == K.SRC_MCP) & (F.col("attribution_model") == model))
        .groupBy("fact_date", *grain.dims)
        .agg(_sum0("spend"), _sum0("installs"), _sum0("af_start_trial"), _sum0("af_subscribe"),
             _sum0("rc_trial_converted_event"), _sum0("af_tutorial_completion"),
             F.max("currency").alias("currency"), F.max("fetched_at").alias("fetched_at"))
    )


def adset_resolve(silver_ad: DataFrame, ad_map: DataFrame, model: str = K.MODEL_LTV) -> DataFrame:
    """Ad rows of one model (not re-grouped, metrics 0-filled) with
    adset := COALESCE(NULLIF(adset, ''), map.adset, '') by plain (media_source, campaign, ad)."""
    return _detail_from_ad(silver_ad, ad_map, model)


def _detail_from_ad(silver_ad: DataFrame, ad_map: DataFrame | None, model: str) -> DataFrame:
    """A13 input: ad rows are not re-grouped; adset resolved by the map (J4). Without a map
    the rows' own adset stands: silver just built from the current map has it already."""
    a = silver_ad.filter(F.col("attribution_model") == model).select(
        "fact_date", "media_source", "campaign", "ad",
        F.coalesce(F.col("adset"), F.lit("")).alias("adset"),
        _z("spend").alias("spend"), _z("installs").alias("installs"),
        _z("af_start_trial").alias("af_start_trial"), _z("af_subscribe").alias("af_subscribe"),
        _z("rc_trial_converted_event").alias("rc_trial_converted_event"),
        _z("af_tutorial_completion").alias("af_tutorial_completion"),
        "currency", "fetched_at",
    )
    if ad_map is None:
        return a
    m = ad_map.select(F.col("media_source").alias("m_ms"), F.col("campaign").alias("m_campaign"),
                      F.col("ad").alias("m_ad"), F.col("adset").alias("m_adset"))
    j = a.join(m, (a.media_source == m.m_ms) & (a.campaign == m.m_campaign) & (a.ad == m.m_ad), "left")
    return j.withColumn(
        "adset", F.coalesce(F.nullif(F.col("adset"), F.lit("")), F.col("m_adset"), F.lit(""))
    ).drop("m_ms", "m_campaign", "m_ad", "m_adset")


def scale_join(detail: DataFrame, pull_ms: DataFrame) -> DataFrame:
    """Detail rows with their own (date, media source) totals and the Pull totals of
    that pair; plain equality, so a NULL media source meets neither (factor 1).

    Both totals are aggregates, combined map-side to one row per (date, media source), and
    come back by one join: no window holds a hot media source's rows in one task. The detail is
    read twice, so it should stand on stored silver: a computed one is computed twice.
    """
    own = (detail.filter(F.col("media_source").isNotNull()).groupBy("fact_date", "media_source")
           .agg(F.sum("spend").alias("own_spend"), F.sum("installs").alias("own_installs"),
                F.sum("af_start_trial").alias("own_trials"), F.sum("af_subscribe").alias("own_subs")))
    totals = own.join(pull_ms, ["fact_date", "media_source"], "left")
    return detail.join(totals, ["fact_date", "media_source"], "left")


def scaled_breakdown(detail: DataFrame, pull_ms: DataFrame, grain: Grain, model: str, label: str,
                     tz: str = K.DEFAULT_BUSINESS_TZ) -> DataFrame:
    """Scale spend, installs, trials and subscribes of each detail row by
    Pull(date, media_source) / own(date, media_source); factor 1 where either is missing
    or own is 0. Plain equality on media_source: NULL never meets a total.

    The totals' side is one row per (date, media source): AQE broadcasts it when its
    measured size allows and splits a hot media source's rows otherwise.
    """
    j = scale_join(detail, pull_ms)
    scaled = {
        out: F.col(out) * scale_factor(F.col("pull_" + short), F.col("own_" + short)) for out, short in _SCALED
    }
    j = j.select("*", *[v.alias("s_" + k) for k, v in scaled.items()])
    has_pull = F.col("pull_spend").isNotNull()
    return j.select(
        "fact_date", F.lit(tz).alias("timezone"), F.lit(model).alias("attribution_model"),
        *grain.dims,
        F.col("s_spend").alias("spend"), F.col("s_installs").alias("installs"),
        F.col("s_af_start_trial").alias("af_start_trial"), F.col("s_af_subscribe").alias("af_subscribe"),
        "rc_trial_converted_event", "af_tutorial_completion",
        ratio_if_positive("s_spend", "s_installs").alias("cost_per_install"),
        ratio_if_positive("s_spend", "s_af_start_trial").alias("cost_per_trial"),
        ratio_if_positive("s_spend", "s_af_subscribe").alias("cost_per_subscriber"),
        "currency",
        F.when(has_pull, F.lit(label + "_scaled")).otherwise(F.lit(label + "_raw")).alias("primary_source"),
        F.when(has_pull, F.lit(K.CONF_HIGH)).otherwise(F.lit(K.CONF_MEDIUM)).alias("source_confidence"),
        "fetched_at",
    )


def _label(base: str, model: str) -> str:
    return base if model == K.MODEL_LTV else base + "_activity"


def scaled_daily(pull: DataFrame, silver: DataFrame, grain: Grain, model: str = K.MODEL_LTV,
                 tz: str = K.DEFAULT_BUSINESS_TZ, pull_ms: DataFrame | None = None) -> DataFrame:
    """A12 (adset, ltv), A15 (campaign, activity), A16 (adset, activity)."""
    pull_ms = pull_ms if pull_ms is not None else pull_media_source_day(pull, tz)
    return scaled_breakdown(_detail_from_daily(silver, grain, model), pull_ms, grain, model,
                            _label(K.SRC_MCP, model), tz)


def scaled_ad_daily(pull: DataFrame, silver_ad: DataFrame, ad_map: DataFrame | None, model: str = K.MODEL_LTV,
                    tz: str = K.DEFAULT_BUSINESS_TZ, pull_ms: DataFrame | None = None) -> DataFrame:
    """A13 (ltv) / A17 (activity)."""
    pull_ms = pull_ms if pull_ms is not None else pull_media_source_day(pull, tz)
    return scaled_breakdown(_detail_from_ad(silver_ad, ad_map, model), pull_ms, AD, model,
                            _label(K.SRC_MCP_AD, model), tz)


# ---------------------------------------------------------------------------
# Row-level union and breakdowns
# ---------------------------------------------------------------------------

def growth_fact_rows(pull: DataFrame, silver: DataFrame, tz: str = K.DEFAULT_BUSINESS_TZ) -> DataFrame:
    """Pull rows (ltv, high) UNION ALL silver rows (own model, no revenue)."""
    cols = ["media_source", "campaign", "adset", "ad", "installs"]
    p = pull.filter(F.col("timezone") == tz).select(
        "fact_date", F.lit(K.SRC_PULL).alias("source_system"), F.lit(K.MODEL_LTV).alias("attribution_model"),
        *cols, F.col("cost").alias("spend"), "af_start_trial", "af_subscribe", "revenue",
        "rc_trial_converted_event", "af_tutorial_completion", "currency", "timezone", "fetched_at",
        F.lit(K.CONF_HIGH).alias("source_confidence"),
    )
    m = silver.filter(F.col("source_system") == K.SRC_MCP).select(
        "fact_date", F.lit(K.SRC_MCP).alias("source_system"), "attribution_model",
        *cols, "spend", "af_start_trial", "af_subscribe", F.lit(None).cast("double").alias("revenue"),
        "rc_trial_converted_event", "af_tutorial_completion", "currency", "timezone", "fetched_at",
        F.lit(K.CONF_EXPERIMENTAL).alias("source_confidence"),
    )
    return p.unionByName(m)


def growth_breakdowns(silver: DataFrame) -> DataFrame:
    """Every silver row (both models) with cac, labels and the caveat."""
    return silver.select(
        "fact_date", "attribution_model", "media_source", "campaign", "adset", "ad",
        "installs", "spend", "af_start_trial", "af_subscribe", "rc_trial_converted_event",
        "af_tutorial_completion", "arpu_ltv", "currency", "timezone", "fetched_at",
        F.when(_z("af_subscribe") > 0, _z("spend") / F.col("af_subscribe")).alias("cac"),
        F.lit(K.SRC_MCP).alias("primary_source"),
        F.lit(K.CONF_EXPERIMENTAL).alias("source_confidence"),
        F.lit(K.BREAKDOWN_CAVEAT).alias("caveat"),
    )
