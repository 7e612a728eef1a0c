"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the supplied tables through the adapters, so its work grows
with them. Oracle SQL for the same names lives in ``marketlake.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake import constants as K
from marketlake.operators import gold, silver
from marketlake.session import apply_job_conf
from marketlake.sources.adapters import Inputs

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def _with_job_conf(fn: QueryFn) -> QueryFn:
    """Queries run with the job settings (AQE etc.) on whatever session they are given."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_job_conf(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def query(name: str):
    def deco(fn):
        QUERIES[name] = _with_job_conf(fn)
        return fn
    return deco


class Model:
    """The silver/gold frames of one input set, built lazily and shared."""

    def __init__(self, spark: SparkSession, sf_dir: str, tz: str = K.DEFAULT_BUSINESS_TZ, by_key: bool = False):
        self.inp = Inputs(spark, sf_dir)
        self.tz = tz
        self.by_key = by_key

    @property
    def pull(self) -> DataFrame:
        return self.inp.pull

    @property
    def mcp(self) -> DataFrame:
        return self.inp.mcp_by_key if self.by_key else self.inp.mcp

    @property
    def silver(self) -> DataFrame:
        return silver.marketing_fact_daily(self.mcp, self.tz)

    @property
    def ad_map(self) -> DataFrame:
        return silver.adset_ad_map(self.inp.ad_map_rows)

    @property
    def silver_ad(self) -> DataFrame:
        return silver.marketing_fact_ad(self.mcp, self.ad_map, self.tz)

    @property
    def daily_totals(self) -> DataFrame:
        return gold.daily_totals(self.pull, self.silver, K.MODEL_LTV, self.tz)


# --- silver -----------------------------------------------------------------

@query("marketing_fact_daily")
def q_marketing_fact_daily(spark, sf_dir):
    return Model(spark, sf_dir).silver


@query("marketing_fact_ad")
def q_marketing_fact_ad(spark, sf_dir):
    return Model(spark, sf_dir).silver_ad


@query("map_upsert")
def q_map_upsert(spark, sf_dir):
    return Model(spark, sf_dir).ad_map


@query("canonical_adset_rows")
def q_canonical_adset_rows(spark, sf_dir):
    return silver.canonical_source_rows(Inputs(spark, sf_dir).mcp, silver.ADSET_GRAIN_DIMS, ad_grain=False)


@query("canonical_ad_rows")
def q_canonical_ad_rows(spark, sf_dir):
    return silver.canonical_source_rows(Inputs(spark, sf_dir).mcp, silver.AD_GRAIN_DIMS, ad_grain=True)


# --- gold -------------------------------------------------------------------

def _stored(spark, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: what is built from it twice is not computed twice."""
    path = _scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@query("growth_daily_totals")
def q_growth_daily_totals(spark, sf_dir):
    return Model(spark, sf_dir).daily_totals


@query("activity_daily_totals")
def q_activity_daily_totals(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.daily_totals(m.pull, m.silver, K.MODEL_ACTIVITY, m.tz)


@query("growth_weekly_totals")
def q_growth_weekly_totals(spark, sf_dir):
    return gold.weekly_totals(Model(spark, sf_dir).daily_totals)


@query("growth_campaign_daily")
def q_growth_campaign_daily(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.campaign_daily(m.pull, m.tz)


@query("growth_adset_daily")
def q_growth_adset_daily(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.scaled_daily(m.pull, m.silver, gold.ADSET, K.MODEL_LTV, m.tz)


@query("activity_campaign_daily")
def q_activity_campaign_daily(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.scaled_daily(m.pull, m.silver, gold.CAMPAIGN, K.MODEL_ACTIVITY, m.tz)


@query("activity_adset_daily")
def q_activity_adset_daily(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.scaled_daily(m.pull, m.silver, gold.ADSET, K.MODEL_ACTIVITY, m.tz)


@query("growth_ad_daily")
def q_growth_ad_daily(spark, sf_dir):
    m = Model(spark, sf_dir, by_key=True)
    return gold.scaled_ad_daily(m.pull, _stored(spark, m.silver_ad, "growth-silver-ad"), None, K.MODEL_LTV, m.tz)


@query("activity_ad_daily")
def q_activity_ad_daily(spark, sf_dir):
    m = Model(spark, sf_dir, by_key=True)
    return gold.scaled_ad_daily(m.pull, _stored(spark, m.silver_ad, "activity-silver-ad"), None, K.MODEL_ACTIVITY, m.tz)


@query("growth_fact_rows")
def q_growth_fact_rows(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.growth_fact_rows(m.pull, m.silver, m.tz)


@query("growth_breakdowns")
def q_growth_breakdowns(spark, sf_dir):
    return gold.growth_breakdowns(Model(spark, sf_dir).silver)


# --- parameters of the registered checks (whole tables; windows span all data) ---

import datetime as _dt  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from marketlake.functions import (  # noqa: E402
    dim_normalize, is_utc_like, lenient_float_pull, utc_to_business_date,
)
from marketlake.functions.kpi import attribution_model_of, base_kpi_of, is_ad_grain  # noqa: E402
from marketlake.operators import marts, pull as pull_ops, quality, reports, upserts  # noqa: E402

ALL_FROM, ALL_TO = _dt.date(1990, 1, 1), _dt.date(2030, 12, 31)
AS_OF = _dt.date(2001, 8, 2)
LOOKBACK_DAYS = 14
REPLACE_FROM, REPLACE_TO = _dt.date(1996, 1, 1), _dt.date(1996, 3, 31)
LATER_FETCH = "2026-03-01T00:00:00+00:00"
PARITY_DAY = _dt.date(1996, 1, 10)
TOP_N = 10


class Warehouse:
    """Warehouse-path frames (raw -> staging -> intermediate -> marts)."""

    def __init__(self, spark, sf_dir):
        self.inp = Inputs(spark, sf_dir)

    @property
    def stg_perf(self):
        return marts.stage_performance(self.inp.raw_perf)

    @property
    def stg_events(self):
        return marts.stage_events(self.inp.raw_events)

    @property
    def perf_metrics(self):
        return marts.daily_performance_metrics(self.stg_perf)

    @property
    def event_metrics(self):
        return marts.daily_event_metrics(self.stg_events)

    @property
    def daily(self):
        return marts.daily_acquisition(self.perf_metrics, marts.event_pivot(self.event_metrics))


@query("stage_performance")
def q_stage_performance(spark, sf_dir):
    return Warehouse(spark, sf_dir).stg_perf


@query("stage_events")
def q_stage_events(spark, sf_dir):
    return Warehouse(spark, sf_dir).stg_events


@query("daily_event_metrics")
def q_daily_event_metrics(spark, sf_dir):
    return Warehouse(spark, sf_dir).event_metrics


@query("daily_performance_metrics")
def q_daily_performance_metrics(spark, sf_dir):
    return Warehouse(spark, sf_dir).perf_metrics


@query("event_pivot")
def q_event_pivot(spark, sf_dir):
    return marts.event_pivot(Warehouse(spark, sf_dir).event_metrics)


@query("daily_acquisition")
def q_daily_acquisition(spark, sf_dir):
    return Warehouse(spark, sf_dir).daily


@query("weekly_acquisition")
def q_weekly_acquisition(spark, sf_dir):
    return marts.weekly_acquisition(Warehouse(spark, sf_dir).daily)


@query("monthly_acquisition")
def q_monthly_acquisition(spark, sf_dir):
    return marts.monthly_acquisition(Warehouse(spark, sf_dir).daily)


@query("validate_volume")
def q_validate_volume(spark, sf_dir):
    return quality.validate_volume(Warehouse(spark, sf_dir).daily)


@query("validate_duplicate_keys")
def q_validate_duplicate_keys(spark, sf_dir):
    daily = Warehouse(spark, sf_dir).daily
    # every seventh day's rows stand twice, as after a double load
    twice = F.when(F.dayofmonth("report_date") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return quality.validate_duplicate_keys(daily.withColumn("copy", F.explode(twice)))


@query("validate_null_rates")
def q_validate_null_rates(spark, sf_dir):
    return quality.validate_null_rates(Warehouse(spark, sf_dir).daily)


@query("null_rate_spikes")
def q_null_rate_spikes(spark, sf_dir):
    daily = Warehouse(spark, sf_dir).daily
    # on every 45th day a part of the rows comes without campaign and country, as after a broken feed
    broken = (F.unix_date("report_date") % 45 == 0) & (F.length("media_source") > 0) & F.col("app_key").isNotNull()
    feed = daily.select("report_date", "media_source", *[F.when(~F.coalesce(broken, F.lit(False)), F.col(c)).alias(c) for c in ("campaign", "country")])
    return quality.null_rate_spikes(quality.validate_null_rates(feed))


@query("validate_top_campaigns")
def q_validate_top_campaigns(spark, sf_dir):
    return quality.validate_top_campaigns(Warehouse(spark, sf_dir).daily)


@query("validate_reconcile")
def q_validate_reconcile(spark, sf_dir):
    m = Model(spark, sf_dir)
    return quality.validate_reconcile(gold.mcp_day(m.silver), gold.pull_day(m.pull, m.tz))


# --- reports ------------------------------------------------------------------

@query("report_summary")
def q_report_summary(spark, sf_dir):
    return reports.report_summary(Model(spark, sf_dir).silver, ALL_FROM, ALL_TO)


@query("report_daily_cac")
def q_report_daily_cac(spark, sf_dir):
    return reports.report_daily_cac(Model(spark, sf_dir).silver, ALL_FROM, ALL_TO)


@query("report_weekly_cac")
def q_report_weekly_cac(spark, sf_dir):
    return reports.report_weekly_cac(Model(spark, sf_dir).silver, ALL_FROM, ALL_TO)


def _top(entity):
    def fn(spark, sf_dir):
        m = Model(spark, sf_dir)
        return reports.top_entities(m.silver_ad if entity == "ad" else m.silver, ALL_FROM, ALL_TO, entity, TOP_N)
    return fn


for _name, _entity in (("top_media", "media_source"), ("top_campaigns", "campaign"),
                       ("top_adsets", "adset"), ("top_ads", "ad")):
    QUERIES[_name] = _with_job_conf(_top(_entity))


@query("growth_totals_summary")
def q_growth_totals_summary(spark, sf_dir):
    return reports.growth_totals_summary(Model(spark, sf_dir).daily_totals, ALL_FROM, ALL_TO)


@query("freshness")
def q_freshness(spark, sf_dir):
    return reports.freshness(Model(spark, sf_dir).daily_totals, AS_OF)


@query("lookback_window")
def q_lookback_window(spark, sf_dir):
    from marketlake.functions import lookback_bounds
    lo, hi = lookback_bounds(AS_OF, LOOKBACK_DAYS)
    return Model(spark, sf_dir).daily_totals.filter(F.col("fact_date").between(F.lit(lo), F.lit(hi)))


# --- write side ---------------------------------------------------------------

@query("pull_dedupe")
def q_pull_dedupe(spark, sf_dir):
    return pull_ops.pull_dedupe(Inputs(spark, sf_dir).pull_refetch)


@query("cost_preserving_replace")
def q_cost_preserving_replace(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return pull_ops.cost_preserving_replace(inp.pull, inp.pull_new, REPLACE_FROM, REPLACE_TO)


@query("dates_with_cost")
def q_dates_with_cost(spark, sf_dir):
    return pull_ops.dates_with_cost(Inputs(spark, sf_dir).pull)


def _reattr_fetch(pull):
    reattr = K.DEFAULT_REPORT_SEGMENT + K.REATTR_SEGMENT_SUFFIX
    rows = pull.filter((F.col("report_segment") == reattr)
                       & F.col("fact_date").between(F.lit(REPLACE_FROM), F.lit(REPLACE_TO)))
    return pull_ops.retarget_rewrite(rows).withColumn("fetched_at", F.lit(LATER_FETCH))


@query("retarget_rewrite")
def q_retarget_rewrite(spark, sf_dir):
    reattr = K.DEFAULT_REPORT_SEGMENT + K.REATTR_SEGMENT_SUFFIX
    rows = Inputs(spark, sf_dir).pull.filter(F.col("report_segment") == reattr)
    kind = F.floor(F.col("ingest_seq") / 10) % 4
    rows = rows.withColumn("conversion_type", F.when(kind == 0, F.lit(" re-engagement ")).when(kind == 2, F.lit("N/A"))
                           .when(kind == 3, F.lit("x y")))
    return pull_ops.retarget_rewrite(rows, "conversion_type").withColumn("fetched_at", F.lit(LATER_FETCH))


@query("reattr_replace")
def q_reattr_replace(spark, sf_dir):
    p = Inputs(spark, sf_dir).pull
    return pull_ops.reattr_replace(p, _reattr_fetch(p), REPLACE_FROM, REPLACE_TO)


@query("backfill_pull_dims")
def q_backfill_pull_dims(spark, sf_dir):
    from marketlake.functions import nullify_blank
    p = Inputs(spark, sf_dir).pull
    legacy = p.select(*[nullify_blank(c).alias(c) if c in pull_ops.PULL_DIMS else F.col(c) for c in p.columns])
    return pull_ops.backfill_pull_dims(legacy)


def _odd_day():
    return F.dayofmonth("fact_date") % 2 == 1


@query("source_upsert")
def q_source_upsert(spark, sf_dir):
    mcp = Inputs(spark, sf_dir).mcp_by_key.withColumn("ingest_seq", F.lit(1))
    later = (mcp.filter(_odd_day()).withColumn("metric_value", F.col("metric_value") + 1)
             .withColumn("fetched_at", F.concat("fetched_at", F.lit("-refetch"))).withColumn("ingest_seq", F.lit(2)))
    return upserts.source_upsert(mcp, later)


@query("coalesce_upsert")
def q_coalesce_upsert(spark, sf_dir):
    s = Model(spark, sf_dir).silver
    later = (s.filter(_odd_day()).withColumn("spend", F.col("spend") + 1)
             .withColumn("arpu_ltv", F.lit(None).cast("double")).withColumn("fetched_at", F.lit(LATER_FETCH)))
    return upserts.coalesce_upsert(s, later)


@query("silver_window_rebuild")
def q_silver_window_rebuild(spark, sf_dir):
    m = Model(spark, sf_dir)
    rebuilt = silver.marketing_fact_daily(m.inp.mcp.filter(_odd_day()), m.tz, REPLACE_FROM, REPLACE_TO)
    return silver.silver_window_rebuild(m.silver, rebuilt, REPLACE_FROM, REPLACE_TO, K.SRC_MCP)


@query("backfill_attribution_model")
def q_backfill_attribution_model(spark, sf_dir):
    s = Model(spark, sf_dir).silver
    legacy = s.withColumn("ingest_seq", F.when(F.col("attribution_model") == K.MODEL_LTV, 0).otherwise(1)) \
        .drop("attribution_model")
    return silver.backfill_attribution_model(legacy).drop("ingest_seq")


@query("grain_fallback")
def q_grain_fallback(spark, sf_dir):
    mcp = Inputs(spark, sf_dir).mcp
    rank = (F.when(F.col("ad").isNotNull(), 3).when(F.col("adset").isNotNull(), 0)
            .when(F.col("campaign").isNotNull(), 1).otherwise(2))
    return silver.grain_fallback(mcp.withColumn("grain_rank", rank))


def _parity_right(s):
    return (s.filter(F.coalesce(F.col("media_source"), F.lit("")) != "ms_1")
            .withColumn("spend", F.when(F.col("fact_date") == F.lit(PARITY_DAY), F.col("spend") + 1)
                        .otherwise(F.col("spend"))))


PARITY_KEYS_MODEL = (*quality.PARITY_KEYS, "attribution_model")


@query("export_parity_six_keys")
def q_export_parity_six_keys(spark, sf_dir):
    s = Model(spark, sf_dir).silver
    return quality.export_parity(s, _parity_right(s))


@query("export_parity_samples")
def q_export_parity_samples(spark, sf_dir):
    s = _stored(spark, Model(spark, sf_dir, by_key=True).silver, "parity-silver")  # each sample compares it with itself
    kinds = ("only_left", "only_right", "mismatch")
    parts = [quality.parity_samples(s, _parity_right(s), kind).select(F.lit(kind).alias("kind"), "*") for kind in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("export_parity_tree")
def q_export_parity_tree(spark, sf_dir):
    """Both sides lie in files sorted by date, so the filter on unequal dates skips row groups."""
    s = Model(spark, sf_dir).silver

    def stored(df, name):
        path = _scratch(spark, name)
        df.repartitionByRange("fact_date").sortWithinPartitions("fact_date").write.parquet(path)
        return spark.read.parquet(path)

    left = stored(s, "parity-left")
    return quality.export_parity_tree(left, stored(_parity_right(left), "parity-right"), keys=PARITY_KEYS_MODEL)


@query("export_parity")
def q_export_parity(spark, sf_dir):
    s = Model(spark, sf_dir).silver
    return quality.export_parity(s, _parity_right(s), keys=PARITY_KEYS_MODEL)


# --- column-level operators over whole tables --------------------------------

@query("kpi_attribution")
def q_kpi_attribution(spark, sf_dir):
    mcp = Inputs(spark, sf_dir).mcp
    return mcp.groupBy(
        "kpi_name", attribution_model_of("kpi_name").alias("attribution_model"),
        base_kpi_of("kpi_name").alias("base_kpi"),
        F.when(is_ad_grain("kpi_name"), F.lit("ad")).otherwise(F.lit("adset")).alias("grain"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


@query("kpi_grain_split")
def q_kpi_grain_split(spark, sf_dir):
    grain = F.when(is_ad_grain("kpi_name"), F.lit("ad")).otherwise(F.lit("adset")).alias("grain")
    return Inputs(spark, sf_dir).mcp.groupBy("fact_date", grain).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("metric_value").alias("metric_value"))


@query("dim_normalize")
def q_dim_normalize(spark, sf_dir):
    stg = Warehouse(spark, sf_dir).stg_perf
    return stg.select("report_date", *[dim_normalize(c).alias(c) for c in ("media_source", "campaign", "platform")])


@query("lenient_float_pull")
def q_lenient_float_pull(spark, sf_dir):
    raw = Inputs(spark, sf_dir).raw_perf
    txt = F.get_json_object("_payload", "$.clicks")
    return raw.select("_extract_date", txt.alias("clicks_text"), lenient_float_pull(txt).alias("clicks"))


@query("utc_to_business_date")
def q_utc_to_business_date(spark, sf_dir):
    mcp = Inputs(spark, sf_dir).mcp
    return mcp.groupBy("fact_date").agg(F.count(F.lit(1)).alias("row_count")).select(
        "fact_date", utc_to_business_date("fact_date", K.DEFAULT_BUSINESS_TZ).alias("business_date"), "row_count")


@query("is_utc_like")
def q_is_utc_like(spark, sf_dir):
    p = Inputs(spark, sf_dir).pull
    return p.groupBy("timezone").agg(F.count(F.lit(1)).alias("row_count")).select(
        "timezone", is_utc_like("timezone").alias("utc_like"), "row_count")


# --- files, exports, stream: data Spark derives from the tables, landed in the
# --- session's shared checkpoint folder, then read back by the real scan -------

import uuid as _uuid  # noqa: E402

from marketlake.session import scratch_path  # noqa: E402
from marketlake.sources import export, mcp_text, pull_csv, raw_json  # noqa: E402


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{_uuid.uuid4().hex}")


def _raw_rows(inp):
    perf = inp.raw_perf.select(F.lit(K.REPORT_PERFORMANCE).alias("report_name"), "_extract_date", "_payload")
    ev = inp.raw_events.select(F.lit(K.REPORT_EVENTS).alias("report_name"), "_extract_date", "_payload")
    return perf.unionByName(ev)


TEXT_CODEC = "gzip"  # of landed lines: every row repeats the names of its fields


def land_raw(spark, sf_dir) -> str:
    """Land both raw reports as line-delimited JSON under <root>/report_name=<r>/dt=<d>/.

    Files are rebalanced on report and day: AQE splits a hot day over several writers and
    joins small days into one, so the number of files follows the data."""
    root = _scratch(spark, "landing")
    (_raw_rows(Inputs(spark, sf_dir))
     .select("report_name", F.date_format("_extract_date", "yyyy-MM-dd").alias("dt"), F.col("_payload").alias("value"))
     .hint("rebalance", "report_name", "dt")
     .write.option("compression", TEXT_CODEC).partitionBy("report_name", "dt").text(root))
    return root


DOCUMENT_ROWS = 20_000  # rows of a landed file, about: files follow days, not rows
LARGE_BODY = 8_000  # bytes beyond which the scan cuts a document


def _shares(rows, size: int):
    """``rows`` with ``share``: those of a report's day are dealt by hash to as few shares of about ``size`` rows as hold them."""
    day = ["report_name", "dt"]
    counts = rows.groupBy(*day).agg(F.ceil(F.count(F.lit(1)) / size).alias("shares"))  # a row for each day
    numbered = rows.withColumn("share", F.xxhash64(F.monotonically_increasing_id()))
    same_day = numbered["report_name"].eqNullSafe(counts["report_name"]) & numbered["dt"].eqNullSafe(counts["dt"])
    return numbered.join(F.broadcast(counts), same_day).select(
        *[numbered[c] for c in rows.columns], F.pmod("share", "shares").alias("share"))


def land_documents(spark, sf_dir, codec: str = "none") -> tuple[str, str]:
    """Land both raw reports in all their bodies: folders of documents and of line-delimited files.

    Every third day of a month lies in line-delimited files; of the others, odd ones as JSON lists and
    even ones as ``{"rows": [...]}``, a file for about ``DOCUMENT_ROWS`` rows. ``codec``: of the files; a compressed
    document can't be cut by many tasks."""
    rows = _raw_rows(Inputs(spark, sf_dir)).withColumn("dt", F.date_format("_extract_date", "yyyy-MM-dd"))
    day = F.dayofmonth("_extract_date")
    lines, documents = _scratch(spark, "landing"), _scratch(spark, "documents")
    file = ("report_name", "dt", "share")
    (_shares(rows.where(day % 3 == 0), DOCUMENT_ROWS).repartition(*file).select("report_name", "dt", F.col("_payload").alias("value"))
     .write.option("compression", codec).partitionBy("report_name", "dt").text(lines))
    listed = F.concat(F.lit("["), F.array_join(F.collect_list("_payload"), ",\n"), F.lit("]"))
    body = _shares(rows.where(day % 3 != 0), DOCUMENT_ROWS).groupBy(*file).agg(
        listed.alias("value"), F.first(day % 2 == 1).alias("odd"))
    (body.select("report_name", "dt", F.when(F.col("odd"), F.col("value")).otherwise(
        F.concat(F.lit('{"meta": {"rows": [0]}, "rows": '), "value", F.lit("}"))).alias("value"))
     .write.option("compression", codec).option("maxRecordsPerFile", 1).partitionBy("report_name", "dt").text(documents))
    return lines, documents


_LANDED: dict[tuple[str, ...], tuple[str, str]] = {}


def _landed(spark, sf_dir, *codec: str) -> tuple[str, str]:
    key = (spark.sparkContext.applicationId, sf_dir, *codec)
    if key not in _LANDED:
        _LANDED[key] = land_documents(spark, sf_dir, *codec)
    return _LANDED[key]


def _scan_landing(spark, sf_dir):
    """Scan of all bodies; the queries of one session share a landing (thousands of folders, a file each)."""
    lines, documents = _landed(spark, sf_dir)
    return raw_json.raw_report_scan(spark, f"{lines}/*/dt=*/*.txt", body="lines").unionByName(
        raw_json.raw_report_scan(spark, f"{documents}/*/dt=*/*.txt", body="document", large_body=LARGE_BODY))


@query("raw_report_scan")
def q_raw_report_scan(spark, sf_dir):
    return _scan_landing(spark, sf_dir).select("_report_name", "_extract_date", "_payload")


@query("raw_lineage")
def q_raw_lineage(spark, sf_dir):
    return raw_json.with_lineage(_scan_landing(spark, sf_dir)).select("_report_name", "_extract_date", "_row_hash")


@query("batch_ledger")
def q_batch_ledger(spark, sf_dir):
    led = raw_json.batch_ledger(_scan_landing(spark, sf_dir))
    return led.groupBy("report_name", "extract_date", "status").agg(F.sum("row_count").alias("row_count"))


@query("raw_report_stream")
def q_raw_report_stream(spark, sf_dir):
    from marketlake.streaming import raw_stream
    root = land_raw(spark, sf_dir)
    sink, ck = _scratch(spark, "stream-sink"), _scratch(spark, "stream-ckpt")
    raw_stream.land_raw_reports(spark, root, sink, ck, body="lines", partition_by=("_report_name",)).awaitTermination()
    return spark.read.parquet(sink).select("_report_name", "_extract_date", "_payload")


STREAM_FILES = 2000  # files of an epoch


@query("raw_stream_ledger")
def q_raw_stream_ledger(spark, sf_dir):
    """One run over each landing, every epoch handled twice as after a failure: ledger rows, and the daily
    cost that the epochs recompute for the dates they touch (the last recompute of a date counts)."""
    from marketlake.streaming import raw_stream
    store = _scratch(spark, "stream-store")
    runs = iter(range(1, 1 << 30))

    def recompute(dates, epoch_id):
        raw = raw_stream.stored(spark, store, "raw").where(F.col("_report_name") == K.REPORT_PERFORMANCE)
        touched = raw.join(dates.withColumnRenamed("fact_date", "_extract_date"), "_extract_date", "left_semi")
        cost = marts.stage_performance(touched).groupBy("report_date").agg(F.sum(F.coalesce("cost", F.lit(0.0))).alias("cost"))
        cost.write.parquet(f"{store}/cost/run={next(runs)}")

    for source, root in zip(("lines", "document"), _landed(spark, sf_dir, TEXT_CODEC)):  # a stream reads documents whole
        once = raw_stream.ledger_handler(spark, store, source, recompute)

        def twice(batch, epoch_id, once=once):
            once(batch, epoch_id)
            once(batch, epoch_id)

        (raw_stream.raw_report_stream(spark, root, max_files_per_trigger=STREAM_FILES, body=source).writeStream
         .foreachBatch(twice).option("checkpointLocation", _scratch(spark, "stream-ckpt")).trigger(availableNow=True)
         .start().awaitTermination())
    last = spark.read.parquet(f"{store}/cost").groupBy("report_date").agg(F.max_by("cost", "run").alias("cost")).select(
        F.lit(K.REPORT_PERFORMANCE).alias("report_name"), F.col("report_date").alias("extract_date"), "cost")
    ledger = raw_stream.stored(spark, store, "ledger").groupBy("report_name", "extract_date").agg(F.sum("row_count").alias("row_count"))
    return ledger.join(last, ["report_name", "extract_date"], "left")


PULL_CSV_HEADERS = (
    ("fact_date", "Date"), ("media_source", "Media Source (pid)"), ("campaign", "Campaign (c)"),
    ("adset", "Adset"), ("ad", "Ad"), ("installs", "Installs"), ("clicks", "Clicks"),
    ("impressions", "Impressions"), ("cost", "Total Cost"), ("revenue", "Total Revenue"),
    ("af_start_trial", "af_start_trial (Unique users)"), ("af_subscribe", "af_subscribe (Unique users)"),
    ("rc_trial_converted_event", "rc_trial_converted_event (Unique users)"),
    ("af_tutorial_completion", "af_tutorial_completion (Unique users)"),
    ("af_subscribe", "af_subscribe (Event counter)"),
)


@query("pull_csv_scan")
def q_pull_csv_scan(spark, sf_dir):
    # two vendor layouts (the reattribution report has no clicks and calls installs conversions),
    # in a folder with a space, with quotes and line ends inside a field
    p = Inputs(spark, sf_dir).pull.withColumn("campaign", F.concat("campaign", F.lit(' "q", x\ny')))
    reattr = F.col("report_segment") == K.DEFAULT_REPORT_SEGMENT + K.REATTR_SEGMENT_SUFFIX
    layouts = ((~reattr, PULL_CSV_HEADERS),
               (reattr, tuple((c, "Conversions" if c == "installs" else h) for c, h in PULL_CSV_HEADERS[::-1] if c != "clicks")))
    paths = []
    for i, (rows, headers) in enumerate(layouts):
        root = _scratch(spark, f"pull csv {i}")
        (p.filter(rows).select(*[F.col(c).cast("string").alias(h) for c, h in headers])
         .write.option("header", True).option("escape", '"').csv(root))
        paths += [f"{root}/{f}" for f in _list_files(spark, root, ".csv")]
    out = pull_csv.pull_csv_scan(spark, paths, fetched_at="2026-01-01T00:00:00+00:00")
    return out.drop("source_payload", "fetched_at")


HEADER_SAMPLES = ("Date", "Media Source (pid)", "Conversions", "Total Cost", "af_subscribe (Unique users)",
                  "af_subscribe (Event counter)", "Adset", "Other")


@query("pull_header_map")
def q_pull_header_map(spark, sf_dir):
    """P3 over a column of headers, in mixed case and with white space around."""
    p = Inputs(spark, sf_dir).pull.select("ingest_seq", F.explode(F.array(*map(F.lit, HEADER_SAMPLES))).alias("h"))
    header = F.when(F.col("ingest_seq") % 2 == 0, F.concat("h", F.lit(" "))).otherwise(F.upper("h"))
    return p.groupBy(header.alias("header")).agg(F.count(F.lit(1)).alias("row_count")).select(
        "header", pull_csv.header_field(F.col("header")).alias("field"), "row_count")


def _list_files(spark, root: str, suffix: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(path) if st.getPath().getName().endswith(suffix))


LONG_RESPONSE, PIECE_LINES = 20_000, 40  # characters of a response beyond which it is cut, lines of a piece
PAD_COLUMNS = 70  # text columns before the metrics: responses are wide


def _responses(mcp):
    """Responses of many lines: the rows of one KPI, window and hundred orders. They begin on a
    new line and hold quotes, commas and line ends inside fields."""
    def txt(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    pads = ["Pad %d" % i for i in range(PAD_COLUMNS)]
    head = ",".join(["Date", "Media source", "Campaign", "Adset", "Ad", *pads, "Unique users", "Cost", "Installs"])
    campaign = F.concat(F.lit('"'), F.col("campaign"), F.lit(' ""q"", x\ny"'))
    line = F.concat_ws(",", txt("fact_date"), txt("media_source"), campaign, txt("adset"), txt("ad"),
                       F.lit(",".join("x" for _ in pads)), txt("metric_value"), txt("cost"), txt("installs"))
    lines = mcp.groupBy("kpi_name", "fetch_window_from", "fetch_window_to", F.substring("fetched_at", 1, 18).alias("hundred")).agg(
        F.max("fetched_at").alias("fetched_at"), F.array_join(F.collect_list(line), "\n").alias("lines"))
    text = F.concat(F.lit(f"Result for the request. ## Data:\n{head}\n"), "lines",
                    F.lit('\n; ## Metadata: {"timezone": "UTC", "currency": "USD"}'))
    return lines.select("kpi_name", "fetch_window_from", "fetch_window_to", "fetched_at", text.alias("response_text"))


def _stored_responses(spark, sf_dir):
    """Written once: the scan reads them for their lengths, then for their rows."""
    return _stored(spark, _responses(Inputs(spark, sf_dir).mcp), "responses")


@query("mcp_response_scan")
def q_mcp_response_scan(spark, sf_dir):
    return mcp_text.mcp_response_scan(_stored_responses(spark, sf_dir), long=LONG_RESPONSE, piece_lines=PIECE_LINES, raw_rows=False).drop("raw_metadata_json")


@query("metric_column_identify")
def q_metric_column_identify(spark, sf_dir):
    out = mcp_text.mcp_response_scan(_stored_responses(spark, sf_dir), long=LONG_RESPONSE, piece_lines=PIECE_LINES, raw_rows=False)
    return out.groupBy("kpi_name", "metric_column").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("metric_value").alias("metric_value"),
        F.sum("installs").alias("installs"), F.sum("cost").alias("cost"))


def _bronze_with_period(mcp):
    period = (F.when(F.col("kpi_name") == K.KPI_ARPU, F.lit(K.MODEL_LTV))
              .when(F.col("kpi_name").endswith(K.KPI_ACTIVITY_SUFFIX), F.lit(K.MODEL_ACTIVITY)).otherwise(F.lit("")))
    return mcp.withColumn("period", period).withColumn(
        "raw_row_json", F.to_json(F.struct("media_source", "campaign", "metric_value")))


@query("raw_export")
def q_raw_export(spark, sf_dir):
    root = _scratch(spark, "raw-export")
    rows = export.raw_export_rows(_bronze_with_period(Inputs(spark, sf_dir).mcp))
    export.write_raw_export(rows, root, compression=TEXT_CODEC)
    back = raw_json.raw_report_scan(spark, f"{root}/*/dt=*/*.txt*", body="lines")
    # parsed once a row
    p = F.from_json("_payload", "_request_context struct<kpi_name: string>, row struct<media_source: string, metric_value: string>")
    return back.select("_report_name", "_extract_date", p.alias("p")).select(
        "_report_name", "_extract_date", F.col("p._request_context.kpi_name").alias("kpi_name"),
        F.col("p.row.media_source").alias("media_source"), F.col("p.row.metric_value").cast("double").alias("metric_value"))


@query("fact_export")
def q_fact_export(spark, sf_dir):
    return export.fact_export_rows(Model(spark, sf_dir).silver)


@query("export_summary")
def q_export_summary(spark, sf_dir):
    m = Model(spark, sf_dir)
    return export.export_summary(export.raw_export_rows(_bronze_with_period(m.inp.mcp)),
                                 export.fact_export_rows(m.silver))


@query("gold_refresh")
def q_gold_refresh(spark, sf_dir):
    """Silver is written once; the eleven datasets read it, and each answers with its sums."""
    from marketlake.plans import gold_refresh
    m = Model(spark, sf_dir)

    def stored(df, name):
        path = _scratch(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    out = gold_refresh.gold_datasets(m.pull, stored(m.silver, "gold-silver"), stored(m.silver_ad, "gold-silver-ad"), None, m.tz)
    res = None
    for n, df in out.items():
        tutorials = F.sum("af_tutorial_completion") if "af_tutorial_completion" in df.columns else F.lit(0.0)
        part = df.agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum("spend"), 2).alias("spend"),
                      F.round(F.sum("installs"), 2).alias("installs"), tutorials.alias("tutorials"))
        part = part.select(F.lit(n).alias("dataset"), "*")
        res = part if res is None else res.unionByName(part)
    return res


# --- joins and day sums as their own operators ------------------------------------

@query("source_priority_join")
def q_source_priority_join(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.source_priority(m.pull, m.silver, K.MODEL_LTV, m.tz).select(
        "fact_date", "pull_spend", "own_spend", F.col("pull_present").isNotNull().alias("pull_present"), "takes_pull")


@query("pull_day")
def q_pull_day(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.pull_day(m.pull, m.tz)


@query("mcp_day")
def q_mcp_day(spark, sf_dir):
    return gold.mcp_day(Model(spark, sf_dir).silver, K.MODEL_LTV)


@query("scale_join")
def q_scale_join(spark, sf_dir):
    m = Model(spark, sf_dir)
    detail = gold._detail_from_daily(m.silver, gold.ADSET, K.MODEL_LTV)
    return gold.scale_join(detail, gold.pull_media_source_day(m.pull, m.tz)).select(
        "fact_date", "media_source", "campaign", "adset", "spend", "own_spend", "pull_spend",
        "installs", "own_installs", "pull_installs")


@query("adset_resolve")
def q_adset_resolve(spark, sf_dir):
    m = Model(spark, sf_dir)
    return gold.adset_resolve(m.silver_ad, m.ad_map, K.MODEL_LTV).select(
        "fact_date", "media_source", "campaign", "adset", "ad", "spend", "installs")


@query("ad_perf_join")
def q_ad_perf_join(spark, sf_dir):
    ev, perf = silver._ad_parts(Inputs(spark, sf_dir).mcp, None, None)
    return silver.ad_perf_join(ev, perf).select("fact_date", "media_source", "campaign", "ad", "attribution_model",
                                                "installs", "spend", "currency")


@query("ad_map_lookup")
def q_ad_map_lookup(spark, sf_dir):
    m = Model(spark, sf_dir)
    ev, _ = silver._ad_parts(m.inp.mcp, None, None)
    return silver.ad_map_lookup(ev, m.ad_map).select("fact_date", "media_source", "campaign", "ad",
                                                     "attribution_model", "adset")


@query("mart_full_outer")
def q_mart_full_outer(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    d = w.daily
    return d.select("report_date", "app_key", "platform", "media_source", "campaign", "campaign_id", "adset",
                    "adset_id", "ad", "ad_id", "country", "cost", "af_start_trial")


@query("fact_date_fallback")
def q_fact_date_fallback(spark, sf_dir):
    from marketlake.functions import fact_date_fallback
    mcp = Inputs(spark, sf_dir).mcp
    # the row date is blank for ad-grain KPIs here, so the window decides
    row_date = F.when(is_ad_grain("kpi_name"), F.lit("")).otherwise(F.col("fact_date").cast("string"))
    return mcp.select("kpi_name", "fetch_window_from", "fetch_window_to", "fetched_at",
                      fact_date_fallback(row_date, "fetch_window_from", "fetch_window_to").alias("fact_date"))


@query("lenient_float_mcp")
def q_lenient_float_mcp(spark, sf_dir):
    from marketlake.functions import lenient_float_mcp
    raw = Inputs(spark, sf_dir).raw_perf
    txt = F.get_json_object("_payload", "$.clicks")
    return raw.select("_extract_date", txt.alias("clicks_text"), lenient_float_mcp(txt).alias("clicks"))
