"""Adapters: the attribution-domain inputs derived from the supplied tables.

Each adapter is a narrow projection (plus one generator for the KPI fan-out) of
one supplied table, so it scales linearly with it and Catalyst prunes the scan
to the referenced columns. The same rules are written as SQL text in
``marketlake.oracle`` for the independent DuckDB check.

Inputs produced:
  pull          Pull-report daily rows (authoritative source)
  mcp           tool-response source rows, long layout, 18 KPIs per order
  ad_map        ad -> adset hierarchy rows (input of the map upsert)
  raw_perf      raw performance report rows (JSON payload)
  raw_events    raw in-app-event report rows (JSON payload)
  pull_refetch  pull plus a later re-fetch of a quarter of it (dedupe input)
  pull_new      a second fetch over stored pull (cost-preserving replace input)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.constants import DEFAULT_BUSINESS_TZ, DEFAULT_REPORT_SEGMENT, REATTR_SEGMENT_SUFFIX
from marketlake.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the adapters (KPI catalogue of the tool fetch, in order)
# ---------------------------------------------------------------------------
MCP_KPIS = (
    "af_start_trial_unique_users",
    "af_subscribe_unique_users",
    "af_tutorial_completion_unique_users",
    "rc_trial_converted_event_unique_users",
    "arpu_ltv",
    "af_start_trial_unique_users_activity",
    "af_subscribe_unique_users_activity",
    "af_tutorial_completion_unique_users_activity",
    "rc_trial_converted_event_unique_users_activity",
    "ad_performance",
    "ad_af_start_trial_unique_users",
    "ad_af_subscribe_unique_users",
    "ad_af_tutorial_completion_unique_users",
    "ad_rc_trial_converted_event_unique_users",
    "ad_af_start_trial_unique_users_activity",
    "ad_af_subscribe_unique_users_activity",
    "ad_af_tutorial_completion_unique_users_activity",
    "ad_rc_trial_converted_event_unique_users_activity",
)
AD_GRAIN_FIRST = 9  # index of the first ad-grain KPI above
ORDERS_A_TASK = 50_000  # of ``mcp_by_key``: their KPI rows are sorted in a task's memory
REFETCH_AT = "2026-01-31T00:00:00+00:00"
REFETCH_SEQ_OFFSET = 1_000_000_000
PULL_NEW_FROM = _dt.date(1996, 1, 1)
PULL_NEW_TO = _dt.date(1996, 3, 31)


def _s(c: Column) -> Column:
    return c.cast("string")


def pull_from_lineitem(lineitem: DataFrame) -> DataFrame:
    day = F.dayofmonth("l_shipdate")
    ms_mod = F.col("l_suppkey") % 5
    return lineitem.select(
        F.to_date("l_shipdate").alias("fact_date"),
        F.when(ms_mod == 0, F.lit("")).otherwise(F.concat(F.lit("ms_"), _s(ms_mod))).alias("media_source"),
        F.concat(F.lit("cmp_"), _s(F.col("l_partkey") % 7)).alias("campaign"),
        F.lit("").alias("adset"),
        F.lit("").alias("ad"),
        F.col("l_quantity").alias("installs"),
        (F.col("l_quantity") * 3).alias("clicks"),
        (F.col("l_quantity") * 100).alias("impressions"),
        F.when(day > 24, F.lit(0.0)).otherwise(F.floor("l_extendedprice").cast("double")).alias("cost"),
        F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("double").alias("revenue"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double"))
        .otherwise(F.col("l_linenumber").cast("double")).alias("af_start_trial"),
        F.when(F.col("l_returnflag") == "N", F.lit(1.0)).otherwise(F.lit(0.0)).alias("af_subscribe"),
        F.when(F.col("l_linestatus") == "F", F.lit(1.0)).otherwise(F.lit(0.0)).alias("rc_trial_converted_event"),
        (F.col("l_linenumber") % 3).cast("double").alias("af_tutorial_completion"),
        # other zones don't count in the business day: a gap on the 13th without dropping rows
        F.when((F.col("l_linenumber") == 7) | (day == 13), F.lit("UTC")).otherwise(F.lit(DEFAULT_BUSINESS_TZ)).alias("timezone"),
        F.lit(None).cast("string").alias("currency"),
        F.when(F.col("l_linenumber") == 6, F.lit(DEFAULT_REPORT_SEGMENT + REATTR_SEGMENT_SUFFIX))
        .otherwise(F.lit(DEFAULT_REPORT_SEGMENT)).alias("report_segment"),
        F.concat(F.lit("2026-01-0"), _s(F.col("l_linenumber")), F.lit("T00:00:00+00:00")).alias("fetched_at"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_seq"),
    )


def _order_dims(ok: Column, ck: Column, day: Column) -> dict[str, Column]:
    """What all KPI rows of an order share of the keys of sources and of facts."""
    ms = ck % 6
    return {
        "fetch_window_to": day,
        "media_source": F.when(ms == 0, F.lit(None).cast("string")).when(ms == 5, F.lit("ms_only_mcp"))
        .otherwise(F.concat(F.lit("ms_"), _s(ms))),
        "campaign": F.concat(F.lit("cmp_"), _s(ok % 7)),
    }


def mcp_from_orders(orders: DataFrame) -> DataFrame:
    """One source row per order and KPI: a generator (explode), not a join."""
    kpis = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(k).alias("kpi_name")) for i, k in enumerate(MCP_KPIS)])
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    n = F.col("k.n")
    d = F.to_date("o_orderdate")
    dims = _order_dims(ok, ck, d)
    return (
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                      F.explode(kpis).alias("k"))
        .select(
            F.date_sub(d, (ok % 3).cast("int")).alias("fetch_window_from"),
            dims["fetch_window_to"].alias("fetch_window_to"),
            # some ad rows without a date: ads without performance, performance without events
            F.when(~(((n == AD_GRAIN_FIRST) & (ok % 10 == 0)) | ((n > AD_GRAIN_FIRST) & (ok % 13 == 0))), d).alias("fact_date"),
            dims["media_source"].alias("media_source"),
            dims["campaign"].alias("campaign"),
            F.when(n >= AD_GRAIN_FIRST, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("as_"), _s(ok % 4))).alias("adset"),
            F.when(n >= AD_GRAIN_FIRST, F.concat(F.lit("ad_"), _s(ok % 9)))
            .otherwise(F.lit(None).cast("string")).alias("ad"),
            F.col("k.kpi_name").alias("kpi_name"),
            ((ok + n) % 11).cast("double").alias("metric_value"),
            (ck % 50).cast("double").alias("installs"),
            F.when(F.col("o_orderstatus") == "P", F.lit(0.0))
            .otherwise(F.floor(F.col("o_totalprice") / 100).cast("double")).alias("cost"),
            F.lit("UTC").alias("timezone"),
            F.lit("USD").alias("currency"),
            F.concat(F.lit("2026-02-01T"), F.lpad(_s(ok), 9, "0")).alias("fetched_at"),
        )
    )


def ad_map_from_orders(orders: DataFrame) -> DataFrame:
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    ms = ck % 6
    return orders.select(
        F.when(ms == 0, F.lit("")).when(ms == 5, F.lit("ms_only_mcp"))
        .otherwise(F.concat(F.lit("ms_"), _s(ms))).alias("media_source"),
        F.concat(F.lit("cmp_"), _s(ok % 7)).alias("campaign"),
        F.concat(F.lit("as_"), _s(ok % 4)).alias("adset"),
        # odd ads stand under a name that no fact has, so that some lookups miss
        F.concat(F.when((ok % 9) % 2 == 0, F.lit("ad_")).otherwise(F.lit("other_")), _s(ok % 9)).alias("ad"),
        (ck % 50).cast("double").alias("installs"),
        ok.alias("ingest_seq"),
    )


def _payload_dims(ok: Column, alone: Column, country: str) -> list[Column]:
    """The 11 dimension fields of both raw reports, as JSON text pieces; ``country`` marks
    rows (``alone``) whose key the other report doesn't have."""
    return [
        F.lit('{"app_id":'),
        F.when(ok % 9 == 0, F.lit("null")).otherwise(F.lit('"app_1"')),
        F.lit(',"app_name":"App One","platform":"'),
        F.when(ok % 2 == 0, F.lit("ios")).otherwise(F.lit("android")),
        F.lit('","media_source":'),
        F.when(ok % 8 == 0, F.lit("null")).otherwise(F.concat(F.lit('"ms_'), _s(ok % 5), F.lit('"'))),
        F.lit(',"campaign":"Camp '), _s(ok % 7),
        F.lit('","campaign_id":"'), _s(ok % 7),
        F.lit('","adset":"as","adset_id":"1","ad":"ad","ad_id":"2","country":"'),
        F.when(alone, F.lit(country)).when(ok % 3 == 0, F.lit("US")).otherwise(F.lit("DE")),
    ]


def raw_perf_from_lineitem(lineitem: DataFrame) -> DataFrame:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    payload = F.concat(
        *_payload_dims(ok, ln > 3, "FR"),
        F.lit('","impressions":'), _s(F.col("l_quantity").cast("int") * 100),
        F.lit(',"clicks":"'), F.when(ln == 2, F.lit("n/a")).otherwise(_s(ln)),
        F.lit('","installs":'), _s(ln % 3),
        F.lit(',"cost":'), _s(F.floor("l_extendedprice").cast("bigint")),
        F.lit("}"),
    )
    return lineitem.select(F.to_date("l_shipdate").alias("_extract_date"), payload.alias("_payload"))


def raw_events_from_lineitem(lineitem: DataFrame) -> DataFrame:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    event = (
        F.when(ln % 4 == 0, F.lit("af_start_trial")).when(ln % 4 == 1, F.lit("af_subscribe"))
        .when(ln % 4 == 2, F.lit("af_tutorial_completion")).otherwise(F.lit("rc_trial_converted_event"))
    )
    payload = F.concat(
        *_payload_dims(ok, ln < 3, "IT"),
        F.lit('","event_name":"'), event,
        F.lit('","event_count":'), _s(ln),
        F.lit(',"revenue":'), _s(F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("bigint")),
        F.lit("}"),
    )
    return lineitem.select(F.to_date("l_shipdate").alias("_extract_date"), payload.alias("_payload"))


def pull_refetch_from(pull: DataFrame) -> DataFrame:
    again = pull.filter(F.col("ingest_seq") % 4 == 0).withColumn("fetched_at", F.lit(REFETCH_AT)).withColumn(
        "ingest_seq", F.col("ingest_seq") + REFETCH_SEQ_OFFSET)
    return pull.unionByName(again)


def pull_new_from(pull: DataFrame) -> DataFrame:
    day = F.dayofmonth("fact_date")
    return pull.filter(
        F.col("fact_date").between(F.lit(PULL_NEW_FROM), F.lit(PULL_NEW_TO))
        & (day % 5 != 0)
        & (F.col("timezone") == DEFAULT_BUSINESS_TZ)
        & (F.col("report_segment") == DEFAULT_REPORT_SEGMENT)
    ).withColumn("cost", F.when(day % 2 == 0, F.lit(0.0)).otherwise(F.col("cost") + 1)).withColumn(
        "fetched_at", F.lit(REFETCH_AT)).withColumn("ingest_seq", F.col("ingest_seq") + REFETCH_SEQ_OFFSET)


class Inputs:
    """Lazily built adapter frames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def pull(self) -> DataFrame:
        return pull_from_lineitem(self.table("lineitem"))

    @property
    def mcp(self) -> DataFrame:
        return mcp_from_orders(self.table("orders"))

    @property
    def mcp_by_key(self) -> DataFrame:
        """``mcp``, dealt by the key columns that all KPI rows of an order share before they are fanned out.

        An aggregate by these keys then folds nearly all rows of a key in the task that makes them; a
        narrow order row is sent instead of its KPI rows. Pieces hold about ``ORDERS_A_TASK`` orders."""
        orders = self.table("orders")
        pieces = -(-orders.count() // ORDERS_A_TASK)
        if pieces > 1:
            dims = _order_dims(F.col("o_orderkey"), F.col("o_custkey"), F.to_date("o_orderdate"))
            orders = orders.repartition(pieces, *dims.values())
        return mcp_from_orders(orders)

    @property
    def ad_map_rows(self) -> DataFrame:
        return ad_map_from_orders(self.table("orders"))

    @property
    def raw_perf(self) -> DataFrame:
        return raw_perf_from_lineitem(self.table("lineitem"))

    @property
    def raw_events(self) -> DataFrame:
        return raw_events_from_lineitem(self.table("lineitem"))

    @property
    def pull_refetch(self) -> DataFrame:
        return pull_refetch_from(self.pull)

    @property
    def pull_new(self) -> DataFrame:
        return pull_new_from(self.pull)
