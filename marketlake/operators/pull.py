"""Pull-report write side: dedupe, cost-preserving window replace, reattribution
replace, retargeting rewrite, legacy dim backfill (W1, J8, J9, P14, M1, A27)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import constants as K
from marketlake.functions import dim_normalize
from marketlake.operators.latest import descending, keep_preferred

PULL_DIMS = ("media_source", "campaign", "adset", "ad")


def pull_dedupe(pull: DataFrame) -> DataFrame:
    """Rows equal in date, dims (NULL = ''), segment, time zone and all nine metrics
    (NULLs equal) are duplicates; keep the latest fetch (then the latest ingest). Rows
    with equal dims but different metrics stay. Dims NULL -> '' afterwards."""
    keyed = pull.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) if c in PULL_DIMS else F.col(c) for c in pull.columns])
    keys = ["fact_date", *PULL_DIMS, "report_segment", "timezone", *K.PULL_METRICS]
    keep = [c for c in pull.columns if c not in keys]
    out = keep_preferred(keyed, keys, prefer=[descending("fetched_at"), descending("ingest_seq")], keep=keep)
    return out.select(*pull.columns)


def dates_with_cost(rows: DataFrame) -> DataFrame:
    """Distinct dates having a row with cost > 0 (one row per date: small)."""
    return rows.filter((F.col("cost") > 0) & F.col("fact_date").isNotNull()).select("fact_date").distinct()


def _scope(segment: str, tz: str) -> Column:
    return (F.col("report_segment") == segment) & (F.col("timezone") == tz)


def cost_preserving_replace(stored: DataFrame, new: DataFrame, date_from: _dt.date, date_to: _dt.date,
                            segment: str = K.DEFAULT_REPORT_SEGMENT,
                            tz: str = K.DEFAULT_BUSINESS_TZ) -> DataFrame:
    """Replace stored days by a new fetch, except days whose stored rows (in the
    window, segment and zone) have cost > 0 while the new rows do not: those keep the
    stored rows and the new rows are dropped. Days absent from the new fetch stay.

    Both sides are tagged and unioned once. One aggregate gives a row per day that says
    what each side has, and one join (the days' side is small) decides every row.
    """
    cols = stored.columns
    rows = stored.select(*cols, F.lit(False).alias("_new")).unionByName(
        new.filter(F.col("fact_date").isNotNull()).select(*cols, F.lit(True).alias("_new")))
    scoped = ~F.col("_new") & F.col("fact_date").between(F.lit(date_from), F.lit(date_to)) & _scope(segment, tz)
    has = lambda c: F.coalesce(F.max(c & (F.col("cost") > 0)), F.lit(False))
    days = rows.groupBy("fact_date").agg(
        F.max("_new").alias("_fetched"), (has(scoped) & ~has(F.col("_new"))).alias("_hold"))
    known = rows.join(days, "fact_date", "left")
    hold, fetched = F.coalesce("_hold", F.lit(False)), F.coalesce("_fetched", F.lit(False))
    gone = F.coalesce(fetched & ~hold & _scope(segment, tz), F.lit(False))
    return known.filter(F.when(F.col("_new"), ~hold).otherwise(~gone)).select(*cols)


def retarget_rewrite(rows: DataFrame, conversion_type: str | Column | None = None,
                     segment: str = K.DEFAULT_REPORT_SEGMENT) -> DataFrame:
    """Retargeting rows keep installs (conversions) only; ad := normalised conversion
    type or 'retargeting'; segment gets the reattribution suffix."""
    ct = F.lit(None).cast("string") if conversion_type is None else (
        F.col(conversion_type) if isinstance(conversion_type, str) else conversion_type)
    nulls = [m for m in K.PULL_METRICS if m != "installs"]
    out = rows
    for m in nulls:
        out = out.withColumn(m, F.lit(None).cast("double"))
    out = out.withColumn("ad", F.coalesce(F.nullif(dim_normalize(ct), F.lit("")), F.lit(K.RETARGETING_AD_DEFAULT)))
    out = out.withColumn("report_segment", F.lit(segment + K.REATTR_SEGMENT_SUFFIX))
    if isinstance(conversion_type, str) and conversion_type in out.columns:
        out = out.drop(conversion_type)
    return out


def reattr_replace(stored: DataFrame, new_reattr: DataFrame, date_from: _dt.date, date_to: _dt.date,
                   segment: str = K.DEFAULT_REPORT_SEGMENT, tz: str = K.DEFAULT_BUSINESS_TZ) -> DataFrame:
    """Replace the whole window of the reattribution segment; no-op when the new
    fetch is empty (a bounded one-row probe decides)."""
    if new_reattr.isEmpty():
        return stored
    reattr = segment + K.REATTR_SEGMENT_SUFFIX
    drop = F.col("fact_date").between(F.lit(date_from), F.lit(date_to)) & _scope(reattr, tz)
    kept = stored.filter(~F.coalesce(drop, F.lit(False)))
    return kept.unionByName(new_reattr.select(*stored.columns))


def backfill_pull_dims(legacy: DataFrame, dims: Sequence[str] = PULL_DIMS) -> DataFrame:
    """M1: legacy rows with NULL dims -> ''."""
    return legacy.fillna("", subset=list(dims))
