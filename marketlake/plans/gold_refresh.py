"""(re)build every gold dataset in dependency order.

The Pull media-source totals used by the five scaled views are built once and
shared; day totals come before the weekly rollup that reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketlake import constants as K
from marketlake.operators import gold


def gold_datasets(pull: DataFrame, silver: DataFrame, silver_ad: DataFrame, ad_map: DataFrame | None,
                  tz: str = K.DEFAULT_BUSINESS_TZ) -> dict[str, DataFrame]:
    pull_ms = gold.pull_media_source_day(pull, tz)
    daily = gold.daily_totals(pull, silver, K.MODEL_LTV, tz)
    return {
        "growth_fact_rows": gold.growth_fact_rows(pull, silver, tz),
        "growth_daily_totals": daily,
        "growth_breakdowns": gold.growth_breakdowns(silver),
        "growth_weekly_totals": gold.weekly_totals(daily),
        "growth_campaign_daily": gold.campaign_daily(pull, tz),
        "growth_adset_daily": gold.scaled_daily(pull, silver, gold.ADSET, K.MODEL_LTV, tz, pull_ms),
        "growth_ad_daily": gold.scaled_ad_daily(pull, silver_ad, ad_map, K.MODEL_LTV, tz, pull_ms),
        "activity_daily_totals": gold.daily_totals(pull, silver, K.MODEL_ACTIVITY, tz),
        "activity_campaign_daily": gold.scaled_daily(pull, silver, gold.CAMPAIGN, K.MODEL_ACTIVITY, tz, pull_ms),
        "activity_adset_daily": gold.scaled_daily(pull, silver, gold.ADSET, K.MODEL_ACTIVITY, tz, pull_ms),
        "activity_ad_daily": gold.scaled_ad_daily(pull, silver_ad, ad_map, K.MODEL_ACTIVITY, tz, pull_ms),
    }


def gold_refresh(pull: DataFrame, silver: DataFrame, silver_ad: DataFrame, ad_map: DataFrame,
                 tz: str = K.DEFAULT_BUSINESS_TZ, base_path: str | None = None) -> dict[str, DataFrame]:
    """Register every gold dataset as a temp view; with ``base_path`` also materialise each
    one (partitioned by fact_date where it has one) and return the written tables."""
    out = gold_datasets(pull, silver, silver_ad, ad_map, tz)
    spark = pull.sparkSession
    for name, df in out.items():
        if base_path:
            path = f"{base_path.rstrip('/')}/{name}"
            # static: a rebuilt table keeps no day that has gone; rebalanced: files follow the data
            by = [c for c in ("fact_date",) if c in df.columns]
            w = (df.hint("rebalance", *by) if by else df).write.mode("overwrite").option("partitionOverwriteMode", "static")
            if by:
                w = w.partitionBy(*by)
            w.parquet(path)
            df = spark.read.parquet(path)
            out[name] = df
        df.createOrReplaceTempView(name)
    return out
