"""A hot key (one media source with a third of the rows) against a brute-force pandas check."""

import pandas as pd
from pyspark.sql import functions as F

from marketlake import catalog
from marketlake.operators import gold, silver


def test_hot_media_source_canonical_rows_and_scaling(spark):
    mcp = catalog.Inputs(spark, "/root/testdata/sf0.001").mcp
    # put a third of the rows into one media source (and keep NULLs elsewhere)
    hot = mcp.withColumn("media_source", F.when(F.xxhash64("fetched_at", "kpi_name") % 3 == 0, F.lit("hot"))
                         .otherwise(F.col("media_source")))
    got = silver.canonical_source_rows(hot, silver.ADSET_GRAIN_DIMS, ad_grain=False).toPandas()
    src = hot.filter(~F.col("kpi_name").startswith("ad_")).toPandas()
    src["w"] = (pd.to_datetime(src.fetch_window_to) - pd.to_datetime(src.fetch_window_from)).dt.days
    keys = ["fact_date", "media_source", "campaign", "adset", "ad", "kpi_name"]
    src = src.sort_values(["w", "fetched_at"], ascending=[True, False])
    want = src.groupby(keys, dropna=False, sort=False).head(1)
    assert len(got) == len(want)
    g = got.set_index(keys)["fetched_at"].sort_index()
    w = want.set_index(keys)["fetched_at"].sort_index()
    assert (g.values == w.values).all()

    sil = silver.marketing_fact_daily(hot)
    scaled = gold.scaled_daily(catalog.Inputs(spark, "/root/testdata/sf0.001").pull, sil, gold.ADSET)
    assert scaled.filter("media_source = 'hot'").count() > 0
    assert scaled.count() == sil.filter("attribution_model = 'ltv'").select(
        "fact_date", "media_source", "campaign", "adset").distinct().count()


def test_hot_media_source_scales_to_pulls_total(spark):
    inp = catalog.Inputs(spark, "/root/testdata/sf0.001")
    hot = F.when(F.xxhash64("fetched_at") % 3 == 0, F.lit("hot")).otherwise(F.col("media_source"))
    pull = inp.pull.withColumn("media_source", F.when(F.col("ingest_seq") % 3 == 0, F.lit("hot")).otherwise(F.col("media_source")))
    sil = silver.marketing_fact_daily(inp.mcp.withColumn("media_source", hot)).toPandas()
    sil = sil[(sil.attribution_model == "ltv") & sil.media_source.notna()]
    got = gold.scaled_daily(pull, silver.marketing_fact_daily(inp.mcp.withColumn("media_source", hot)), gold.ADSET).toPandas()
    own = sil.groupby(["fact_date", "media_source"]).spend.sum()
    target = pull.filter("timezone = 'America/Los_Angeles'").toPandas().groupby(["fact_date", "media_source"]).cost.sum()
    sums = got[got.media_source.notna()].groupby(["fact_date", "media_source"]).spend.sum()
    assert len(sums) == len(own) and any(k[1] == "hot" for k in sums.index)
    for key, value in sums.items():
        want = target[key] if key in target.index and own[key] else own[key]
        assert abs(value - want) <= 1e-6 * max(1.0, want), key
