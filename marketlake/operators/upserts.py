"""Merges without MERGE: last-writer-wins and coalescing upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.latest import descending, keep_preferred

SOURCE_KEYS = ("fetch_window_from", "fetch_window_to", "fact_date", "media_source", "campaign",
               "adset", "ad", "kpi_name")
SILVER_KEYS = ("fact_date", "source_system", "media_source", "campaign", "adset", "ad", "attribution_model")
SILVER_COALESCED = ("installs", "spend", "af_start_trial", "af_subscribe", "af_tutorial_completion",
                    "rc_trial_converted_event", "arpu_ltv", "currency", "timezone")


def source_upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = SOURCE_KEYS,
                  order_cols: Sequence[str] = ("ingest_seq", "fetched_at")) -> DataFrame:
    """Union + one row per key (NULL key parts compare equal); the row written last
    wins, where write order is ``order_cols`` (batch sequence, then fetch time)."""
    both = stored.unionByName(incoming)
    keep = [c for c in both.columns if c not in keys]
    return keep_preferred(both, list(keys), prefer=[descending(c) for c in order_cols],
                          keep=keep).select(*stored.columns)


def coalesce_upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = SILVER_KEYS,
                    coalesced: Sequence[str] = SILVER_COALESCED, always_new: Sequence[str] = ("fetched_at",)) -> DataFrame:
    """On a key match the new value wins unless it is NULL; ``always_new`` columns
    always take the new value. Keys compare with plain equality: a NULL key part never
    matches (unique constraints treat NULLs as distinct), so such rows are inserted."""
    o = stored.select(*[F.col(c).alias("o_" + c) for c in stored.columns], F.lit(True).alias("_o"))
    n = incoming.select(*[F.col(c).alias("n_" + c) for c in stored.columns], F.lit(True).alias("_n"))
    cond = None
    for k in keys:
        c = F.col("o_" + k) == F.col("n_" + k)
        cond = c if cond is None else cond & c
    j = o.join(n, cond, "full_outer")
    out = []
    for c in stored.columns:
        if c in keys:
            out.append(F.when(F.col("_n").isNotNull(), F.col("n_" + c)).otherwise(F.col("o_" + c)).alias(c))
        elif c in coalesced:
            out.append(F.when(F.col("_n").isNotNull(), F.coalesce(F.col("n_" + c), F.col("o_" + c)))
                       .otherwise(F.col("o_" + c)).alias(c))
        elif c in always_new:
            out.append(F.when(F.col("_n").isNotNull(), F.col("n_" + c)).otherwise(F.col("o_" + c)).alias(c))
        else:  # not updated on a match: the stored value stays
            out.append(F.when(F.col("_o").isNotNull(), F.col("o_" + c)).otherwise(F.col("n_" + c)).alias(c))
    return j.select(*out)
