"""KPI name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.constants import KPI_ACTIVITY_SUFFIX, KPI_AD_PREFIX, MODEL_ACTIVITY, MODEL_LTV
from marketlake.functions.dims import _col


def attribution_model_of(kpi: str | Column) -> Column:
    """'_activity' suffix -> 'activity', else 'ltv'."""
    return F.when(_col(kpi).endswith(KPI_ACTIVITY_SUFFIX), F.lit(MODEL_ACTIVITY)).otherwise(F.lit(MODEL_LTV))


def base_kpi_of(kpi: str | Column) -> Column:
    """KPI name without a trailing '_activity'."""
    k = _col(kpi)
    cut = k.substr(F.lit(1), F.length(k) - F.lit(len(KPI_ACTIVITY_SUFFIX)))
    return F.when(k.endswith(KPI_ACTIVITY_SUFFIX), cut).otherwise(k)


def is_ad_grain(kpi: str | Column) -> Column:
    """KPI prefix 'ad_' (literal underscore) -> ad grain; 'adset...' is not."""
    return _col(kpi).startswith(KPI_AD_PREFIX)
