"""Column expressions: everything here returns a ``Column`` (JVM-side, codegen'd)."""

from marketlake.functions.dims import dim_normalize, nullify_blank, py_strip
from marketlake.functions.parse import lenient_float_pull, lenient_float_mcp
from marketlake.functions.dates import (
    utc_to_business_date,
    is_utc_like,
    week_label_monday,
    iso_week_start,
    month_start,
    fact_date_fallback,
    lookback_bounds,
    business_today,
    parse_date,
    storage_date,
)
from marketlake.functions.kpi import attribution_model_of, base_kpi_of, is_ad_grain
from marketlake.functions.ratios import ratio_if_positive, ratio_if_nonzero, scale_factor

__all__ = [
    "dim_normalize", "nullify_blank", "py_strip",
    "lenient_float_pull", "lenient_float_mcp",
    "utc_to_business_date", "is_utc_like", "week_label_monday", "iso_week_start",
    "month_start", "fact_date_fallback", "lookback_bounds", "business_today", "parse_date",
    "attribution_model_of", "base_kpi_of", "is_ad_grain",
    "ratio_if_positive", "ratio_if_nonzero", "scale_factor",
]
