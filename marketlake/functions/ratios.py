"""Safe ratios (P18) and the proportional scale factor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions.dims import _col


def ratio_if_positive(num: str | Column, den: str | Column) -> Column:
    """num / den when den > 0, else NULL (gold layer rule)."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, n / d)


def ratio_if_nonzero(num: str | Column, den: str | Column) -> Column:
    """NULL when den is NULL or 0, else num / den (mart rule)."""
    n, d = _col(num), _col(den)
    return F.when(F.coalesce(d, F.lit(0.0)) != 0, n / F.nullif(d, F.lit(0.0)))


def scale_factor(authoritative: str | Column, own_total: str | Column) -> Column:
    """coalesce(authoritative / nullif(own_total, 0), 1.0)."""
    return F.coalesce(_col(authoritative) / F.nullif(_col(own_total), F.lit(0.0)), F.lit(1.0))
