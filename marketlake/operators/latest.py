"""Latest / preferred row per key.

``keep_preferred`` returns one row per key: the row whose ``prefer`` tuple is
largest (ties broken by the kept columns, so the result is deterministic). It is
an aggregate, ``max(struct(prefer..., kept...))``, rather than ``row_number``
over a window: the aggregate combines map-side before the shuffle, so a hot key
(one media source holding a third of the rows) is reduced inside every task and
never sorted as one group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_preferred(
    df: DataFrame,
    keys: Sequence[str | Column],
    prefer: Sequence[Column],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``keys`` (NULL keys group together), chosen by the largest ``prefer``."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [k for k in keys if isinstance(k, str)]
    if keep is None:
        keep = [c for c in df.columns if c not in key_names]
    pref = [p.alias(f"_pref{i}") for i, p in enumerate(prefer)]
    best = F.max(F.struct(*pref, *[F.col(c) for c in keep])).alias("_best")
    out = df.groupBy(*key_cols).agg(best)
    return out.select(*[c for c in out.columns if c != "_best"], *[F.col("_best")[c].alias(c) for c in keep])


def descending(c: str | Column) -> Column:
    """Preference term for 'larger first'."""
    return F.col(c) if isinstance(c, str) else c


def ascending_number(c: str | Column) -> Column:
    """Preference term for 'smaller first' on a numeric column."""
    x = F.col(c) if isinstance(c, str) else c
    return -x
