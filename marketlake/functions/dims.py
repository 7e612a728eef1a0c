"""Dimension normalisation (P4) and export blanking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.constants import BLANK_DIM_TOKENS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: White space as Unicode has it (what a regex calls ``(?U)\\s``).
_WHITE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def py_strip(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (plain ``trim`` only strips spaces)."""
    return F.trim(_col(c).cast("string"), F.lit(_WHITE))


def dim_normalize(c: str | Column) -> Column:
    """NULL, blank and the 'empty' tokens (any case) -> ''; otherwise the stripped text."""
    s = py_strip(_col(c))
    return (
        F.when(s.isNull(), F.lit(""))
        .when(F.lower(s).isin("", *BLANK_DIM_TOKENS), F.lit(""))
        .otherwise(s)
    )


def nullify_blank(c: str | Column) -> Column:
    """'' and the text 'None' -> NULL (export normalisation)."""
    x = _col(c)
    return F.when(x.isin("", "None"), F.lit(None).cast("string")).otherwise(x)
