"""Null-safe percentage growth with a fixed decimal scale.

``100 * (cur - prev) / prev`` rounded half-up to one decimal place, as
``decimal(23,1)``; null when ``prev`` is null or zero.  The numerator is
cast to ``decimal(20,0)`` first so the division is exact decimal
arithmetic (no double rounding), and the zero guard runs before the
division, so ANSI mode never sees a divide-by-zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GROWTH_TYPE = "decimal(23,1)"


def pct_growth(cur: str | Column, prev: str | Column, scale: int = 1) -> Column:
    c = F.col(cur) if isinstance(cur, str) else cur
    p = F.col(prev) if isinstance(prev, str) else prev
    num = ((c - p) * F.lit(100)).cast("decimal(20,0)")
    ratio = F.round(num / p.cast("decimal(20,0)"), scale)
    return (F.when(p.isNull() | (p == 0), F.lit(None))
            .otherwise(ratio).cast(f"decimal(23,{scale})"))
