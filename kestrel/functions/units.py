"""Unit conversion column macro."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: feet per meter factor used by the conversion
FEET_TO_METERS = Decimal("0.3048")


def feet_to_meters(col: str | Column, scale: int = 2, factor: Decimal = FEET_TO_METERS) -> Column:
    """``(col * factor)::numeric(16, scale)``; the cast rounds half up."""
    c = F.col(col) if isinstance(col, str) else col
    return (c * F.lit(factor)).cast(f"decimal(16,{scale})")
