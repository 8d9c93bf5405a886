"""Aggregation-level names for grouping sets, rollups and cubes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVEL_SEP = "__"


def agg_level(dims: Sequence[str], sep: str = LEVEL_SEP) -> Column:
    """Names of the grouped (kept) columns joined by ``sep``.

    Must be used inside the aggregation (it calls ``grouping``).  The
    grand total is ``''``; the full grain is all names in ``dims`` order.
    ``concat_ws`` skips the nulls of the non-grouped columns.
    """
    return F.concat_ws(sep, *[F.when(F.grouping(d) == 0, F.lit(d)) for d in dims])
