"""E-mail shape rules (LIKE chains)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the failure patterns of the e-mail shape test.
# "intended" replaces the reference's bare '%@%' (which fails every
# address that has an '@') by '%@.%' (a dot right after the '@').
MUST_MATCH = "%@%.%"
FAIL_PATTERNS_INTENDED = ("%@%@%", "@%", "%@.%", "%.@%")
FAIL_PATTERNS_LITERAL = ("%@%@%", "@%", "%@%", "%.@%")


def has_email_shape(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.like(MUST_MATCH)


def invalid_email(col: str | Column, literal: bool = False) -> Column:
    """True for a failing address, null for a null address (which passes)."""
    c = F.col(col) if isinstance(col, str) else col
    cond = ~c.like(MUST_MATCH)
    for p in (FAIL_PATTERNS_LITERAL if literal else FAIL_PATTERNS_INTENDED):
        cond = cond | c.like(p)
    return cond


def email_domain(col: str | Column) -> Column:
    """Text after the first '@' ('' when there is none)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split_part(c, F.lit("@"), F.lit(2))
