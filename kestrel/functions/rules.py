"""Ordered LIKE-rule lists turned into one ``CASE WHEN`` column.

A rule list is ``[(pattern, label), ...]``: the first pattern that
matches (case-sensitive SQL LIKE) gives the label; no match gives the
``default`` column (or literal).  The lists below are fixed values: the
mapping results must equal the reference's, so they are spelled out as
they are, in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str | Sequence[str], str]

# --- fixed values ----------------------------------------------------------
# host pattern -> site name (first match wins; no match keeps the host)
HOST_RULES: list[Rule] = [
    ("%techcreator%", "TechCreator.io"),
    ("%eczachly%", "EcZachly.com"),
    ("%zachwilson%", "ZachWilson.tech"),
    ("%dataengineer%", "DataEngineer.io"),
]
# device pattern -> device family (no match: device_type, or 'unknown')
DEVICE_RULES: list[Rule] = [("%amsung%", "Samsung")]
# os pattern(s) -> os family (no match: 'other'); note '%iOS' has no
# trailing wildcard, so 'iOS 17' is 'other'
OS_RULES: list[Rule] = [
    ("%ndroid%", "Android"),
    (("%ios%", "%iOS"), "iOS"),
]
UNKNOWN = "unknown"
OTHER = "other"
OVERALL = "(overall)"
# ---------------------------------------------------------------------------


def like_rules(col: str | Column, rules: Sequence[Rule], default: Column | str | None) -> Column:
    """First-match ``CASE WHEN col LIKE p THEN label ... ELSE default END``.

    A pattern entry may be a tuple of patterns joined by OR.  A null
    input matches no pattern and falls to ``default``.
    """
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for patterns, label in rules:
        pats = (patterns,) if isinstance(patterns, str) else tuple(patterns)
        cond = c.like(pats[0])
        for p in pats[1:]:
            cond = cond | c.like(p)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if default is None:
        return out
    dflt = F.lit(default) if isinstance(default, str) else default
    return dflt if out is None else out.otherwise(dflt)


def map_host(col: str | Column = "host", rules: Sequence[Rule] = HOST_RULES) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return like_rules(c, rules, c)


def map_device(col: str | Column = "device_type", rules: Sequence[Rule] = DEVICE_RULES) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return like_rules(c, rules, F.coalesce(c, F.lit(UNKNOWN)))


def classify_os(col: str | Column = "os_type", rules: Sequence[Rule] = OS_RULES) -> Column:
    return like_rules(col, rules, OTHER)


def fill_unknown(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(UNKNOWN))
