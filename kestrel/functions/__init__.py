"""Column-level building blocks (all built-in Spark expressions)."""

from kestrel.functions.email import email_domain, has_email_shape, invalid_email
from kestrel.functions.growth import pct_growth
from kestrel.functions.levels import agg_level
from kestrel.functions.rules import classify_os, fill_unknown, like_rules, map_device, map_host
from kestrel.functions.units import feet_to_meters

__all__ = ["agg_level", "classify_os", "email_domain", "feet_to_meters", "fill_unknown",
           "has_email_shape", "invalid_email", "like_rules", "map_device",
           "map_host", "pct_growth"]
