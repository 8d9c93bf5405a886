"""Staging models, dimensions and facts of the visits mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.email import email_domain, has_email_shape
from kestrel.functions.units import feet_to_meters

STG_COLUMNS = {
    "stg_customers": ("customer_id", "age", "gender", "email"),
    "stg_feedbacks": ("feedback_id", "ticket_id", "rating", "comments"),
    "stg_houses": ("haunted_house_id", "house_name", "park_area", "theme", "fear_level",
                   "house_size"),
    "stg_tickets": ("ticket_id", "customer_id", "haunted_house_id", "purchase_date",
                    "visit_date", "ticket_type", "ticket_price"),
}
FACT_COLUMNS = STG_COLUMNS["stg_tickets"] + ("rating", "comments")


def stg_customers(raw: DataFrame) -> DataFrame:
    """D1"""
    return raw.select(*STG_COLUMNS["stg_customers"])


def stg_feedbacks(raw: DataFrame) -> DataFrame:
    """D2"""
    return raw.select(*STG_COLUMNS["stg_feedbacks"])


def stg_houses(raw: DataFrame) -> DataFrame:
    """D3"""
    return raw.select(*STG_COLUMNS["stg_houses"])


def stg_tickets(raw: DataFrame) -> DataFrame:
    """D4"""
    return raw.select(*STG_COLUMNS["stg_tickets"])


def dim_customers(customers: DataFrame, domains: DataFrame) -> DataFrame:
    """Customers with ``is_valid_email_address`` (never null).

    Valid = LIKE '%@%.%' and the text after the first '@' is an accepted
    domain.  The IN-subquery is a left join to the distinct domains, an
    ordinary table: the planner broadcasts it if its files are small.
    """
    c = customers.select("customer_id", "age", "gender", "email")
    d = (domains.select(F.col("valid_domain").alias("_domain")).dropDuplicates()
                .withColumn("_ok", F.lit(True)))
    j = c.join(d, email_domain("email") == F.col("_domain"), "left")
    flag = F.when(has_email_shape("email") & F.col("_ok").isNotNull(), F.lit(True)) \
            .otherwise(F.lit(False))
    return j.select("customer_id", "age", "gender", "email",
                    flag.alias("is_valid_email_address"))


def dim_houses(houses: DataFrame, scale: int = 2) -> DataFrame:
    """Size kept in ft2 and converted (decimal(16, scale))."""
    return houses.select("haunted_house_id", "house_name", "park_area", "theme", "fear_level",
                         F.col("house_size").alias("house_size_in_ft2"),
                         feet_to_meters("house_size", scale).alias("house_size_in_m2"))


def fact_visits(tickets: DataFrame, feedbacks: DataFrame) -> DataFrame:
    """Tickets left join feedbacks on ticket_id (ticket grain; a
    ticket with two feedbacks yields two rows, which ``dq_unique`` reports).

    Both sides are keyed by ticket_id: one shuffle each, or none when the
    sides come bucketed/partitioned by ticket_id.  Both grow with the data, so
    neither is ever broadcast: a filter on the feedback's columns makes the join
    an inner one, and the planner takes the tickets' keys for small by the size
    of their compressed files.
    """
    t = tickets.select(*STG_COLUMNS["stg_tickets"])
    f = feedbacks.select("ticket_id", "rating", "comments")
    return t.join(f.hint("merge"), "ticket_id", "left").select(*FACT_COLUMNS)


def audit_fact_visits(tickets: DataFrame, feedbacks: DataFrame,
                      purchase_date: str | dt.date) -> DataFrame:
    """One purchase date's tickets with their feedbacks.

    The date filter is on the bare column (pushed to the scan); the
    feedbacks are reduced to those tickets by a left-semi join first, as
    the reference's IN-subquery does, then left-joined.
    """
    t = (tickets.select(*STG_COLUMNS["stg_tickets"])
                .filter(F.col("purchase_date") == F.lit(str(purchase_date)).cast("date")))
    f = (feedbacks.select("ticket_id", "rating", "comments")
                  .join(t.select("ticket_id"), "ticket_id", "left_semi"))
    return t.join(f, "ticket_id", "left").select(*FACT_COLUMNS)
