"""Typed and historised views of the driver tables shared by several queries.

Spark builders and their DuckDB CTE twins, side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.history import build_versions
from wardline.operators.projection import type_table
from wardline.plans import landing, sqlgen
from wardline.registry import EVENTS_LANDING, LINEITEM_LANDING, ORDERS_LANDING
from wardline.sources.tables import Tables

VERSION_ATTRS = ["o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderkey"]


def typed_lineitem(t: Tables) -> DataFrame:
    return type_table(landing.lineitem_landing(t), LINEITEM_LANDING)


def typed_orders(t: Tables) -> DataFrame:
    return type_table(landing.orders_landing(t), ORDERS_LANDING)


def typed_events(t: Tables) -> DataFrame:
    return type_table(landing.events_landing(t), EVENTS_LANDING)


def customer_versions(t: Tables) -> DataFrame:
    """DIM-1 analogue: a customer's version changes on each day it orders."""
    o = typed_orders(t).withColumn("_okey", F.col("o_orderkey").cast("bigint"))
    return build_versions(o, "o_custkey", "o_orderdate", VERSION_ATTRS, "_okey")


LINEITEM_TYPED_SQL = sqlgen.typed_cte(LINEITEM_LANDING, "lineitem_landing", "lineitem_typed")
ORDERS_TYPED_SQL = sqlgen.typed_cte(ORDERS_LANDING, "orders_landing", "orders_typed")
EVENTS_TYPED_SQL = sqlgen.typed_cte(EVENTS_LANDING, "events_landing", "events_typed")

VERSIONS_SQL = """
versions AS (
  SELECT o_custkey, valid_from,
         lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to,
         o_orderstatus, o_orderpriority, o_totalprice, o_orderkey,
         lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) IS NULL AS is_current
  FROM (
    SELECT o_custkey, o_orderdate AS valid_from,
           arg_max(o_orderstatus, CAST(o_orderkey AS BIGINT)) AS o_orderstatus,
           arg_max(o_orderpriority, CAST(o_orderkey AS BIGINT)) AS o_orderpriority,
           arg_max(o_totalprice, CAST(o_orderkey AS BIGINT)) AS o_totalprice,
           arg_max(o_orderkey, CAST(o_orderkey AS BIGINT)) AS o_orderkey
    FROM orders_typed
    WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
    GROUP BY o_custkey, o_orderdate
  )
)"""

# CTE stacks (landing -> typed [-> versions]) for oracle SQL
LINEITEM_CTES = [landing.LINEITEM_LANDING_SQL, LINEITEM_TYPED_SQL]
ORDERS_CTES = [landing.ORDERS_LANDING_SQL, ORDERS_TYPED_SQL]
EVENTS_CTES = [landing.EVENTS_LANDING_SQL, EVENTS_TYPED_SQL]
VERSION_CTES = ORDERS_CTES + [VERSIONS_SQL]
