"""Landing (all-text) analogues derived from the driver tables.

The source system delivers daily all-text extracts. Here the driver tables are
rendered into that form by Spark: dates become ``MM/dd/yyyy`` text, instants
12-hour text, amounts decimal text, and defects are introduced by fixed rules on
the rows' own keys so that every check has something to find. Each builder has
a DuckDB twin (``*_SQL``) used by the oracle; both must stay in step. Tables are dealt
out evenly first (rebalance, which Spark sizes and splits): rendering is CPU work.

Defect rules (fixed values):
  lineitem: empty line number when l_orderkey % 997 = 3; quantity suffixed 'u'
  when l_partkey % 83 = 5; amount with a decimal comma when l_suppkey % 61 = 3;
  blank ship date when (l_orderkey + l_linenumber) % 50 = 0; day '32' when
  l_partkey % 97 = 13; return flag 'Y' when returned and l_orderkey % 101 = 0;
  extraction date one month early when l_orderkey % 499 = 1.
  orders: blank order date when o_orderkey % 113 = 0; month '13' when
  o_orderkey % 127 = 9; total prefixed '$' when o_custkey % 71 = 4.
  events: blank instant when event_id % 211 = 0; value 'NaN' when event_id % 307 = 0.
Partitions: lineitem and orders by the month after the ship / order month,
events by the day after the event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.registry import EVENTS_LANDING, LINEITEM_LANDING, ORDERS_LANDING
from wardline.sources.tables import Tables


def _txt(c) -> F.Column:
    return c.cast("string")


def _money(c) -> F.Column:
    return c.cast("decimal(18,2)").cast("string")


def lineitem_landing(t: Tables, with_identity: bool = False) -> DataFrame:
    """Landing text of the shipment lines; ``with_identity`` appends ``row_id`` (raw
    order, part, supplier and ship day), used to confront reasons with the truth."""
    ship = F.to_date("l_shipdate")
    okey, line, pkey, skey = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    qty = _txt(F.col("l_quantity").cast("int"))
    price = _money(F.col("l_extendedprice"))
    month = F.trunc(ship, "MM")
    out = t.lineitem.hint("rebalance").select(
        _txt(okey).alias("l_orderkey"),
        F.when(okey % 997 == 3, F.lit("")).otherwise(_txt(line)).alias("l_linenumber"),
        _txt(pkey).alias("l_partkey"),
        _txt(skey).alias("l_suppkey"),
        F.when(pkey % 83 == 5, F.concat(qty, F.lit("u"))).otherwise(qty).alias("l_quantity"),
        F.when(skey % 61 == 3, F.replace(price, F.lit("."), F.lit(","))).otherwise(price).alias("l_extendedprice"),
        _money(F.col("l_discount")).alias("l_discount"),
        "l_returnflag",
        "l_linestatus",
        F.when((okey + line) % 50 == 0, F.lit(""))
        .when(pkey % 97 == 13, F.concat(F.date_format(ship, "MM"), F.lit("/32/"), F.date_format(ship, "yyyy")))
        .otherwise(F.date_format(ship, "MM/dd/yyyy"))
        .alias("l_shipdate"),
        F.when((F.col("l_returnflag") == "R") & (okey % 101 == 0), F.lit("Y"))
        .when(F.col("l_returnflag") == "R", F.lit("1"))
        .otherwise(F.lit("0"))
        .alias("is_returned"),
        F.date_format(F.when(okey % 499 == 1, month).otherwise(F.add_months(month, 1)), "MM/dd/yyyy").alias(
            "date_extraction"
        ),
        F.add_months(month, 1).alias("path_date"),
        F.concat_ws("|", _txt(okey), _txt(pkey), _txt(skey), F.date_format(ship, "yyyy-MM-dd")).alias("row_id"),
    )
    return out.select(*LINEITEM_LANDING.names, "path_date", *(["row_id"] if with_identity else []))


LINEITEM_LANDING_SQL = """
lineitem_landing AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) AS l_orderkey,
    CASE WHEN l_orderkey % 997 = 3 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
    CAST(l_partkey AS VARCHAR) AS l_partkey,
    CAST(l_suppkey AS VARCHAR) AS l_suppkey,
    CASE WHEN l_partkey % 83 = 5 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'u'
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS l_quantity,
    CASE WHEN l_suppkey % 61 = 3 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS l_extendedprice,
    CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS l_discount,
    l_returnflag,
    l_linestatus,
    CASE WHEN (l_orderkey + l_linenumber) % 50 = 0 THEN ''
         WHEN l_partkey % 97 = 13 THEN strftime(l_shipdate, '%m') || '/32/' || strftime(l_shipdate, '%Y')
         ELSE strftime(l_shipdate, '%m/%d/%Y') END AS l_shipdate,
    CASE WHEN l_returnflag = 'R' AND l_orderkey % 101 = 0 THEN 'Y'
         WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS is_returned,
    strftime(CASE WHEN l_orderkey % 499 = 1 THEN date_trunc('month', l_shipdate)
                  ELSE date_trunc('month', l_shipdate) + INTERVAL 1 MONTH END, '%m/%d/%Y') AS date_extraction,
    CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS path_date
  FROM lineitem
)"""

# the same extract with the raw row identity appended (tie-break of last resort)
LINEITEM_LANDING_ID_SQL = LINEITEM_LANDING_SQL.replace("lineitem_landing AS (", "lineitem_landing_id AS (").replace(
    "AS path_date\n  FROM lineitem",
    "AS path_date,\n    l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || strftime(l_shipdate, '%Y-%m-%d') AS row_id\n  FROM lineitem",
)


def orders_landing(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    okey, ckey = F.col("o_orderkey"), F.col("o_custkey")
    total = _money(F.col("o_totalprice"))
    month = F.trunc(day, "MM")
    out = t.orders.hint("rebalance").select(
        _txt(okey).alias("o_orderkey"),
        _txt(ckey).alias("o_custkey"),
        "o_orderstatus",
        F.when(ckey % 71 == 4, F.concat(F.lit("$"), total)).otherwise(total).alias("o_totalprice"),
        F.when(okey % 113 == 0, F.lit(""))
        .when(okey % 127 == 9, F.concat(F.lit("13/"), F.date_format(day, "dd/yyyy")))
        .otherwise(F.date_format(day, "MM/dd/yyyy"))
        .alias("o_orderdate"),
        "o_orderpriority",
        F.date_format(F.add_months(month, 1), "MM/dd/yyyy").alias("date_extraction"),
        F.add_months(month, 1).alias("path_date"),
    )
    return out.select(*ORDERS_LANDING.names, "path_date")


ORDERS_LANDING_SQL = """
orders_landing AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS o_orderkey,
    CAST(o_custkey AS VARCHAR) AS o_custkey,
    o_orderstatus,
    CASE WHEN o_custkey % 71 = 4 THEN '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS o_totalprice,
    CASE WHEN o_orderkey % 113 = 0 THEN ''
         WHEN o_orderkey % 127 = 9 THEN '13/' || strftime(o_orderdate, '%d/%Y')
         ELSE strftime(o_orderdate, '%m/%d/%Y') END AS o_orderdate,
    o_orderpriority,
    strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%m/%d/%Y') AS date_extraction,
    CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS path_date
  FROM orders
)"""


def events_landing(t: Tables) -> DataFrame:
    eid = F.col("event_id")
    nxt = F.date_add(F.to_date("ts"), 1)
    out = t.events.hint("rebalance").select(
        _txt(eid).alias("event_id"),
        F.when(eid % 211 == 0, F.lit("")).otherwise(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a")).alias("ts"),
        _txt(F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(eid % 307 == 0, F.lit("NaN")).otherwise(_money(F.col("value"))).alias("value"),
        F.date_format(nxt, "MM/dd/yyyy").alias("date_extraction"),
        nxt.alias("path_date"),
    )
    return out.select(*EVENTS_LANDING.names, "path_date")


EVENTS_LANDING_SQL = """
events_landing AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN event_id % 211 = 0 THEN '' ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') END AS ts,
    CAST(user_id AS VARCHAR) AS user_id,
    event_type,
    CASE WHEN event_id % 307 = 0 THEN 'NaN' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value,
    strftime(CAST(ts AS DATE) + 1, '%m/%d/%Y') AS date_extraction,
    CAST(ts AS DATE) + 1 AS path_date
  FROM events
)"""


def with_sql(*ctes: str) -> str:
    """Join CTE bodies into one WITH prefix (a CTE listed twice is kept once)."""
    seen: list[str] = []
    for c in ctes:
        c = c.strip()
        if c not in seen:
            seen.append(c)
    return "WITH " + ",\n".join(seen)
