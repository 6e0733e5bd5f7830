"""Type-2 history queries: versions, version in force, as-of, change log, invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.history import as_of_with_fallback, change_log, scd_violations, version_in_force
from wardline.plans import derived
from wardline.plans.catalog import query
from wardline.plans.landing import with_sql
from wardline.sources.tables import Tables

VERSIONED_SQL = with_sql(*derived.VERSION_CTES)


@query(
    "dim1_customer_versions",
    sql=VERSIONED_SQL + "\nSELECT * FROM versions",
    ops=("DIM-1", "WN-1"),
    layer="dimension",
)
def dim1_customer_versions(spark, sf_dir):
    """Versions of a customer, one row per change, with the days between which each holds."""
    return derived.customer_versions(Tables(spark, sf_dir))


def _line_events(t: Tables) -> DataFrame:
    li = derived.typed_lineitem(t).select("l_orderkey", "l_linenumber", "l_shipdate")
    od = derived.typed_orders(t).select("o_orderkey", "o_custkey")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner").drop("o_orderkey")


LINE_EVENTS_SQL = """
line_events AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_custkey
  FROM lineitem_typed l JOIN orders_typed o ON l.l_orderkey = o.o_orderkey
)"""
EVENT_CTES = derived.LINEITEM_CTES + derived.VERSION_CTES + [LINE_EVENTS_SQL]


@query(
    "jn3_version_in_force",
    sql=with_sql(*EVENT_CTES)
    + """
SELECT e.*, v.valid_from AS v_valid_from, v.o_orderpriority AS v_o_orderpriority
FROM line_events e LEFT JOIN versions v
  ON e.o_custkey = v.o_custkey AND e.l_shipdate >= v.valid_from
 AND (e.l_shipdate < v.valid_to OR v.valid_to IS NULL)""",
    ops=("JN-3", "FN-3"),
)
def jn3_version_in_force(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return version_in_force(_line_events(t), derived.customer_versions(t), "o_custkey", "l_shipdate", ["o_orderpriority"])


@query(
    "jn4_asof_with_fallback",
    sql=with_sql(*EVENT_CTES)
    + """,
firsts AS (SELECT o_custkey, min(valid_from) AS first_from,
                  arg_min(o_orderpriority, valid_from) AS first_priority FROM versions GROUP BY o_custkey),
asof_r AS (
  SELECT e.*, v.valid_from AS a_from, v.o_orderpriority AS a_priority
  FROM line_events e ASOF LEFT JOIN versions v
    ON e.o_custkey = v.o_custkey AND e.l_shipdate >= v.valid_from
)
SELECT a.l_orderkey, a.l_linenumber, a.l_shipdate, a.o_custkey,
       COALESCE(a.a_from, f.first_from) AS v_valid_from,
       COALESCE(a.a_priority, f.first_priority) AS v_o_orderpriority,
       a.a_from IS NULL AS used_fallback
FROM asof_r a LEFT JOIN firsts f ON a.o_custkey = f.o_custkey""",
    ops=("JN-4",),
)
def jn4_asof_with_fallback(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return as_of_with_fallback(_line_events(t), derived.customer_versions(t), "o_custkey", "l_shipdate", ["o_orderpriority"])


CHANGE_RULES = [("status", ["o_orderstatus"]), ("priority", ["o_orderpriority"]), ("amount", ["o_totalprice"])]


@query(
    "scd3_change_log",
    sql=VERSIONED_SQL
    + """,
lagged AS (
  SELECT o_custkey, valid_from, o_orderstatus, o_orderpriority, o_totalprice,
         lag(o_orderstatus) OVER w AS p_status, lag(o_orderpriority) OVER w AS p_priority,
         lag(o_totalprice) OVER w AS p_total, lag(valid_from) OVER w AS p_from
  FROM versions WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from)
),
diffs AS (
  SELECT o_custkey, valid_from, 'o_orderstatus' AS column_name, p_status AS before, o_orderstatus AS after, 1 AS pos
  FROM lagged WHERE p_from IS NOT NULL AND p_status IS DISTINCT FROM o_orderstatus
  UNION ALL
  SELECT o_custkey, valid_from, 'o_orderpriority', p_priority, o_orderpriority, 2
  FROM lagged WHERE p_from IS NOT NULL AND p_priority IS DISTINCT FROM o_orderpriority
  UNION ALL
  SELECT o_custkey, valid_from, 'o_totalprice', CAST(p_total AS VARCHAR), CAST(o_totalprice AS VARCHAR), 3
  FROM lagged WHERE p_from IS NOT NULL AND p_total IS DISTINCT FROM o_totalprice
),
typed AS (
  SELECT o_custkey, valid_from,
         CASE WHEN COUNT(*) = 1 AND max(column_name) = 'o_orderstatus' THEN 'status'
              WHEN COUNT(*) = 1 AND max(column_name) = 'o_orderpriority' THEN 'priority'
              WHEN COUNT(*) = 1 AND max(column_name) = 'o_totalprice' THEN 'amount'
              ELSE 'mixed' END AS change_type,
         COUNT(*) AS n_changes
  FROM diffs GROUP BY o_custkey, valid_from
)
SELECT d.o_custkey, d.valid_from, d.column_name, d.before, d.after, t.change_type, t.n_changes
FROM diffs d JOIN typed t ON d.o_custkey = t.o_custkey AND d.valid_from = t.valid_from""",
    ops=("SCD-3", "DQ-31"),
)
def scd3_change_log(spark, sf_dir):
    versions = derived.customer_versions(Tables(spark, sf_dir))
    log = change_log(versions, "o_custkey", ["o_orderstatus", "o_orderpriority", "o_totalprice"], CHANGE_RULES)
    return log.select(
        "o_custkey",
        "valid_from",
        "change_type",
        F.size("changes").cast("long").alias("n_changes"),
        F.explode("changes").alias("c"),
    ).select(
        "o_custkey",
        "valid_from",
        F.col("c.column").alias("column_name"),
        F.col("c.before").alias("before"),
        F.col("c.after").alias("after"),
        "change_type",
        "n_changes",
    )


@query(
    "dq22_scd_invariants",
    sql=VERSIONED_SQL
    + """,
per_key AS (
  SELECT o_custkey,
         COUNT(*) FILTER (WHERE p_from IS NOT NULL AND (p_to IS NULL OR p_to > valid_from)) AS n_overlaps,
         COUNT(*) FILTER (WHERE p_from IS NOT NULL AND p_to IS NOT NULL AND p_to <> valid_from) AS n_gaps,
         COUNT(*) FILTER (WHERE is_current) AS n_current
  FROM (SELECT *, lag(valid_from) OVER w AS p_from, lag(valid_to) OVER w AS p_to
        FROM versions WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from))
  GROUP BY o_custkey
)
SELECT COUNT(*) AS n_keys, CAST(SUM(n_overlaps) AS BIGINT) AS n_overlaps, CAST(SUM(n_gaps) AS BIGINT) AS n_gaps,
       COUNT(*) FILTER (WHERE n_current <> 1) AS n_keys_not_one_current
FROM per_key""",
    ops=("DQ-22",),
)
def dq22_scd_invariants(spark, sf_dir):
    per_key = scd_violations(derived.customer_versions(Tables(spark, sf_dir)), "o_custkey")
    return per_key.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("n_overlaps").cast("long").alias("n_overlaps"),
        F.sum("n_gaps").cast("long").alias("n_gaps"),
        F.count_if(F.col("n_current") != 1).alias("n_keys_not_one_current"),
    )


@query(
    "dq20_version_accounting",
    sql=with_sql(*EVENT_CTES)
    + """,
firsts AS (SELECT o_custkey, min(valid_from) AS first_from FROM versions GROUP BY o_custkey),
resolved AS (
  SELECT e.*, v.valid_from AS v_valid_from
  FROM line_events e LEFT JOIN versions v
    ON e.o_custkey = v.o_custkey AND e.l_shipdate >= v.valid_from
   AND (e.l_shipdate < v.valid_to OR v.valid_to IS NULL)
)
SELECT COUNT(*) AS n_events,
       COUNT(*) FILTER (WHERE r.v_valid_from IS NULL) AS n_unresolved,
       COUNT(*) FILTER (WHERE r.v_valid_from IS NULL AND NOT (f.first_from IS NULL OR r.l_shipdate IS NULL
                        OR r.l_shipdate < f.first_from)) AS n_unexplained
FROM resolved r LEFT JOIN firsts f ON r.o_custkey = f.o_custkey""",
    ops=("DQ-20",),
)
def dq20_version_accounting(spark, sf_dir):
    """An unresolved version is legitimate only when the key has no version or the
    event precedes its first version (or has no date)."""
    t = Tables(spark, sf_dir)
    versions = derived.customer_versions(t)
    resolved = version_in_force(_line_events(t), versions, "o_custkey", "l_shipdate", [])
    firsts = versions.groupBy(F.col("o_custkey").alias("_k")).agg(F.min("valid_from").alias("first_from"))
    j = resolved.join(firsts, resolved["o_custkey"] == firsts["_k"], "left")
    unresolved = F.col("v_valid_from").isNull()
    explained = F.col("first_from").isNull() | F.col("l_shipdate").isNull() | (F.col("l_shipdate") < F.col("first_from"))
    return j.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(unresolved).alias("n_unresolved"),
        F.count_if(unresolved & ~explained).alias("n_unexplained"),
    )
