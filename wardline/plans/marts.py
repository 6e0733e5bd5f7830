"""Facts (FCT-2..6) and marts (MRT-1, MRT-3..7) on the driver tables, with their checks.

Analogies: an order is an invoice / a visit / a receivable, its lines are the
invoice lines, receipts and receivable snapshots; a user-day of events is a
stay (signup = admission, view = transfer, error = exit); an event is an
emergency visit whose value is the delay to care in minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.conversions import concat_code, distinct_from, minutes_between, ratio
from wardline.operators import quality as Q
from wardline.operators.aggregates import collision_groups
from wardline.operators.history import version_in_force
from wardline.plans import derived, landing, sqlgen
from wardline.plans.catalog import query
from wardline.plans.landing import with_sql
from wardline.plans.quality_plans import LEAD_CTES, SPECS, lead_time_facts, mart_facts
from wardline.sources.tables import Tables


def _r(c, n=6):
    return F.round(c, n)


def _money(c):
    return c.cast("decimal(18,2)")


# ------------------------------------------------------------------ FCT-5 invoices


def invoice_facts(t: Tables) -> DataFrame:
    """FCT-5: one row per order with its line roll-up (JN-2) and customer version (JN-3)."""
    lines = derived.typed_lineitem(t).groupBy(F.col("l_orderkey").alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("l_extendedprice").alias("_amount"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("_discount"),
    )
    od = derived.typed_orders(t).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    j = od.join(lines, od["o_orderkey"] == lines["_k"], "left")
    amount = F.coalesce(F.col("_amount"), F.lit(0))
    disc = F.coalesce(F.col("_discount"), F.lit(0))
    inv = j.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_orderpriority",
        "o_totalprice",
        F.coalesce(F.col("_n"), F.lit(0)).alias("n_lines"),
        _money(amount).alias("lines_amount"),
        _money(amount - disc).alias("insurer_share"),
        _money(disc).alias("patient_share"),
        distinct_from("o_totalprice", _money(amount)).alias("is_discrepant"),
    )
    return version_in_force(inv, derived.customer_versions(t), "o_custkey", "o_orderdate", [])


INVOICE_SQL = """
invoice AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority, o.o_totalprice,
         COALESCE(l.n, 0) AS n_lines,
         CAST(COALESCE(l.amount, 0) AS DECIMAL(18,2)) AS lines_amount,
         CAST(COALESCE(l.amount, 0) - COALESCE(l.disc, 0) AS DECIMAL(18,2)) AS insurer_share,
         CAST(COALESCE(l.disc, 0) AS DECIMAL(18,2)) AS patient_share,
         o.o_totalprice IS DISTINCT FROM CAST(COALESCE(l.amount, 0) AS DECIMAL(18,2)) AS is_discrepant,
         v.valid_from AS v_valid_from
  FROM orders_typed o
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n, SUM(l_extendedprice) AS amount,
                    SUM(l_extendedprice * l_discount) AS disc
             FROM lineitem_typed GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
  LEFT JOIN versions v ON o.o_custkey = v.o_custkey AND o.o_orderdate >= v.valid_from
                      AND (o.o_orderdate < v.valid_to OR v.valid_to IS NULL)
)"""
INVOICE_CTES = derived.LINEITEM_CTES + derived.VERSION_CTES + [INVOICE_SQL]


@query("fct5_invoices", sql=with_sql(*INVOICE_CTES) + "\nSELECT * FROM invoice", ops=("FCT-5", "JN-2", "JN-3", "FN-11", "AG-1"))
def fct5_invoices(spark, sf_dir):
    return invoice_facts(Tables(spark, sf_dir))


@query(
    "dq23_invoice_reconciliation",
    sql=with_sql(*INVOICE_CTES)
    + """
SELECT CAST(SUM(lines_amount) AS DECIMAL(18,2)) AS total_from_invoices,
       (SELECT CAST(SUM(l_extendedprice) AS DECIMAL(18,2)) FROM lineitem_typed
         WHERE l_orderkey IN (SELECT o_orderkey FROM orders_typed)) AS total_from_lines,
       COUNT(*) FILTER (WHERE insurer_share + patient_share <> lines_amount) AS n_share_mismatch,
       COUNT(*) FILTER (WHERE is_discrepant) AS n_header_line_discrepant,
       COUNT(*) AS n_invoices
FROM invoice""",
    ops=("DQ-23", "IN-26", "AG-2"),
)
def dq23_invoice_reconciliation(spark, sf_dir):
    """Header / line reconciliation: global sums both ways, shares add up to the total."""
    t = Tables(spark, sf_dir)
    inv = invoice_facts(t)
    od_keys = derived.typed_orders(t).select(F.col("o_orderkey").alias("l_orderkey"))
    lines = derived.typed_lineitem(t).join(od_keys, "l_orderkey", "left_semi")
    per_inv = inv.agg(
        _money(F.sum("lines_amount")).alias("total_from_invoices"),
        F.count_if(F.col("insurer_share") + F.col("patient_share") != F.col("lines_amount")).alias("n_share_mismatch"),
        F.count_if("is_discrepant").alias("n_header_line_discrepant"),
        F.count(F.lit(1)).alias("n_invoices"),
    )
    return per_inv.withColumn("total_from_lines", lines.select(_money(F.sum("l_extendedprice"))).scalar())


# ------------------------------------------------------------------ FCT-6 receipts (JN-5)


@query(
    "fct6_receipts",
    sql=with_sql(*derived.LINEITEM_CTES, *derived.VERSION_CTES)
    + """
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate AS receipt_date, l.l_extendedprice AS amount,
       o.o_custkey, v.valid_from AS v_valid_from
FROM lineitem_typed l
LEFT JOIN orders_typed o ON l.l_orderkey = o.o_orderkey
LEFT JOIN versions v ON o.o_custkey = v.o_custkey AND o.o_orderdate >= v.valid_from
                    AND (o.o_orderdate < v.valid_to OR v.valid_to IS NULL)""",
    ops=("FCT-6", "JN-5"),
)
def fct6_receipts(spark, sf_dir):
    """Receipt -> invoice -> customer version in force on the invoice day (chained left joins)."""
    t = Tables(spark, sf_dir)
    rc = derived.typed_lineitem(t).select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("receipt_date"), F.col("l_extendedprice").alias("amount")
    )
    od = derived.typed_orders(t).select(F.col("o_orderkey").alias("_ok"), "o_custkey", "o_orderdate")
    j = rc.join(od, rc["l_orderkey"] == od["_ok"], "left").drop("_ok")
    out = version_in_force(j, derived.customer_versions(t), "o_custkey", "o_orderdate", [])
    return out.drop("o_orderdate")


# ------------------------------------------------------------------ FCT-2 visits (JN-6)


def visit_facts(t: Tables) -> DataFrame:
    """FCT-2: an order is a visit; its appointment (lines) is resolved only if it exists."""
    booked = derived.typed_lineitem(t).groupBy(F.col("l_orderkey").alias("_k")).agg(
        F.min("l_shipdate").alias("_first_ship")
    )
    od = derived.typed_orders(t).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = od.join(booked, od["o_orderkey"] == booked["_k"], "left")
    return j.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_orderpriority",
        F.when(F.col("_k").isNotNull(), F.col("o_orderkey")).alias("resolved_appointment"),
        F.datediff("_first_ship", "o_orderdate").alias("days_to_first_line"),
    )


VISIT_SQL = """
visit AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority,
         CASE WHEN EXISTS (SELECT 1 FROM lineitem_typed l WHERE l.l_orderkey = o.o_orderkey)
              THEN o.o_orderkey END AS resolved_appointment,
         CAST(datediff('day', o.o_orderdate, (SELECT min(l_shipdate) FROM lineitem_typed l WHERE l.l_orderkey = o.o_orderkey))
           AS INTEGER) AS days_to_first_line
  FROM orders_typed o
)"""


@query(
    "fct2_visits",
    sql=with_sql(*derived.LINEITEM_CTES, *derived.ORDERS_CTES, VISIT_SQL) + "\nSELECT * FROM visit",
    ops=("FCT-2", "JN-6", "FN-4"),
)
def fct2_visits(spark, sf_dir):
    return visit_facts(Tables(spark, sf_dir))


@query(
    "dq25_resolved_appointments",
    sql=with_sql(*derived.LINEITEM_CTES, *derived.ORDERS_CTES, VISIT_SQL)
    + """
SELECT (SELECT COUNT(resolved_appointment) FROM visit) AS n_resolved,
       (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem_typed
         WHERE l_orderkey IN (SELECT o_orderkey FROM orders_typed)) AS n_booked""",
    ops=("DQ-25", "JN-7"),
)
def dq25_resolved_appointments(spark, sf_dir):
    t = Tables(spark, sf_dir)
    od = derived.typed_orders(t).select(F.col("o_orderkey").alias("l_orderkey"))
    booked = derived.typed_lineitem(t).select("l_orderkey").join(od, "l_orderkey", "left_semi")
    n_booked = booked.select(F.count_distinct("l_orderkey")).scalar()
    return visit_facts(t).agg(F.count("resolved_appointment").alias("n_resolved")).withColumn("n_booked", n_booked)


# ------------------------------------------------------------------ FCT-4 stays (AG-10)


def stay_facts(t: Tables) -> DataFrame:
    """FCT-4: roll-up of a user's events of one day into a stay."""
    ev = derived.typed_events(t).filter(F.col("ts").isNotNull())
    kind = F.col("event_type")
    stays = ev.groupBy("user_id", F.to_date("ts").alias("stay_day")).agg(
        F.min(F.when(kind == "signup", F.col("ts"))).alias("admitted_at"),
        F.max(F.when(kind == "error", F.col("ts"))).alias("exit_at"),
        F.count(F.lit(1)).alias("n_movements"),
        F.count_if(kind == "view").alias("n_transfers"),
        F.max(F.when(kind == "signup", F.col("value"))).alias("admission_value"),
    )
    return stays.withColumn("length_minutes", _r(minutes_between("exit_at", "admitted_at"))).withColumn(
        "is_open", F.col("exit_at").isNull()
    )


STAY_SQL = """
stay AS (
  SELECT user_id, CAST(ts AS DATE) AS stay_day,
         min(ts) FILTER (WHERE event_type = 'signup') AS admitted_at,
         max(ts) FILTER (WHERE event_type = 'error') AS exit_at,
         COUNT(*) AS n_movements,
         COUNT(*) FILTER (WHERE event_type = 'view') AS n_transfers,
         max(value) FILTER (WHERE event_type = 'signup') AS admission_value,
         round((epoch_us(max(ts) FILTER (WHERE event_type = 'error'))
                - epoch_us(min(ts) FILTER (WHERE event_type = 'signup'))) / 60e6, 6) AS length_minutes,
         max(ts) FILTER (WHERE event_type = 'error') IS NULL AS is_open
  FROM events_typed WHERE ts IS NOT NULL
  GROUP BY user_id, CAST(ts AS DATE)
)"""
STAY_CTES = derived.EVENTS_CTES + [STAY_SQL]


@query("fct4_stays", sql=with_sql(*STAY_CTES) + "\nSELECT * FROM stay", ops=("FCT-4", "AG-10", "FN-5"))
def fct4_stays(spark, sf_dir):
    return stay_facts(Tables(spark, sf_dir))


@query(
    "dq24_stay_conservation",
    sql=with_sql(*STAY_CTES)
    + """
SELECT (SELECT CAST(SUM(n_movements) AS BIGINT) FROM stay) AS n_rolled_up,
       (SELECT COUNT(*) FROM events_typed WHERE ts IS NOT NULL) AS n_movements,
       (SELECT COUNT(*) FROM stay WHERE exit_at < admitted_at) AS n_exit_before_admission""",
    ops=("DQ-24", "DQ-18"),
)
def dq24_stay_conservation(spark, sf_dir):
    t = Tables(spark, sf_dir)
    stays = stay_facts(t)
    moves = derived.typed_events(t).filter(F.col("ts").isNotNull()).select(F.count(F.lit(1))).scalar()
    return stays.agg(
        F.sum("n_movements").cast("long").alias("n_rolled_up"),
        F.count_if(F.col("exit_at") < F.col("admitted_at")).alias("n_exit_before_admission"),
    ).withColumn("n_movements", moves)


# ------------------------------------------------------------------ FCT-3 emergency visits


def emergency_facts(t: Tables) -> DataFrame:
    """FCT-3: each event is an emergency visit; value = delay to care in minutes."""
    ev = derived.typed_events(t).filter(F.col("ts").isNotNull())
    v = F.col("value").cast("double")
    level = (
        F.when(v >= 400, "1").when(v >= 300, "2").when(v >= 200, "3").when(v >= 100, "4").when(v.isNotNull(), "5")
    )
    return ev.select(
        "event_id",
        "user_id",
        F.to_date("ts").alias("visit_day"),
        F.hour("ts").alias("arrival_hour"),
        level.alias("triage_level"),
        v.alias("delay_to_care_min"),
        F.col("event_type").alias("exit_orientation"),
    )


EMERGENCY_SQL = """
emergency AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS visit_day, CAST(hour(ts) AS INTEGER) AS arrival_hour,
         CASE WHEN CAST(value AS DOUBLE) >= 400 THEN '1' WHEN CAST(value AS DOUBLE) >= 300 THEN '2'
              WHEN CAST(value AS DOUBLE) >= 200 THEN '3' WHEN CAST(value AS DOUBLE) >= 100 THEN '4'
              WHEN value IS NOT NULL THEN '5' END AS triage_level,
         CAST(value AS DOUBLE) AS delay_to_care_min,
         event_type AS exit_orientation
  FROM events_typed WHERE ts IS NOT NULL
)"""
EMERGENCY_CTES = derived.EVENTS_CTES + [EMERGENCY_SQL]


@query("fct3_emergency_visits", sql=with_sql(*EMERGENCY_CTES) + "\nSELECT * FROM emergency", ops=("FCT-3", "FN-7"))
def fct3_emergency_visits(spark, sf_dir):
    return emergency_facts(Tables(spark, sf_dir))


@query(
    "mrt4_emergency_daily",
    sql=with_sql(*EMERGENCY_CTES)
    + """
SELECT visit_day, triage_level, COUNT(*) AS n_visits, COUNT(DISTINCT user_id) AS n_patients,
       round(quantile_cont(delay_to_care_min, 0.5), 6) AS median_delay_min,
       round(quantile_cont(delay_to_care_min, 0.9), 6) AS p90_delay_min,
       COUNT(*) FILTER (WHERE exit_orientation = 'purchase') AS n_admitted
FROM emergency GROUP BY visit_day, triage_level""",
    ops=("MRT-4", "AG-2", "AG-3", "AG-4"),
    layer="mart",
)
def mrt4_emergency_daily(spark, sf_dir):
    """Emergency visits by day and triage level."""
    e = emergency_facts(Tables(spark, sf_dir))
    return e.groupBy("visit_day", "triage_level").agg(
        F.count(F.lit(1)).alias("n_visits"),
        F.count_distinct("user_id").alias("n_patients"),
        _r(F.percentile("delay_to_care_min", 0.5)).alias("median_delay_min"),
        _r(F.percentile("delay_to_care_min", 0.9)).alias("p90_delay_min"),
        F.count_if(F.col("exit_orientation") == "purchase").alias("n_admitted"),
    )


# ------------------------------------------------------------------ MRT-1 daily activity (ST-1)


def activity_rows(t: Tables) -> DataFrame:
    """ST-1: union of the event streams with NULL padding of absent attributes."""
    od = derived.typed_orders(t).select(
        F.col("o_orderdate").alias("day"),
        F.lit("ORDER").alias("family"),
        F.col("o_orderpriority").alias("service"),
        F.col("o_custkey").alias("patient"),
    )
    li = derived.typed_lineitem(t).select(
        F.col("l_shipdate").alias("day"),
        concat_code("LINE_", "l_returnflag").alias("family"),
        F.lit(None).cast("string").alias("service"),
        F.lit(None).cast("string").alias("patient"),
    )
    ev = derived.typed_events(t).select(
        F.to_date("ts").alias("day"),
        concat_code("EVENT_", "event_type").alias("family"),
        F.lit(None).cast("string").alias("service"),
        F.col("user_id").alias("patient"),
    )
    return od.unionByName(li).unionByName(ev).filter(F.col("day").isNotNull())


ACTIVITY_SQL = """
activity AS (
  SELECT * FROM (
    SELECT o_orderdate AS day, 'ORDER' AS family, o_orderpriority AS service, o_custkey AS patient FROM orders_typed
    UNION ALL
    SELECT l_shipdate, 'LINE_' || l_returnflag, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM lineitem_typed
    UNION ALL
    SELECT CAST(ts AS DATE), 'EVENT_' || event_type, CAST(NULL AS VARCHAR), user_id FROM events_typed
  ) WHERE day IS NOT NULL
)"""
ACTIVITY_CTES = derived.LINEITEM_CTES + derived.ORDERS_CTES + derived.EVENTS_CTES + [ACTIVITY_SQL]


def daily_activity(t: Tables) -> DataFrame:
    return activity_rows(t).groupBy("day", "family", "service").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("patient").alias("n_patients")
    )


@query(
    "mrt1_daily_activity",
    sql=with_sql(*ACTIVITY_CTES)
    + """
SELECT day, family, service, COUNT(*) AS n_events, COUNT(DISTINCT patient) AS n_patients
FROM activity GROUP BY day, family, service""",
    ops=("MRT-1", "ST-1", "AG-3", "FN-14", "IN-1", "IN-2"),
    layer="mart",
)
def mrt1_daily_activity(spark, sf_dir):
    """Events and patients by day, family of activity and service."""
    return daily_activity(Tables(spark, sf_dir))


# ------------------------------------------------------------------ MRT-3 absence


def absence_mart(facts: DataFrame) -> DataFrame:
    """MRT-3: rates divide by ALL lines of the group, pending ones included."""
    honoured = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    absent = F.col("l_returnflag") == "R"
    cancelled = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")
    n = F.count(F.lit(1))
    return facts.groupBy("o_orderpriority").agg(
        n.alias("n_lines"),
        F.count_if(honoured).alias("n_honoured"),
        F.count_if(absent).alias("n_absent"),
        F.count_if(cancelled).alias("n_cancelled"),
        F.count_if(~honoured & ~absent & ~cancelled).alias("n_remaining"),
        _r(ratio(F.count_if(absent), n)).alias("absence_rate"),
        _r(ratio(F.count_if(cancelled), n)).alias("cancellation_rate"),
        _r(F.percentile(F.when(~F.col("same_day"), F.col("lead_days")), 0.5)).alias("median_lead_days"),
    )


ABSENCE_SQL = """
SELECT o_orderpriority, COUNT(*) AS n_lines,
       COUNT(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'F') AS n_honoured,
       COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_absent,
       COUNT(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'O') AS n_cancelled,
       COUNT(*) FILTER (WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F') AND NOT l_returnflag = 'R'
                        AND NOT (l_returnflag = 'A' AND l_linestatus = 'O')) AS n_remaining,
       round(COUNT(*) FILTER (WHERE l_returnflag = 'R')::DOUBLE / COUNT(*), 6) AS absence_rate,
       round(COUNT(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'O')::DOUBLE / COUNT(*), 6) AS cancellation_rate,
       round(quantile_cont(lead_days, 0.5) FILTER (WHERE NOT same_day), 6) AS median_lead_days
FROM lead_facts GROUP BY o_orderpriority"""


@query("mrt3_absence_by_priority", sql=with_sql(*LEAD_CTES) + ABSENCE_SQL, ops=("MRT-3", "AG-2", "AG-4", "FN-12", "IN-9", "IN-10"), layer="mart")
def mrt3_absence_by_priority(spark, sf_dir):
    """Honoured, absent and cancelled lines by priority, with their rates."""
    return absence_mart(mart_facts(spark, sf_dir))


@query(
    "dq28_aggregate_coherence",
    sql=with_sql(*ACTIVITY_CTES, *LEAD_CTES)
    + f""",
absence AS ({ABSENCE_SQL})
SELECT (SELECT CAST(SUM(n_events) AS BIGINT) FROM (SELECT day, family, service, COUNT(*) AS n_events
          FROM activity GROUP BY ALL) WHERE family = 'ORDER') AS n_order_events_mart,
       (SELECT COUNT(*) FROM orders_typed WHERE o_orderdate IS NOT NULL) AS n_order_events_fact,
       (SELECT CAST(SUM(n_lines) AS BIGINT) FROM absence) AS n_lines_mart,
       (SELECT CAST(SUM(n_honoured + n_absent + n_cancelled + n_remaining) AS BIGINT) FROM absence) AS n_lines_parts,
       (SELECT COUNT(*) FROM lead_facts) AS n_lines_fact""",
    ops=("DQ-28",),
)
def dq28_aggregate_coherence(spark, sf_dir):
    """Sums of a mart equal the counts of its fact; sub-counts add up to the total."""
    t = Tables(spark, sf_dir)
    act = daily_activity(t)
    facts = lead_time_facts(t)
    ab = absence_mart(facts)
    parts = F.col("n_honoured") + F.col("n_absent") + F.col("n_cancelled") + F.col("n_remaining")
    # both sums of the mart from one pass
    sums = ab.select(F.struct(F.sum("n_lines").cast("long").alias("lines"), F.sum(parts).cast("long").alias("parts"))).scalar()
    from wardline.operators.sets import measures_row

    return measures_row(
        spark,
        {
            "n_order_events_mart": act.filter(F.col("family") == "ORDER").select(F.sum("n_events").cast("long")).scalar(),
            "n_order_events_fact": derived.typed_orders(t).filter(F.col("o_orderdate").isNotNull()).select(F.count(F.lit(1))).scalar(),
            "n_lines_mart": sums["lines"],
            "n_lines_parts": sums["parts"],
            "n_lines_fact": facts.select(F.count(F.lit(1))).scalar(),
        },
    )


# ------------------------------------------------------------------ MRT-5 receivables (WN-2)


def receivables(t: Tables) -> DataFrame:
    """MRT-5 input: each order is a receivable; its lines are dated snapshots; the latest
    snapshot per receivable (max_by over a total order of the line, not a window)."""
    li = t.lineitem
    order_key = F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    snap = li.groupBy("l_orderkey").agg(
        F.max_by(
            F.struct(
                F.to_date("l_shipdate").alias("snapshot_day"),
                (_money(F.col("l_extendedprice")) * (1 - _money(F.col("l_discount")))).alias("recovered"),
                F.col("l_returnflag").alias("status"),
            ),
            order_key,
        ).alias("s"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_reminders"),
    )
    od = t.orders.select("o_orderkey", "o_custkey", _money(F.col("o_totalprice")).alias("due"))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("debtor_type"))
    j = od.join(snap, od["o_orderkey"] == snap["l_orderkey"], "left").join(cust, "o_custkey", "left")
    return j.select(
        "o_orderkey",
        "debtor_type",
        "due",
        F.col("s.snapshot_day").alias("snapshot_day"),
        F.coalesce(F.col("s.recovered"), F.lit(0).cast("decimal(38,4)")).alias("recovered"),
        F.col("s.status").alias("status"),
        F.coalesce(F.col("n_reminders"), F.lit(0)).alias("n_reminders"),
    )


RECEIVABLES_SQL = """
snap AS (
  SELECT l_orderkey,
         arg_max(CAST(l_shipdate AS DATE), (l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount)) AS snapshot_day,
         arg_max(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), (l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount)) AS recovered,
         arg_max(l_returnflag, (l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount)) AS status,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_reminders
  FROM lineitem GROUP BY l_orderkey
),
recv AS (
  SELECT o.o_orderkey, c.c_mktsegment AS debtor_type, CAST(o.o_totalprice AS DECIMAL(18,2)) AS due,
         s.snapshot_day, COALESCE(s.recovered, CAST(0 AS DECIMAL(38,4))) AS recovered, s.status,
         COALESCE(s.n_reminders, 0) AS n_reminders
  FROM orders o LEFT JOIN snap s ON o.o_orderkey = s.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""


@query(
    "mrt5_recovery_by_debtor",
    sql="WITH "
    + RECEIVABLES_SQL
    + """
SELECT debtor_type, COUNT(*) AS n_receivables, CAST(SUM(due) AS DECIMAL(18,2)) AS total_due,
       CAST(SUM(recovered) AS DECIMAL(18,2)) AS total_recovered,
       round(CAST(SUM(recovered) AS DOUBLE) / CAST(SUM(due) AS DOUBLE), 6) AS recovery_rate,
       COUNT(*) FILTER (WHERE n_reminders > 0) AS n_reminded,
       round(COUNT(*) FILTER (WHERE n_reminders > 0 AND status = 'N')::DOUBLE
             / NULLIF(COUNT(*) FILTER (WHERE n_reminders > 0), 0), 6) AS reminder_success_rate
FROM recv GROUP BY debtor_type""",
    ops=("MRT-5", "WN-2", "WN-3", "JN-1", "JN-2", "AG-12", "IN-27", "IN-30"),
    layer="mart",
)
def mrt5_recovery_by_debtor(spark, sf_dir):
    """Amounts due and recovered by kind of debtor."""
    r = receivables(Tables(spark, sf_dir))
    reminded = F.col("n_reminders") > 0
    return r.groupBy("debtor_type").agg(
        F.count(F.lit(1)).alias("n_receivables"),
        _money(F.sum("due")).alias("total_due"),
        _money(F.sum("recovered")).alias("total_recovered"),
        _r(ratio(F.sum("recovered"), F.sum("due"))).alias("recovery_rate"),
        F.count_if(reminded).alias("n_reminded"),
        _r(ratio(F.count_if(reminded & (F.col("status") == "N")), F.count_if(reminded))).alias("reminder_success_rate"),
    )


# ------------------------------------------------------------------ MRT-6 exact collisions

COLLISION_CRITERIA = {
    "part_name_brand_size": ("part", ["p_name", "p_brand", "p_size"]),
    "customer_nation_segment": ("customer", ["c_nationkey", "c_mktsegment"]),
    "supplier_nation": ("supplier", ["s_nationkey"]),
}


@query(
    "mrt6_exact_collisions",
    sql="\nUNION ALL\n".join(
        f"""SELECT '{name}' AS criterion, COUNT(*) AS n_groups, CAST(SUM(n) AS BIGINT) AS n_records,
       max(n) AS max_group_size, round(quantile_cont(n, 0.5), 6) AS median_group_size,
       CAST(SUM(n * (n - 1) / 2) AS BIGINT) AS n_pairs
FROM (SELECT {', '.join(cols)}, COUNT(*) AS n FROM {table} GROUP BY ALL HAVING COUNT(*) >= 2)"""
        for name, (table, cols) in COLLISION_CRITERIA.items()
    ),
    ops=("MRT-6", "AG-9", "AG-4", "IN-34", "LK-17"),
    layer="mart",
)
def mrt6_exact_collisions(spark, sf_dir):
    """Groups of identical values per criterion; pairs are counted, never listed."""
    t = Tables(spark, sf_dir)
    parts = []
    for name, (table, cols) in COLLISION_CRITERIA.items():
        g = collision_groups(getattr(t, table), cols)
        parts.append(
            g.agg(
                F.count(F.lit(1)).alias("n_groups"),
                F.sum("n").cast("long").alias("n_records"),
                F.max("n").alias("max_group_size"),
                _r(F.percentile("n", 0.5)).alias("median_group_size"),
                F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("n_pairs"),
            ).withColumn("criterion", F.lit(name))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ MRT-7 completeness


def completeness(t: Tables) -> DataFrame:
    """MRT-7: per landing column, blank-or-NULL count in ONE pass per table (conditional
    counts, then unpivot), with the table's quarantine rate repeated on each column."""
    parts = []
    for spec, build, _ in SPECS:
        rows = Q.check_rows(build(t), spec, "path_date")
        aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size(Q.REASONS) > 0).alias("_rej")]
        aggs += [F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(f"m_{c}") for c in spec.names]
        wide = rows.agg(*aggs)
        long = wide.unpivot(["n_rows", "_rej"], [f"m_{c}" for c in spec.names], "column_name", "n_missing")
        parts.append(
            long.select(
                F.lit(spec.name).alias("table_name"),
                F.regexp_replace("column_name", "^m_", "").alias("column_name"),
                "n_rows",
                F.col("n_missing").cast("long").alias("n_missing"),
                _r(1 - ratio("n_missing", "n_rows")).alias("completeness"),
                _r(ratio("_rej", "n_rows")).alias("quarantine_rate"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _completeness_sql() -> str:
    ctes, selects = [], []
    for spec, _, land in SPECS:
        ctes.append(land)
        ctes.append(sqlgen.checked_cte(spec, spec.name, spec.name + "_chk"))
        for c in spec.names:
            selects.append(
                f"SELECT '{spec.name}' AS table_name, '{c}' AS column_name, COUNT(*) AS n_rows, "
                f"COUNT(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS n_missing, "
                f"round(1 - (COUNT(*) FILTER (WHERE {c} IS NULL OR {c} = ''))::DOUBLE / COUNT(*), 6) AS completeness, "
                f"round((COUNT(*) FILTER (WHERE reasons <> ''))::DOUBLE / COUNT(*), 6) AS quarantine_rate "
                f"FROM {spec.name}_chk"
            )
    return with_sql(*ctes) + "\n" + "\nUNION ALL\n".join(selects)


@query("mrt7_completeness", sql=_completeness_sql(), ops=("MRT-7", "JN-15", "IN-32", "IN-33"), layer="mart")
def mrt7_completeness(spark, sf_dir):
    """Share of filled values by table and column, with the share of rows in quarantine."""
    return completeness(Tables(spark, sf_dir))


# ------------------------------------------------------------------ DQ-28 coherence of the other marts


def _mart_sql(name: str) -> str:
    from wardline.plans.catalog import registered

    return registered(name).sql


MART_RULES = ("mrt4_visits", "mrt4_admitted_within", "mrt5_receivables", "mrt5_due", "mrt5_reminded_within", "mrt6_records_within", "mrt7_in_bounds")


def _coherence_sql() -> str:
    mart = {n: f"({_mart_sql(full)})" for n, full in (("m4", "mrt4_emergency_daily"), ("m5", "mrt5_recovery_by_debtor"), ("m6", "mrt6_exact_collisions"), ("m7", "mrt7_completeness"))}
    facts = with_sql(*EMERGENCY_CTES)
    measured = {
        "mrt4_visits": (f"SELECT SUM(n_visits) FROM {mart['m4']}", f"SELECT COUNT(*) FROM ({facts} SELECT * FROM emergency)"),
        "mrt4_admitted_within": (f"SELECT COUNT(*) FROM {mart['m4']} WHERE n_admitted > n_visits OR n_patients > n_visits", "SELECT 0"),
        "mrt5_receivables": (f"SELECT SUM(n_receivables) FROM {mart['m5']}", "SELECT COUNT(*) FROM orders"),
        "mrt5_due": (f"SELECT SUM(total_due) FROM {mart['m5']}", "SELECT SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders"),
        "mrt5_reminded_within": (f"SELECT COUNT(*) FROM {mart['m5']} WHERE n_reminded > n_receivables", "SELECT 0"),
        "mrt6_records_within": (f"SELECT COUNT(*) FROM {mart['m6']} WHERE n_records < 2 * n_groups OR max_group_size > n_records", "SELECT 0"),
        "mrt7_in_bounds": (f"SELECT COUNT(*) FROM {mart['m7']} WHERE completeness NOT BETWEEN 0 AND 1 OR n_missing > n_rows", "SELECT 0"),
    }
    rows = [f"SELECT '{n}' AS rule, CAST(({measured[n][0]}) AS DOUBLE) AS measured, CAST(({measured[n][1]}) AS DOUBLE) AS expected" for n in MART_RULES]
    return "SELECT *, measured = expected AS holds FROM (" + "\nUNION ALL\n".join(rows) + ")"


def dq28_mart_coherence(spark, sf_dir):
    """The emergency, recovery, collision and completeness marts against their facts: sums
    equal the facts' counts, parts stay within their wholes, shares within bounds."""
    t = Tables(spark, sf_dir)
    m4, m5, m6, m7 = mrt4_emergency_daily(spark, sf_dir), mrt5_recovery_by_debtor(spark, sf_dir), mrt6_exact_collisions(spark, sf_dir), completeness(t)
    # one row of both mart measures each, so every mart is made once
    one = lambda df, *cols: df.select(F.struct(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(cols)])).scalar()
    s4 = one(m4, F.sum("n_visits"), F.count_if((F.col("n_admitted") > F.col("n_visits")) | (F.col("n_patients") > F.col("n_visits"))))
    s5 = one(m5, F.sum("n_receivables"), F.sum("total_due"), F.count_if(F.col("n_reminded") > F.col("n_receivables")))
    s6 = one(m6, F.count_if((F.col("n_records") < 2 * F.col("n_groups")) | (F.col("max_group_size") > F.col("n_records"))))
    s7 = one(m7, F.count_if(~F.col("completeness").between(0, 1) | (F.col("n_missing") > F.col("n_rows"))))
    orders = one(t.orders, F.count(F.lit(1)), F.sum(_money(F.col("o_totalprice"))))
    visits = one(emergency_facts(t), F.count(F.lit(1)))
    zero = F.lit(0.0)
    pairs = dict(
        zip(MART_RULES, [(s4["c0"], visits["c0"]), (s4["c1"], zero), (s5["c0"], orders["c0"]), (s5["c1"], orders["c1"]), (s5["c2"], zero), (s6["c0"], zero), (s7["c0"], zero)])
    )
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), a.alias("measured"), b.alias("expected")) for n, (a, b) in pairs.items()])
    return spark.range(1).select(F.inline(rows)).withColumn("holds", F.col("measured") == F.col("expected"))


query("dq28_mart_coherence", sql=_coherence_sql(), ops=("DQ-28",))(dq28_mart_coherence)
