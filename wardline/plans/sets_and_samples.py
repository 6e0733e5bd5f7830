"""Joins, set operations, sampling, allocation, listing and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions.conversions import decimal_year, distinct_from, iso_weekday, is_weekend, minutes_between, ratio
from wardline.operators.aggregates import mode
from wardline.operators.sampling import largest_remainder, systematic_sample
from wardline.operators.sets import measures_row
from wardline.plans import derived
from wardline.plans.catalog import query
from wardline.plans.landing import with_sql
from wardline.sources.tables import Tables

SAMPLE_SIZE = 100
NOTICE = "systematic sample: not for unit-level decisions"


@query(
    "smp1_systematic_sample",
    sql=f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS rk, COUNT(*) OVER () AS total FROM customer),
s AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM r
  WHERE (rk - 1) % greatest(total // {SAMPLE_SIZE}, 1) = 0 AND (rk - 1) // greatest(total // {SAMPLE_SIZE}, 1) < {SAMPLE_SIZE}
  UNION
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0
)
SELECT *, '{NOTICE}' AS notice FROM s""",
    ops=("SMP-1", "SNK-14"),
)
def smp1_systematic_sample(spark, sf_dir):
    """1-in-k customers by key plus the forced ones (negative balance), stamped."""
    c = Tables(spark, sf_dir).customer
    forced = c.filter(F.col("c_acctbal") < 0).select("c_custkey")
    base = c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return systematic_sample(base, "c_custkey", SAMPLE_SIZE, forced, NOTICE)


LISTING_FILTER = "o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"
DISPLAY_CAP = 1000


@query(
    "so3_filtered_listing",
    sql=f"""
WITH f AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice FROM orders WHERE {LISTING_FILTER})
SELECT *, (SELECT COUNT(*) FROM f) AS full_count FROM f ORDER BY o_orderkey LIMIT {DISPLAY_CAP}""",
    ops=("SO-3", "FLT-1", "FLT-3", "IN-40", "SNK-13", "SO-1"),
)
def so3_filtered_listing(spark, sf_dir):
    """Period + code-list filter; the display shows the first 1000 rows by key and the
    full count (the export path writes every filtered row, see sinks.export)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    f = o.filter(F.expr(LISTING_FILTER))
    return f.orderBy("o_orderkey").limit(DISPLAY_CAP).withColumn("full_count", f.select(F.count(F.lit(1))).scalar())


@query(
    "gen4_largest_remainder_allocation",
    sql="""
WITH w AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(l_shipdate AS DATE) AS day, COUNT(*) AS weight
           FROM lineitem GROUP BY ALL),
t AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS total FROM orders GROUP BY 1),
j AS (SELECT w.*, t.total, t.total * w.weight / SUM(w.weight) OVER (PARTITION BY w.month) AS ex FROM w JOIN t ON w.month = t.month),
f AS (SELECT *, floor(ex) AS fl, total - SUM(floor(ex)) OVER (PARTITION BY month) AS lft,
             row_number() OVER (PARTITION BY month ORDER BY ex - floor(ex) DESC, day) AS rk FROM j)
SELECT month, day, weight, total, CAST(fl + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS BIGINT) AS allocated FROM f""",
    ops=("GEN-4",),
)
def gen4_largest_remainder_allocation(spark, sf_dir):
    """Each month's order count spread over that month's days by shipping volume."""
    t = Tables(spark, sf_dir)
    w = t.lineitem.groupBy(F.trunc(F.to_date("l_shipdate"), "MM").alias("month"), F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("weight")
    )
    tot = t.orders.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(F.count(F.lit(1)).alias("total"))
    return largest_remainder(w.join(tot, "month"), ["month"], "day", "weight", "total")


@query(
    "ag13_mode_segment_by_nation",
    sql="""
SELECT c_nationkey, c_mktsegment, n FROM (
  SELECT c_nationkey, c_mktsegment, COUNT(*) AS n,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY COUNT(*) DESC, c_mktsegment) AS rk
  FROM customer GROUP BY c_nationkey, c_mktsegment) WHERE rk = 1""",
    ops=("AG-13",),
)
def ag13_mode_segment_by_nation(spark, sf_dir):
    return mode(Tables(spark, sf_dir).customer, "c_mktsegment", ["c_nationkey"])


@query(
    "jn9_pair_sets_three_way",
    sql="""
WITH a AS (SELECT SUM(n * (n - 1) / 2) AS c FROM (SELECT COUNT(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment)),
     b AS (SELECT SUM(n * (n - 1) / 2) AS c FROM (SELECT COUNT(*) AS n FROM customer GROUP BY c_nationkey, floor(c_acctbal / 1000))),
     ab AS (SELECT SUM(n * (n - 1) / 2) AS c FROM (SELECT COUNT(*) AS n FROM customer
                                                 GROUP BY c_nationkey, c_mktsegment, floor(c_acctbal / 1000)))
SELECT CAST((SELECT c FROM a) AS BIGINT) AS n_pairs_a, CAST((SELECT c FROM b) AS BIGINT) AS n_pairs_b,
       CAST((SELECT c FROM ab) AS BIGINT) AS n_pairs_both,
       CAST((SELECT c FROM a) - (SELECT c FROM ab) AS BIGINT) AS n_pairs_a_only,
       CAST((SELECT c FROM b) - (SELECT c FROM ab) AS BIGINT) AS n_pairs_b_only""",
    ops=("JN-9", "JN-10", "IN-38", "ST-4"),
)
def jn9_pair_sets_three_way(spark, sf_dir):
    """Two pair sets (same nation+segment; same nation+balance band) compared three ways.

    A pair is in both sets iff it shares the union of both key sets, so every count
    is a sum of n(n-1)/2 over groups: no pair is ever formed.
    """
    c = Tables(spark, sf_dir).customer.withColumn("band", F.floor(F.col("c_acctbal") / 1000))

    def pairs(keys):
        return c.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(F.sum(F.col("n") * (F.col("n") - 1) / 2)).scalar()

    a, b, ab = pairs(["c_nationkey", "c_mktsegment"]), pairs(["c_nationkey", "band"]), pairs(["c_nationkey", "c_mktsegment", "band"])
    return measures_row(
        spark,
        {
            "n_pairs_a": a.cast("long"),
            "n_pairs_b": b.cast("long"),
            "n_pairs_both": ab.cast("long"),
            "n_pairs_a_only": (a - ab).cast("long"),
            "n_pairs_b_only": (b - ab).cast("long"),
        },
    )


@query(
    "jn7_exists_not_exists",
    sql=with_sql(*derived.ORDERS_CTES)
    + """
SELECT (SELECT COUNT(*) FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)) AS n_with_orders,
       (SELECT COUNT(*) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)) AS n_without_orders,
       (SELECT COUNT(*) FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'F') AS n_honoured,
       (SELECT COUNT(*) FROM lineitem l WHERE l_returnflag = 'N' AND l_linestatus = 'F' AND EXISTS (
          SELECT 1 FROM orders_typed t WHERE t.o_orderkey = CAST(l.l_orderkey AS VARCHAR)
            AND t.o_orderdate IS NOT NULL AND t.o_totalprice IS NOT NULL)) AS n_honoured_clean_record""",
    ops=("JN-7", "IN-55", "ST-4"),
)
def jn7_exists_not_exists(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c, o = t.customer, t.orders.select(F.col("o_custkey").alias("c_custkey"))
    honoured = t.lineitem.filter((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))
    clean = (
        derived.typed_orders(t)
        .filter(F.col("o_orderdate").isNotNull() & F.col("o_totalprice").isNotNull())
        .select(F.col("o_orderkey").alias("_k"))
    )
    h = honoured.withColumn("_k", F.col("l_orderkey").cast("string"))
    return measures_row(
        spark,
        {
            "n_with_orders": c.join(o, "c_custkey", "left_semi").select(F.count(F.lit(1))).scalar(),
            "n_without_orders": c.join(o, "c_custkey", "left_anti").select(F.count(F.lit(1))).scalar(),
            "n_honoured": honoured.select(F.count(F.lit(1))).scalar(),
            "n_honoured_clean_record": h.join(clean, "_k", "left_semi").select(F.count(F.lit(1))).scalar(),
        },
    )


@query(
    "fn_scalar_functions",
    sql="""
SELECT event_id, CAST(ts AS DATE) AS day,
       (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 60e6 AS minutes_into_day,
       CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day_of_month, CAST(isodow(ts) AS INTEGER) AS iso_weekday, isodow(ts) IN (6, 7) AS is_weekend,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(date_trunc('month', ts) AS DATE) AS month_start,
       round(year(ts) + (month(ts) - 1) / 12.0, 6) AS decimal_year,
       CASE WHEN value BETWEEN 0 AND 100 THEN 'low' WHEN value IN (100.5, 200.5) THEN 'edge' ELSE 'high' END AS value_band,
       COALESCE(NULLIF(event_type, 'view'), 'page_view') AS kind,
       value IS DISTINCT FROM round(value) AS has_cents,
       round(value / NULLIF(user_id % 7, 0), 6) AS per_bucket,
       round(abs(value - 100), 6) AS dist_100, round(ln(value), 6) AS log_value, greatest(value, 10.0) AS floor_10,
       user_id // 10 AS user_decade, user_id % 10 AS user_unit,
       'EVENT_' || event_type AS family,
       CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS prop_k,
       abs(datediff('day', CAST(ts AS DATE), (SELECT min(CAST(ts AS DATE)) FROM events))) <= 14 AS first_two_weeks
FROM events""",
    ops=("FN-3", "FN-5", "FN-6", "FN-7", "FN-8", "FN-9", "FN-10", "FN-11", "FN-12", "FN-13", "FN-14", "FN-15", "FN-21"),
)
def fn_scalar_functions(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    ts = F.col("ts")
    v = F.col("value")
    first_day = e.select(F.min(F.to_date("ts"))).scalar()
    return e.select(
        "event_id",
        F.to_date(ts).alias("day"),
        minutes_between(ts, F.date_trunc("day", ts)).alias("minutes_into_day"),  # one IEEE division: not rounded
        F.year(ts).alias("year"),
        F.quarter(ts).alias("quarter"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day_of_month"),
        iso_weekday(ts).alias("iso_weekday"),
        is_weekend(ts).alias("is_weekend"),
        F.hour(ts).alias("hour"),
        F.trunc(F.to_date(ts), "MM").alias("month_start"),
        decimal_year(ts).alias("decimal_year"),
        F.when(v.between(0, 100), "low").when(v.isin(100.5, 200.5), "edge").otherwise("high").alias("value_band"),
        F.coalesce(F.nullif(F.col("event_type"), F.lit("view")), F.lit("page_view")).alias("kind"),
        distinct_from(v, F.round(v)).alias("has_cents"),
        F.round(ratio(v, F.nullif(F.col("user_id") % 7, F.lit(0))), 6).alias("per_bucket"),
        F.round(F.abs(v - 100), 6).alias("dist_100"),
        F.round(F.ln(v), 6).alias("log_value"),
        F.greatest(v, F.lit(10.0)).alias("floor_10"),
        F.expr("user_id div 10").alias("user_decade"),
        (F.col("user_id") % 10).alias("user_unit"),
        F.concat(F.lit("EVENT_"), F.col("event_type")).alias("family"),
        F.regexp_extract("props", r'"k": ([0-9]+)', 1).cast("int").alias("prop_k"),
        (F.abs(F.datediff(F.to_date(ts), first_day)) <= 14).alias("first_two_weeks"),
    )
