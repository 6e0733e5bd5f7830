"""Dimensions: calendar (DIM-2), code sets (DIM-3..6), labels (FN-23) and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.conversions import iso_weekday, is_weekend
from wardline.operators.sets import code_set, measures_row, two_way_difference
from wardline.plans.catalog import query
from wardline.sources.calendar import MOVABLE, calendar_days, calendar_sql
from wardline.sources.tables import Tables

KNOWN_YEARS = [y for y, *_ in MOVABLE]  # years whose movable observances the rules know

# ---- fixed values: documented code labels (label register) ------------------
LABELS = [
    ("order_status", "F", "fulfilled"),
    ("order_status", "O", "open"),
    ("order_status", "P", "partly shipped"),
    ("order_status", "C", "cancelled"),
    ("line_status", "F", "fulfilled"),
    ("line_status", "O", "open"),
    ("return_flag", "A", "accepted"),
    ("return_flag", "N", "not returned"),
    ("return_flag", "R", "returned"),
]
# -----------------------------------------------------------------------------

CODE_COLUMNS = {
    "orders": [("order_status", "o_orderstatus"), ("order_priority", "o_orderpriority")],
    "lineitem": [("return_flag", "l_returnflag"), ("line_status", "l_linestatus")],
    "customer": [("market_segment", "c_mktsegment")],
    "part": [("part_type", "p_type"), ("part_brand", "p_brand")],
}


def data_years(bounds: DataFrame) -> DataFrame:
    """Every year from the first to the last data day (``lo``, ``hi``)."""
    return bounds.select(F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year"))


def date_dimension(t: Tables) -> DataFrame:
    """DIM-2: one row per day between the first and last data day (orders, events)."""
    spark = t.spark
    days = t.orders.select(F.to_date("o_orderdate").alias("d")).unionByName(t.events.select(F.to_date("ts").alias("d")))
    bounds = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))  # one row
    spine = bounds.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    cal = calendar_days(spark, data_years(bounds))
    holidays = (
        cal.filter(F.col("category") != "ramadan")
        .groupBy("day")
        .agg(F.array_join(F.array_sort(F.collect_list("label")), ",").alias("holiday_labels"))
    )
    ramadan = cal.filter(F.col("category") == "ramadan")
    starts = ramadan.groupBy(F.year("day").alias("_y")).agg(F.min("day").alias("_start"))
    ramadan = ramadan.join(starts, F.year("day") == F.col("_y")).select(
        F.col("day").alias("_rday"), (F.datediff("day", "_start") + 1).alias("ramadan_day")
    )
    out = spine.join(holidays, "day", "left").join(ramadan, F.col("day") == F.col("_rday"), "left")
    return out.select(
        "day",
        "holiday_labels",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        iso_weekday("day").alias("iso_weekday"),
        is_weekend("day").alias("is_weekend"),
        F.col("holiday_labels").isNotNull().alias("is_holiday"),
        # unknown (NULL) in a year without a movable rule
        F.when(F.year("day").isin(KNOWN_YEARS), F.col("_rday").isNotNull()).alias("is_ramadan"),
        "ramadan_day",
    )


def date_dimension_sql() -> str:
    return f"""
bounds AS (
  SELECT min(d) AS lo, max(d) AS hi
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(ts AS DATE) FROM events)
),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds),
cal AS (SELECT * FROM {calendar_sql("(SELECT year(lo) FROM bounds)", "(SELECT year(hi) FROM bounds)")}),
hol AS (SELECT day, string_agg(label, ',' ORDER BY label) AS holiday_labels
        FROM cal WHERE category <> 'ramadan' GROUP BY day),
ram AS (SELECT day, CAST(datediff('day', min(day) OVER (PARTITION BY year(day)), day) + 1 AS INTEGER) AS ramadan_day
        FROM cal WHERE category = 'ramadan'),
dim_date AS (
  SELECT s.day, h.holiday_labels,
         CAST(year(s.day) AS INTEGER) AS year, CAST(quarter(s.day) AS INTEGER) AS quarter,
         CAST(month(s.day) AS INTEGER) AS month, CAST(day(s.day) AS INTEGER) AS day_of_month,
         CAST(isodow(s.day) AS INTEGER) AS iso_weekday, isodow(s.day) IN (6, 7) AS is_weekend,
         h.day IS NOT NULL AS is_holiday,
         CASE WHEN year(s.day) IN ({', '.join(map(str, KNOWN_YEARS))}) THEN r.day IS NOT NULL END AS is_ramadan, r.ramadan_day
  FROM spine s LEFT JOIN hol h ON s.day = h.day LEFT JOIN ram r ON s.day = r.day
)"""


@query("dim2_date", sql="WITH " + date_dimension_sql() + "\nSELECT * FROM dim_date", ops=("DIM-2", "GEN-1", "GEN-2", "GEN-3", "FN-6", "AG-7", "JN-11", "SRC-6"), layer="dimension")
def dim2_date(spark, sf_dir):
    """Calendar, one row per day, with holidays and Ramadan."""
    return date_dimension(Tables(spark, sf_dir))


@query(
    "dq27_calendar_checks",
    sql="WITH "
    + date_dimension_sql()
    + """
SELECT (SELECT COUNT(*) FROM dim_date) AS n_days,
       (SELECT datediff('day', min(day), max(day)) + 1 FROM dim_date) AS n_expected_days,
       (SELECT COUNT(*) FROM (SELECT day FROM cal WHERE category <> 'ramadan'
                               AND day BETWEEN (SELECT lo FROM bounds) AND (SELECT hi FROM bounds)
                             EXCEPT SELECT day FROM dim_date WHERE is_holiday)) AS n_holidays_missing,
       (SELECT COUNT(*) FROM (SELECT day FROM dim_date WHERE is_holiday
                             EXCEPT SELECT day FROM cal WHERE category <> 'ramadan')) AS n_holidays_extra,
       (SELECT COUNT(*) FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(ts AS DATE) FROM events
                             UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem) x
         WHERE d NOT IN (SELECT day FROM dim_date)) AS n_event_days_uncovered""",
    ops=("DQ-27", "ST-3"),
)
def dq27_calendar_checks(spark, sf_dir):
    """Calendar: no gap, holiday set equal to the seed inside the span, every event day covered."""
    t = Tables(spark, sf_dir)
    dim = date_dimension(t)
    span = dim.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    seed_hol = (
        calendar_days(spark, data_years(span))
        .filter(F.col("category") != "ramadan")
        .select("day")
        .distinct()
    )
    seed_in_span = seed_hol.join(span, F.col("day").between(F.col("lo"), F.col("hi"))).select("day")
    flagged = dim.filter("is_holiday").select("day")
    event_days = (
        t.orders.select(F.to_date("o_orderdate").alias("day"))
        .unionByName(t.events.select(F.to_date("ts").alias("day")))
        .unionByName(t.lineitem.select(F.to_date("l_shipdate").alias("day")))
        .distinct()
    )
    m = two_way_difference(seed_in_span, flagged, ["day"])
    uncovered = event_days.join(dim.select("day"), "day", "left_anti")
    return measures_row(
        spark,
        {
            "n_days": dim.select(F.count(F.lit(1))).scalar(),
            "n_expected_days": dim.select((F.datediff(F.max("day"), F.min("day")) + 1).cast("long")).scalar(),
            "n_holidays_missing": m.select("n_left_only").scalar(),
            "n_holidays_extra": m.select("n_right_only").scalar(),
            "n_event_days_uncovered": uncovered.select(F.count(F.lit(1))).scalar(),
        },
    )


def data_codes(t: Tables) -> DataFrame:
    """DIM-3..6 (ST-2): distinct (code_type, code) over all coded columns, one scan per table."""
    parts = [code_set(getattr(t, table), cols) for table, cols in CODE_COLUMNS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def _codes_sql() -> str:
    parts = []
    for table, cols in CODE_COLUMNS.items():
        for ctype, col in cols:
            parts.append(f"SELECT '{ctype}' AS code_type, {col} AS code FROM {table} WHERE {col} IS NOT NULL")
    return "codes AS (" + "\nUNION\n".join(parts) + ")"


def _labels_sql() -> str:
    body = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in LABELS)
    return f"labels AS (SELECT * FROM (VALUES {body}) AS l(code_type, code, label))"


def labels_df(spark) -> DataFrame:
    return spark.createDataFrame(LABELS, "code_type string, code string, label string")


@query(
    "dim_codes_labelled",
    sql="WITH "
    + _codes_sql()
    + ",\n"
    + _labels_sql()
    + """
SELECT c.code_type, c.code, l.label IS NOT NULL AS is_documented,
       CASE WHEN l.label IS NOT NULL THEN c.code || ' - ' || l.label ELSE c.code END AS display
FROM codes c LEFT JOIN labels l ON c.code_type = l.code_type AND c.code = l.code""",
    ops=("DIM-3", "DIM-4", "DIM-5", "DIM-6", "ST-2", "AG-11", "FN-23"),
    layer="dimension",
)
def dim_codes_labelled(spark, sf_dir):
    """Every code of the data with its label, or the code itself where it has none."""
    codes = data_codes(Tables(spark, sf_dir))
    labels = F.broadcast(labels_df(spark))  # fixed register, a few rows
    j = codes.join(labels, ["code_type", "code"], "left")
    return j.select(
        "code_type",
        "code",
        F.col("label").isNotNull().alias("is_documented"),
        F.when(F.col("label").isNotNull(), F.concat_ws(" - ", "code", "label")).otherwise(F.col("code")).alias("display"),
    )


@query(
    "dq40_label_register",
    sql="WITH "
    + _codes_sql()
    + ",\n"
    + _labels_sql()
    + """
SELECT COALESCE(c.code_type, l.code_type) AS code_type, COALESCE(c.code, l.code) AS code,
       CASE WHEN c.code IS NULL THEN 'label_unused' ELSE 'code_undocumented' END AS finding
FROM (SELECT * FROM codes WHERE code_type IN (SELECT code_type FROM labels)) c
FULL OUTER JOIN labels l ON c.code_type = l.code_type AND c.code = l.code
WHERE c.code IS NULL OR l.code IS NULL""",
    ops=("DQ-40", "DQ-34", "JN-9"),
)
def dq40_label_register(spark, sf_dir):
    """Label register vs codes present in the data, both ways, for documented code types."""
    labels = labels_df(spark)
    documented_types = labels.select("code_type").distinct()
    codes = data_codes(Tables(spark, sf_dir)).join(F.broadcast(documented_types), "code_type", "left_semi")
    j = codes.withColumn("_in_data", F.lit(True)).join(
        labels.withColumn("_in_register", F.lit(True)), ["code_type", "code"], "full_outer"
    )
    return j.filter(F.col("_in_data").isNull() | F.col("_in_register").isNull()).select(
        "code_type",
        "code",
        F.when(F.col("_in_data").isNull(), F.lit("label_unused")).otherwise(F.lit("code_undocumented")).alias("finding"),
    )
