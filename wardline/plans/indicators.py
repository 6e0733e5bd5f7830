"""Indicator queries (IN-*): dashboard measures and figure series on the facts.

Scale notes: shares divide by a scalar-subquery total (no ``over ()`` window);
zero cells come from exploding a bounded spine (weekdays, hours, grid) per
distinct family rather than a cross join; cumulative curves are computed on
histograms whose size is bounded by the grid, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.conversions import bucket_label, elapsed_days, iso_weekday, ratio
from wardline.operators.aggregates import with_share
from wardline.operators.sets import measures_row
from wardline.plans import derived
from wardline.plans.catalog import query
from wardline.plans.dimensions import date_dimension, date_dimension_sql
from wardline.plans.landing import with_sql
from wardline.plans.marts import (
    EMERGENCY_CTES,
    _completeness_sql,
    INVOICE_CTES,
    RECEIVABLES_SQL,
    STAY_CTES,
    completeness,
    emergency_facts,
    invoice_facts,
    receivables,
    stay_facts,
)
from wardline.sources.tables import Tables

BEDS = 25  # fixed parameter: bed capacity used by the occupancy indicators


def _r(c, n=6):
    return F.round(c, n)


# ------------------------------------------------------------------ appointments


def appointments(t: Tables) -> DataFrame:
    li = derived.typed_lineitem(t).select("l_orderkey", "l_shipdate", "l_returnflag", "l_linestatus")
    od = derived.typed_orders(t).select("o_orderkey", "o_orderdate", "o_orderpriority")
    a = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    lead = F.datediff("l_shipdate", "o_orderdate")
    return a.select(
        "o_orderpriority",
        lead.alias("lead_days"),
        (lead == 0).alias("same_day"),
        ((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")).alias("honoured"),
        (F.col("l_returnflag") == "R").alias("absent"),
    )


APPT_SQL = """
appt AS (
  SELECT o.o_orderpriority, CAST(datediff('day', o.o_orderdate, l.l_shipdate) AS INTEGER) AS lead_days,
         datediff('day', o.o_orderdate, l.l_shipdate) = 0 AS same_day,
         l.l_returnflag = 'N' AND l.l_linestatus = 'F' AS honoured,
         l.l_returnflag = 'R' AS absent
  FROM lineitem_typed l JOIN orders_typed o ON l.l_orderkey = o.o_orderkey
)"""
APPT_CTES = derived.LINEITEM_CTES + derived.ORDERS_CTES + [APPT_SQL]


@query(
    "in7_lead_time_positive",
    sql=with_sql(*APPT_CTES)
    + """
SELECT o_orderpriority,
       round(quantile_cont(lead_days, 0.5) FILTER (WHERE lead_days > 0), 6) AS median_lead_days,
       round(quantile_cont(lead_days, 0.9) FILTER (WHERE lead_days > 0), 6) AS p90_lead_days,
       round(COUNT(*) FILTER (WHERE same_day)::DOUBLE / COUNT(*), 6) AS same_day_share
FROM appt GROUP BY o_orderpriority""",
    ops=("IN-7", "IN-8", "AG-4"),
)
def in7_lead_time_positive(spark, sf_dir):
    """Lead statistics on strictly positive leads (differs from MRT-2 on negative leads)."""
    a = appointments(Tables(spark, sf_dir))
    pos = F.when(F.col("lead_days") > 0, F.col("lead_days"))
    return a.groupBy("o_orderpriority").agg(
        _r(F.percentile(pos, 0.5)).alias("median_lead_days"),
        _r(F.percentile(pos, 0.9)).alias("p90_lead_days"),
        _r(ratio(F.count_if("same_day"), F.count(F.lit(1)))).alias("same_day_share"),
    )


@query(
    "in12_medians_absent_vs_honoured",
    sql=with_sql(*APPT_CTES)
    + """
SELECT o_orderpriority,
       round(quantile_cont(lead_days, 0.5) FILTER (WHERE absent AND NOT same_day), 6) AS median_lead_absent,
       round(quantile_cont(lead_days, 0.5) FILTER (WHERE honoured AND NOT same_day), 6) AS median_lead_honoured
FROM appt GROUP BY o_orderpriority""",
    ops=("IN-12", "AG-4"),
)
def in12_medians_absent_vs_honoured(spark, sf_dir):
    a = appointments(Tables(spark, sf_dir))
    lead = F.col("lead_days")
    return a.groupBy("o_orderpriority").agg(
        _r(F.percentile(F.when(F.col("absent") & ~F.col("same_day"), lead), 0.5)).alias("median_lead_absent"),
        _r(F.percentile(F.when(F.col("honoured") & ~F.col("same_day"), lead), 0.5)).alias("median_lead_honoured"),
    )


@query(
    "in11_lead_absence_correlations",
    sql=with_sql(*APPT_CTES)
    + """,
per AS (SELECT o_orderpriority,
               quantile_cont(lead_days, 0.5) FILTER (WHERE NOT same_day) AS med,
               COUNT(*) FILTER (WHERE absent)::DOUBLE / COUNT(*) AS rate,
               avg(lead_days) AS mean_lead
        FROM appt GROUP BY o_orderpriority)
SELECT (SELECT round(corr(med, rate), 6) FROM per) AS corr_between_groups,
       (SELECT round(corr(a.lead_days - p.mean_lead, CASE WHEN a.absent THEN 1.0 ELSE 0.0 END), 6)
          FROM appt a JOIN per p ON a.o_orderpriority = p.o_orderpriority) AS corr_within_centred,
       (SELECT round(corr(lead_days, CASE WHEN absent THEN 1.0 ELSE 0.0 END), 6) FROM appt) AS corr_raw""",
    ops=("IN-11", "IN-13", "AG-6", "JN-16", "WN-5", "WN-6", "JN-14"),
)
def in11_lead_absence_correlations(spark, sf_dir):
    """Between-group correlation of medians, within-group centred and raw correlation.

    Centring joins each row to its group's mean (a grouped aggregate), not a
    window over the group, so a dominant group is not pulled into one task.
    """
    a = appointments(Tables(spark, sf_dir))
    per = a.groupBy("o_orderpriority").agg(
        F.percentile(F.when(~F.col("same_day"), F.col("lead_days")), 0.5).alias("med"),
        ratio(F.count_if("absent"), F.count(F.lit(1))).alias("rate"),
        F.avg("lead_days").alias("mean_lead"),
    )
    absent = F.when(F.col("absent"), F.lit(1.0)).otherwise(F.lit(0.0))
    centred = a.join(per.select("o_orderpriority", "mean_lead"), "o_orderpriority")
    return measures_row(
        spark,
        {
            "corr_between_groups": per.select(_r(F.corr("med", "rate"))).scalar(),
            "corr_within_centred": centred.select(_r(F.corr(F.col("lead_days") - F.col("mean_lead"), absent))).scalar(),
            "corr_raw": a.select(_r(F.corr(F.col("lead_days").cast("double"), absent))).scalar(),
        },
    )


# ------------------------------------------------------------------ activity profiles


def _event_days(t: Tables) -> DataFrame:
    return derived.typed_events(t).filter(F.col("ts").isNotNull()).select(
        F.col("event_type").alias("family"), F.to_date("ts").alias("day"), F.hour("ts").alias("hour")
    )


EV_SQL = """
ev AS (SELECT event_type AS family, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour
       FROM events_typed WHERE ts IS NOT NULL),
span AS (SELECT min(day) AS lo, max(day) AS hi FROM ev),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span)"""
EV_CTES = derived.EVENTS_CTES + [EV_SQL]


@query(
    "in3_weekday_profile",
    sql=with_sql(*EV_CTES)
    + """,
wd AS (SELECT CAST(isodow(day) AS INTEGER) AS iso_weekday, COUNT(*) AS n_calendar_days FROM days GROUP BY 1),
cells AS (SELECT f.family, w.iso_weekday, w.n_calendar_days FROM (SELECT DISTINCT family FROM ev) f, wd w),
cnt AS (SELECT family, CAST(isodow(day) AS INTEGER) AS iso_weekday, COUNT(*) AS n FROM ev GROUP BY 1, 2)
SELECT c.family, c.iso_weekday, COALESCE(n.n, 0) AS n_events, c.n_calendar_days,
       round(COALESCE(n.n, 0)::DOUBLE / c.n_calendar_days, 6) AS mean_per_day
FROM cells c LEFT JOIN cnt n ON c.family = n.family AND c.iso_weekday = n.iso_weekday""",
    ops=("IN-3", "JN-11", "JN-13", "GEN-1"),
)
def in3_weekday_profile(spark, sf_dir):
    """Mean per CALENDAR day of each weekday (zero cells kept)."""
    ev = _event_days(Tables(spark, sf_dir))
    lo, hi = ev.select(F.min("day")).scalar(), ev.select(F.max("day")).scalar()
    wd = (
        spark.range(1)
        .select(F.explode(F.sequence(lo, hi)).alias("day"))
        .groupBy(iso_weekday("day").alias("iso_weekday"))
        .agg(F.count(F.lit(1)).alias("n_calendar_days"))
    )
    cells = ev.select("family").distinct().withColumn("iso_weekday", F.explode(F.sequence(F.lit(1), F.lit(7))))
    cells = cells.join(F.broadcast(wd), "iso_weekday")  # 7 rows
    cnt = ev.groupBy("family", iso_weekday("day").alias("iso_weekday")).agg(F.count(F.lit(1)).alias("n"))
    j = cells.join(cnt, ["family", "iso_weekday"], "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    return j.select("family", "iso_weekday", n.alias("n_events"), "n_calendar_days", _r(n / F.col("n_calendar_days")).alias("mean_per_day"))


@query(
    "in5_day_type_effect",
    sql=with_sql(*EV_CTES)
    + ",\n"
    + date_dimension_sql()
    + """,
typed AS (
  SELECT d.day, CASE WHEN d.is_holiday THEN 'holiday' WHEN d.is_ramadan THEN 'ramadan'
                     WHEN d.is_weekend THEN 'weekend' ELSE 'working_day' END AS day_type,
         (SELECT COUNT(*) FROM ev WHERE ev.day = d.day) AS n
  FROM dim_date d WHERE d.day BETWEEN (SELECT lo FROM span) AND (SELECT hi FROM span)
)
SELECT day_type, CAST(SUM(n) AS BIGINT) AS n_events, COUNT(*) AS n_calendar_days,
       COUNT(*) FILTER (WHERE n > 0) AS n_open_days,
       round(SUM(n)::DOUBLE / COUNT(*), 6) AS mean_per_calendar_day,
       round(SUM(n)::DOUBLE / NULLIF(COUNT(*) FILTER (WHERE n > 0), 0), 6) AS mean_per_open_day
FROM typed GROUP BY day_type""",
    ops=("IN-4", "IN-5", "IN-45", "AG-3", "GEN-3"),
)
def in5_day_type_effect(spark, sf_dir):
    """Holiday first, then Ramadan, then weekend; calendar-day and open-day means."""
    t = Tables(spark, sf_dir)
    ev = _event_days(t)
    lo, hi = ev.select(F.min("day")).scalar(), ev.select(F.max("day")).scalar()
    dim = date_dimension(t).filter(F.col("day").between(lo, hi))
    per_day = ev.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    j = dim.join(per_day, "day", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    day_type = (
        F.when(F.col("is_holiday"), "holiday")
        .when(F.col("is_ramadan"), "ramadan")
        .when(F.col("is_weekend"), "weekend")
        .otherwise("working_day")
    )
    return j.groupBy(day_type.alias("day_type")).agg(
        F.sum("n").cast("long").alias("n_events"),
        F.count(F.lit(1)).alias("n_calendar_days"),
        F.count_if(F.col("n") > 0).alias("n_open_days"),
        _r(ratio(F.sum("n"), F.count(F.lit(1)))).alias("mean_per_calendar_day"),
        _r(ratio(F.sum("n"), F.count_if(F.col("n") > 0))).alias("mean_per_open_day"),
    )


def hourly_counts(ev: DataFrame) -> DataFrame:
    """IN-6 / JN-18: events per (family, hour) with every hour 0..23 present."""
    cells = ev.select("family").distinct().withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    cnt = ev.groupBy("family", "hour").agg(F.count(F.lit(1)).alias("n"))
    return cells.join(cnt, ["family", "hour"], "left").select(
        "family", "hour", F.coalesce("n", F.lit(0)).cast("long").alias("n_events")
    )


HOURLY_SQL = """
hourly AS (
  SELECT c.family, c.hour, COALESCE(n.n, 0) AS n_events
  FROM (SELECT f.family, CAST(h.hour AS INTEGER) AS hour
        FROM (SELECT DISTINCT family FROM ev) f, (SELECT unnest(range(0, 24)) AS hour) h) c
  LEFT JOIN (SELECT family, hour, COUNT(*) AS n FROM ev GROUP BY 1, 2) n ON c.family = n.family AND c.hour = n.hour
)"""


@query("in6_hourly_profile", sql=with_sql(*EV_CTES, HOURLY_SQL) + "\nSELECT * FROM hourly", ops=("IN-6", "JN-18", "FN-7"))
def in6_hourly_profile(spark, sf_dir):
    return hourly_counts(_event_days(Tables(spark, sf_dir)))


@query(
    "in47_peak_trough_hours",
    sql=with_sql(*EV_CTES, HOURLY_SQL)
    + """,
tot AS (SELECT hour, CAST(SUM(n_events) AS BIGINT) AS n FROM hourly GROUP BY hour)
SELECT (SELECT hour FROM tot ORDER BY n DESC, hour LIMIT 1) AS peak_hour,
       (SELECT hour FROM tot ORDER BY n ASC, hour LIMIT 1) AS trough_hour,
       (SELECT round(max(n)::DOUBLE / NULLIF(min(n), 0), 6) FROM tot) AS peak_trough_ratio,
       (SELECT COUNT(*) FROM tot WHERE n = 0) AS n_empty_hours""",
    ops=("IN-47", "AG-13", "AG-14", "JN-18"),
)
def in47_peak_trough_hours(spark, sf_dir):
    tot = hourly_counts(_event_days(Tables(spark, sf_dir))).groupBy("hour").agg(F.sum("n_events").cast("long").alias("n"))
    peak = tot.select(F.min_by("hour", F.struct(-F.col("n"), F.col("hour")))).scalar()
    trough = tot.select(F.min_by("hour", F.struct(F.col("n"), F.col("hour")))).scalar()
    return measures_row(
        spark,
        {
            "peak_hour": peak,
            "trough_hour": trough,
            "peak_trough_ratio": tot.select(_r(F.try_divide(F.max("n").cast("double"), F.min("n").cast("double")))).scalar(),
            "n_empty_hours": tot.select(F.count_if(F.col("n") == 0)).scalar(),
        },
    )


# ------------------------------------------------------------------ emergency


@query(
    "in16_exit_orientation_share",
    sql=with_sql(*EMERGENCY_CTES)
    + """
SELECT exit_orientation, COUNT(*) AS n_visits,
       round(COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM emergency), 6) AS share
FROM emergency GROUP BY exit_orientation""",
    ops=("IN-16", "WN-4", "IN-49"),
)
def in16_exit_orientation_share(spark, sf_dir):
    e = emergency_facts(Tables(spark, sf_dir)).groupBy("exit_orientation").agg(F.count(F.lit(1)).alias("n_visits"))
    return with_share(e, "n_visits")


@query(
    "in15_delay_by_level",
    sql=with_sql(*EMERGENCY_CTES)
    + """
SELECT triage_level, COUNT(*) AS n_visits,
       round(COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM emergency), 6) AS share,
       round(quantile_cont(delay_to_care_min, 0.5), 6) AS median_delay_min,
       round(quantile_cont(delay_to_care_min, 0.9), 6) AS p90_delay_min
FROM emergency GROUP BY triage_level""",
    ops=("IN-14", "IN-15", "IN-18", "IN-49"),
    layer="indicator",
)
def in15_delay_by_level(spark, sf_dir):
    """Visits and delays by triage level."""
    e = emergency_facts(Tables(spark, sf_dir))
    g = e.groupBy("triage_level").agg(
        F.count(F.lit(1)).alias("n_visits"),
        _r(F.percentile("delay_to_care_min", 0.5)).alias("median_delay_min"),
        _r(F.percentile("delay_to_care_min", 0.9)).alias("p90_delay_min"),
    )
    return with_share(g, "n_visits")


@query(
    "in17_ordinary_consultation_share",
    sql=with_sql(*EMERGENCY_CTES)
    + """,
lv AS (SELECT DISTINCT triage_level FROM emergency WHERE triage_level IS NOT NULL ORDER BY triage_level DESC LIMIT 2)
SELECT (SELECT string_agg(triage_level, ',' ORDER BY triage_level) FROM lv) AS levels,
       COUNT(*) FILTER (WHERE triage_level IN (SELECT triage_level FROM lv)) AS n_ordinary,
       round(COUNT(*) FILTER (WHERE triage_level IN (SELECT triage_level FROM lv))::DOUBLE / COUNT(*), 6) AS share
FROM emergency""",
    ops=("IN-17", "SO-2", "AG-7", "JN-7"),
)
def in17_ordinary_consultation_share(spark, sf_dir):
    """The two least severe levels present (top-2 of the distinct levels), their share."""
    e = emergency_facts(Tables(spark, sf_dir))
    lv = e.select("triage_level").filter(F.col("triage_level").isNotNull()).distinct().orderBy(F.desc("triage_level")).limit(2)
    inside = e.join(F.broadcast(lv), "triage_level", "left_semi")  # at most 2 rows
    return measures_row(
        spark,
        {
            "levels": lv.select(F.array_join(F.array_sort(F.collect_list("triage_level")), ",")).scalar(),
            "n_ordinary": inside.select(F.count(F.lit(1))).scalar(),
            "share": _r(inside.select(F.count(F.lit(1)).cast("double")).scalar() / e.select(F.count(F.lit(1))).scalar()),
        },
    )


# ------------------------------------------------------------------ stays


@query(
    "in19_monthly_admissions",
    sql=with_sql(*STAY_CTES)
    + """
SELECT CAST(date_trunc('month', admitted_at) AS DATE) AS month, COUNT(*) AS n_admissions,
       round(SUM(length_minutes) / 1440.0, 6) AS bed_days
FROM stay WHERE admitted_at IS NOT NULL GROUP BY 1""",
    ops=("IN-19", "FN-8"),
)
def in19_monthly_admissions(spark, sf_dir):
    s = stay_facts(Tables(spark, sf_dir)).filter(F.col("admitted_at").isNotNull())
    return s.groupBy(F.trunc(F.to_date("admitted_at"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_admissions"), _r(F.sum("length_minutes") / 1440.0).alias("bed_days")
    )


def _reference_instant(t: Tables):
    """SS-3 / JN-17: end (23:59:59) of the last event day, never the clock."""
    last_day = derived.typed_events(t).select(F.max(F.to_date("ts"))).scalar()
    return F.to_timestamp_ntz(F.concat(F.date_format(last_day, "yyyy-MM-dd"), F.lit(" 23:59:59")))


@query(
    "in20_occupancy",
    sql=with_sql(*STAY_CTES)
    + f""",
ref AS (SELECT CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) + INTERVAL '23 hours 59 minutes 59 seconds' AS r
        FROM events_typed),
adm AS (SELECT *, (epoch_us(COALESCE(exit_at, (SELECT r FROM ref))) - epoch_us(admitted_at)) / 86400e6 AS los
        FROM stay WHERE admitted_at IS NOT NULL),
per AS (SELECT datediff('day', min(CAST(admitted_at AS DATE)), (SELECT CAST(r AS DATE) FROM ref)) + 1 AS days FROM adm)
SELECT COUNT(*) AS n_stays, COUNT(*) FILTER (WHERE exit_at IS NULL) AS n_open,
       round(COUNT(*) FILTER (WHERE exit_at IS NULL)::DOUBLE / COUNT(*), 6) AS open_share,
       round(avg(los), 6) AS mean_stay_days, round(SUM(los), 6) AS bed_days,
       round(SUM(los) / ({BEDS} * (SELECT days FROM per)), 6) AS occupancy_rate,
       round(COUNT(*)::DOUBLE / {BEDS}, 6) AS turnover,
       round(({BEDS} * (SELECT days FROM per) - SUM(los)) / COUNT(*), 6) AS turnover_interval_days,
       round(max(los) FILTER (WHERE exit_at IS NULL), 6) AS oldest_open_days
FROM adm""",
    ops=("IN-20", "IN-23", "JN-17", "FN-5", "SS-3", "SNK-10"),
)
def in20_occupancy(spark, sf_dir):
    """Occupancy, mean stay, turnover; open stays censored at the data reference instant."""
    t = Tables(spark, sf_dir)
    ref = _reference_instant(t)
    s = stay_facts(t).filter(F.col("admitted_at").isNotNull())
    s = s.withColumn("los", elapsed_days(F.coalesce(F.col("exit_at"), ref), F.col("admitted_at")))
    days = s.select(F.datediff(F.to_date(ref), F.min(F.to_date("admitted_at"))) + 1).scalar()
    open_ = F.col("exit_at").isNull()
    return s.agg(
        F.count(F.lit(1)).alias("n_stays"),
        F.count_if(open_).alias("n_open"),
        _r(ratio(F.count_if(open_), F.count(F.lit(1)))).alias("open_share"),
        _r(F.avg("los")).alias("mean_stay_days"),
        _r(F.sum("los")).alias("bed_days"),
        _r(F.sum("los") / (F.lit(BEDS) * days)).alias("occupancy_rate"),
        _r(F.count(F.lit(1)) / F.lit(float(BEDS))).alias("turnover"),
        _r((F.lit(BEDS) * days - F.sum("los")) / F.count(F.lit(1))).alias("turnover_interval_days"),
        _r(F.max(F.when(open_, F.col("los")))).alias("oldest_open_days"),
    )


@query(
    "in22_stay_length_distribution",
    sql=with_sql(*STAY_CTES)
    + """
SELECT round(min(length_minutes), 6) AS min_minutes, round(quantile_cont(length_minutes, 0.25), 6) AS q1_minutes,
       round(quantile_cont(length_minutes, 0.5), 6) AS median_minutes,
       round(quantile_cont(length_minutes, 0.75), 6) AS q3_minutes,
       round(quantile_cont(length_minutes, 0.9), 6) AS p90_minutes, round(max(length_minutes), 6) AS max_minutes,
       COUNT(length_minutes) AS n_known, COUNT(*) - COUNT(length_minutes) AS n_unknown
FROM stay""",
    ops=("IN-22", "AG-4"),
)
def in22_stay_length_distribution(spark, sf_dir):
    s = stay_facts(Tables(spark, sf_dir))
    m = F.col("length_minutes")
    return s.agg(
        _r(F.min(m)).alias("min_minutes"),
        _r(F.percentile(m, 0.25)).alias("q1_minutes"),
        _r(F.percentile(m, 0.5)).alias("median_minutes"),
        _r(F.percentile(m, 0.75)).alias("q3_minutes"),
        _r(F.percentile(m, 0.9)).alias("p90_minutes"),
        _r(F.max(m)).alias("max_minutes"),
        F.count(m).alias("n_known"),
        (F.count(F.lit(1)) - F.count(m)).alias("n_unknown"),
    )


# ------------------------------------------------------------------ billing


@query(
    "in24_billed_by_priority",
    sql=with_sql(*INVOICE_CTES)
    + """
SELECT o_orderpriority, CAST(SUM(lines_amount) AS DECIMAL(18,2)) AS billed,
       round(CAST(SUM(lines_amount) AS DOUBLE) / (SELECT CAST(SUM(lines_amount) AS DOUBLE) FROM invoice), 6) AS share
FROM invoice GROUP BY o_orderpriority""",
    ops=("IN-24", "WN-4"),
)
def in24_billed_by_priority(spark, sf_dir):
    inv = invoice_facts(Tables(spark, sf_dir))
    g = inv.groupBy("o_orderpriority").agg(F.sum("lines_amount").cast("decimal(18,2)").alias("billed"))
    return with_share(g, "billed")


@query(
    "in25_payer_shares",
    sql=with_sql(*INVOICE_CTES)
    + """
SELECT round(CAST(SUM(insurer_share) AS DOUBLE) / CAST(SUM(lines_amount) AS DOUBLE), 6) AS insurer_share_of_sums,
       round(CAST(SUM(patient_share) AS DOUBLE) / CAST(SUM(lines_amount) AS DOUBLE), 6) AS patient_share_of_sums,
       round(avg(CAST(insurer_share AS DOUBLE) / NULLIF(CAST(lines_amount AS DOUBLE), 0)), 6) AS mean_insurer_ratio
FROM invoice""",
    ops=("IN-25", "AG-12", "FN-12"),
)
def in25_payer_shares(spark, sf_dir):
    """Ratio of sums next to the mean of per-invoice ratios (they differ)."""
    inv = invoice_facts(Tables(spark, sf_dir))
    return inv.agg(
        _r(ratio(F.sum("insurer_share"), F.sum("lines_amount"))).alias("insurer_share_of_sums"),
        _r(ratio(F.sum("patient_share"), F.sum("lines_amount"))).alias("patient_share_of_sums"),
        _r(F.avg(ratio("insurer_share", "lines_amount"))).alias("mean_insurer_ratio"),
    )


@query(
    "in28_collection_rate_by_year",
    sql=with_sql(*INVOICE_CTES)
    + """,
billed AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, SUM(lines_amount) AS invoiced
           FROM invoice WHERE o_orderdate IS NOT NULL GROUP BY 1),
paid AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, SUM(l_extendedprice) AS collected
         FROM lineitem_typed WHERE l_shipdate IS NOT NULL GROUP BY 1)
SELECT COALESCE(b.year, p.year) AS year, CAST(b.invoiced AS DECIMAL(18,2)) AS invoiced,
       CAST(p.collected AS DECIMAL(18,2)) AS collected,
       round(CAST(p.collected AS DOUBLE) / NULLIF(CAST(b.invoiced AS DOUBLE), 0), 6) AS collection_rate
FROM billed b FULL OUTER JOIN paid p ON b.year = p.year""",
    ops=("IN-28", "FLT-2", "JN-9"),
)
def in28_collection_rate_by_year(spark, sf_dir):
    """Numerator filtered by receipt date, denominator by invoice date, per year."""
    t = Tables(spark, sf_dir)
    billed = (
        invoice_facts(t)
        .filter(F.col("o_orderdate").isNotNull())
        .groupBy(F.year("o_orderdate").alias("year"))
        .agg(F.sum("lines_amount").alias("_inv"))
    )
    paid = (
        derived.typed_lineitem(t)
        .filter(F.col("l_shipdate").isNotNull())
        .groupBy(F.year("l_shipdate").alias("year"))
        .agg(F.sum("l_extendedprice").alias("_col"))
    )
    j = billed.join(paid, "year", "full_outer")
    return j.select(
        "year",
        F.col("_inv").cast("decimal(18,2)").alias("invoiced"),
        F.col("_col").cast("decimal(18,2)").alias("collected"),
        _r(ratio("_col", "_inv")).alias("collection_rate"),
    )


@query(
    "in31_unbilled_by_month",
    sql=with_sql(*INVOICE_CTES)
    + """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n_orders,
       COUNT(*) FILTER (WHERE n_lines = 0) AS n_unbilled
FROM invoice WHERE o_orderdate IS NOT NULL GROUP BY 1""",
    ops=("IN-31", "JN-8"),
)
def in31_unbilled_by_month(spark, sf_dir):
    inv = invoice_facts(Tables(spark, sf_dir)).filter(F.col("o_orderdate").isNotNull())
    return inv.groupBy(F.trunc("o_orderdate", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("n_lines") == 0).alias("n_unbilled")
    )


# ------------------------------------------------------------------ receivables


def _aged(t: Tables) -> DataFrame:
    r = receivables(t)
    ref = r.select(F.max("snapshot_day")).scalar()
    return r.withColumn("age_days", F.datediff(ref, F.col("snapshot_day"))).withColumn(
        "outstanding", F.col("due") - F.col("recovered")
    )


AGED_SQL = """
aged AS (
  SELECT *, CAST(datediff('day', snapshot_day, (SELECT max(snapshot_day) FROM recv)) AS INTEGER) AS age_days,
         due - recovered AS outstanding
  FROM recv
)"""


@query(
    "in29_receivable_aging",
    sql="WITH "
    + RECEIVABLES_SQL
    + ","
    + AGED_SQL
    + """
SELECT COALESCE(CASE WHEN age_days <= 30 THEN '0-30d' WHEN age_days <= 60 THEN '31-60d'
                     WHEN age_days <= 90 THEN '61-90d' WHEN age_days <= 180 THEN '91-180d'
                     WHEN age_days IS NOT NULL THEN '>180d' END, 'no_snapshot') AS aging_bucket,
       COUNT(*) AS n_receivables, CAST(SUM(outstanding) AS DECIMAL(18,2)) AS outstanding
FROM aged GROUP BY 1""",
    ops=("IN-29", "FN-24", "JN-17", "WN-3"),
    layer="receivables",
)
def in29_receivable_aging(spark, sf_dir):
    """Open receivables and their amounts by age."""
    a = _aged(Tables(spark, sf_dir))
    b = F.coalesce(bucket_label("age_days", (30, 60, 90, 180)), F.lit("no_snapshot"))
    return a.groupBy(b.alias("aging_bucket")).agg(
        F.count(F.lit(1)).alias("n_receivables"), F.sum("outstanding").cast("decimal(18,2)").alias("outstanding")
    )


@query(
    "in44_outstanding_survival",
    sql="WITH "
    + RECEIVABLES_SQL
    + ","
    + AGED_SQL
    + """,
hist AS (SELECT age_days // 30 AS k, SUM(outstanding) AS amt FROM aged WHERE age_days IS NOT NULL GROUP BY 1),
grid AS (SELECT unnest(range(0, (SELECT max(k) FROM hist) + 1)) AS j)
SELECT CAST(j * 30 AS INTEGER) AS age_from_days,
       round(CAST((SELECT SUM(amt) FROM hist WHERE k >= j) AS DOUBLE) / CAST((SELECT SUM(amt) FROM hist) AS DOUBLE), 6)
         AS outstanding_share
FROM grid""",
    ops=("IN-44", "JN-12", "GEN-1"),
)
def in44_outstanding_survival(spark, sf_dir):
    """Share of the outstanding amount aged at least g days, g on a 30-day grid.

    The histogram has one row per 30-day step (bounded by the period), so the
    explode-to-grid below never grows with the number of receivables.
    """
    a = _aged(Tables(spark, sf_dir)).filter(F.col("age_days").isNotNull())
    hist = a.groupBy(F.floor(F.col("age_days") / 30).cast("int").alias("k")).agg(F.sum("outstanding").alias("amt"))
    total = hist.select(F.sum("amt").cast("double")).scalar()
    spread = hist.select(F.explode(F.sequence(F.lit(0), F.col("k"))).alias("j"), "amt")
    return spread.groupBy("j").agg(F.sum("amt").alias("_s")).select(
        (F.col("j") * 30).cast("int").alias("age_from_days"), _r(F.col("_s").cast("double") / total).alias("outstanding_share")
    )


@query(
    "in50_recovery_extremes",
    sql="WITH "
    + RECEIVABLES_SQL
    + ","
    + AGED_SQL
    + """,
rates AS (SELECT debtor_type, CAST(SUM(recovered) AS DOUBLE) / CAST(SUM(due) AS DOUBLE) AS rate FROM recv GROUP BY 1)
SELECT (SELECT round(min(rate), 6) FROM rates) AS min_recovery_rate,
       (SELECT round(max(rate), 6) FROM rates) AS max_recovery_rate,
       (SELECT round(max(rate) / min(rate), 6) FROM rates) AS max_min_ratio,
       (SELECT round(COUNT(*) FILTER (WHERE age_days >= 365)::DOUBLE / COUNT(*), 6) FROM aged) AS share_aged_365""",
    ops=("IN-50", "AG-14", "AG-2"),
)
def in50_recovery_extremes(spark, sf_dir):
    a = _aged(Tables(spark, sf_dir))
    rates = a.groupBy("debtor_type").agg(ratio(F.sum("recovered"), F.sum("due")).alias("rate"))
    return measures_row(
        spark,
        {
            "min_recovery_rate": rates.select(_r(F.min("rate"))).scalar(),
            "max_recovery_rate": rates.select(_r(F.max("rate"))).scalar(),
            "max_min_ratio": rates.select(_r(F.max("rate") / F.min("rate"))).scalar(),
            "share_aged_365": a.select(_r(ratio(F.count_if(F.col("age_days") >= 365), F.count(F.lit(1))))).scalar(),
        },
    )


# ------------------------------------------------------------------ curves and volumes


@query(
    "in42_cumulative_lead_curves",
    sql=with_sql(*APPT_CTES)
    + """,
pop AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' ELSE 'other' END AS population, lead_days
        FROM appt WHERE lead_days IS NOT NULL),
grid AS (SELECT DISTINCT p.population, CAST(g.g AS INTEGER) AS grid_days
         FROM pop p, (SELECT unnest(range(0, 91)) AS g) g)
SELECT grid.population, grid.grid_days,
       round((SELECT COUNT(*) FROM pop WHERE pop.population = grid.population AND pop.lead_days <= grid.grid_days)::DOUBLE
             / (SELECT COUNT(*) FROM pop WHERE pop.population = grid.population), 6) AS cum_share
FROM grid""",
    ops=("IN-42", "JN-12", "GEN-1"),
)
def in42_cumulative_lead_curves(spark, sf_dir):
    """Share of a population booked within g days, g = 0..90.

    Counts are first reduced to a per-(population, lead) histogram; each
    histogram bin is then spread over the grid points it falls under, so the
    expansion is bounded by 91 x distinct leads <= 90, whatever the row count.
    """
    a = appointments(Tables(spark, sf_dir)).filter(F.col("lead_days").isNotNull())
    pop = F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").otherwise("other").alias("population")
    hist = a.groupBy(pop, "lead_days").agg(F.count(F.lit(1)).alias("n"))
    totals = hist.groupBy("population").agg(F.sum("n").alias("total"))
    spread = hist.filter(F.col("lead_days") <= 90).select(
        "population", F.explode(F.sequence(F.greatest(F.col("lead_days"), F.lit(0)), F.lit(90))).alias("grid_days"), "n"
    )
    cum = spread.groupBy("population", "grid_days").agg(F.sum("n").alias("_c"))
    cells = totals.select("population", "total", F.explode(F.sequence(F.lit(0), F.lit(90))).alias("grid_days"))
    j = cells.join(cum, ["population", "grid_days"], "left")
    return j.select(
        "population",
        "grid_days",
        _r(F.coalesce(F.col("_c"), F.lit(0)).cast("double") / F.col("total")).alias("cum_share"),
    )


@query(
    "in51_annualised_volumes",
    sql=with_sql(*STAY_CTES, *EMERGENCY_CTES, *derived.ORDERS_CTES, *derived.LINEITEM_CTES)
    + """,
streams AS (
  SELECT 'orders' AS stream, COUNT(*) AS n, datediff('day', min(o_orderdate), max(o_orderdate)) + 1 AS days
  FROM orders_typed WHERE o_orderdate IS NOT NULL
  UNION ALL
  SELECT 'lines', COUNT(*), datediff('day', min(l_shipdate), max(l_shipdate)) + 1 FROM lineitem_typed WHERE l_shipdate IS NOT NULL
  UNION ALL
  SELECT 'stays', COUNT(*), datediff('day', min(stay_day), max(stay_day)) + 1 FROM stay
  UNION ALL
  SELECT 'emergency', COUNT(*), datediff('day', min(visit_day), max(visit_day)) + 1 FROM emergency
)
SELECT stream, n AS n_events, CAST(days AS INTEGER) AS period_days, round(n * 365.0 / days, 6) AS annualised
FROM streams""",
    ops=("IN-51", "SNK-10"),
)
def in51_annualised_volumes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    streams = [
        ("orders", derived.typed_orders(t).select(F.col("o_orderdate").alias("d"))),
        ("lines", derived.typed_lineitem(t).select(F.col("l_shipdate").alias("d"))),
        ("stays", stay_facts(t).select(F.col("stay_day").alias("d"))),
        ("emergency", emergency_facts(t).select(F.col("visit_day").alias("d"))),
    ]
    parts = []
    for name, df in streams:
        parts.append(
            df.filter(F.col("d").isNotNull())
            .agg(F.count(F.lit(1)).alias("n_events"), (F.datediff(F.max("d"), F.min("d")) + 1).alias("period_days"))
            .withColumn("stream", F.lit(name))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("annualised", _r(F.col("n_events") * 365.0 / F.col("period_days")))


@query(
    "in52_lab_activity",
    sql="""
SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, COUNT(*) AS n_exams,
       COUNT(DISTINCT (l.l_orderkey, CAST(l.l_shipdate AS DATE))) AS n_samples
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE starts_with(p.p_brand, 'Brand#1')
GROUP BY 1""",
    ops=("IN-52", "AG-3"),
)
def in52_lab_activity(spark, sf_dir):
    """Exams = lines of parts whose brand code starts with 'Brand#1'; samples = distinct
    (order, day) among them."""
    t = Tables(spark, sf_dir)
    parts = t.part.filter(F.col("p_brand").startswith("Brand#1")).select(F.col("p_partkey").alias("l_partkey"))
    li = t.lineitem.join(parts, "l_partkey", "left_semi")
    return li.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n_exams"),
        F.count_distinct(F.struct("l_orderkey", F.to_date("l_shipdate"))).alias("n_samples"),
    )


@query(
    "in53_days_split_by_year",
    sql="""
WITH ep AS (
  SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS s, min(CAST(l.l_shipdate AS DATE)) AS e
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2
),
yrs AS (SELECT s, e, unnest(range(year(s), year(e) + 1)) AS y FROM ep WHERE e > s)
SELECT CAST(y AS INTEGER) AS year,
       CAST(SUM(datediff('day', greatest(s, make_date(y, 1, 1)), least(e, make_date(y + 1, 1, 1)))) AS BIGINT) AS days
FROM yrs GROUP BY 1""",
    ops=("IN-53", "GEN-1"),
)
def in53_days_split_by_year(spark, sf_dir):
    """Each episode [order day, first ship day) contributes its days to every year it crosses."""
    t = Tables(spark, sf_dir)
    first = t.lineitem.groupBy("l_orderkey").agg(F.min(F.to_date("l_shipdate")).alias("e"))
    ep = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("s")).join(
        first, F.col("o_orderkey") == F.col("l_orderkey")
    )
    ep = ep.filter(F.col("e") > F.col("s"))
    yrs = ep.select("s", "e", F.explode(F.sequence(F.year("s"), F.year("e"))).alias("year"))
    days = F.datediff(
        F.least(F.col("e"), F.make_date(F.col("year") + 1, F.lit(1), F.lit(1))),
        F.greatest(F.col("s"), F.make_date("year", F.lit(1), F.lit(1))),
    )
    return yrs.groupBy("year").agg(F.sum(days).cast("long").alias("days"))


@query(
    "in48_incomplete_columns_ranked",
    sql="SELECT CAST(row_number() OVER (ORDER BY completeness, table_name, column_name) AS INTEGER) AS rank, "
    "table_name, column_name, completeness FROM (" + _completeness_sql() + ") WHERE completeness < 1",
    ops=("IN-48", "WN-7"),
)
def in48_incomplete_columns_ranked(spark, sf_dir):
    """Columns below full completeness ranked (lowest first, full tie-break).

    The ranked input has one row per declared column, so the global window is
    over a bounded, tiny set.
    """
    c = completeness(Tables(spark, sf_dir)).filter(F.col("completeness") < 1)
    w = Window.orderBy("completeness", "table_name", "column_name")
    return c.select(F.row_number().over(w).alias("rank"), "table_name", "column_name", "completeness")
