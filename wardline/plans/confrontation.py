"""Truth confrontation, completeness both ways, provenance and remaining series.

The defects introduced into the landing extracts follow fixed rules on the raw
driver columns (plans/landing.py). Re-deriving them from the raw table gives an
independent *truth* table (SRC-7: truth as data), confronted with the reasons
the row checks actually produced (DQ-14, DQ-16, DQ-17).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.conversions import decimal_year
from wardline.operators import quality as Q
from wardline.operators.aggregates import with_share
from wardline.operators.sets import measures_row
from wardline.plans import derived, landing, sqlgen
from wardline.plans.catalog import query
from wardline.plans.dimensions import data_codes, _codes_sql
from wardline.plans.indicators import APPT_CTES, appointments
from wardline.plans.landing import with_sql
from wardline.plans.marts import STAY_CTES, stay_facts
from wardline.plans.sets_and_samples import smp1_systematic_sample
from wardline.registry import LANDING_SPECS, LINEITEM_LANDING
from wardline.sources.tables import Tables

# ---- fixed values: the defect rules of plans/landing.py as a truth table -----
# (category, expected reason kind, column, predicate on the raw lineitem row)
TRUTH_RULES = [
    ("empty_line_number", "empty_key", "l_orderkey,l_linenumber", "l_orderkey % 997 = 3"),
    ("quantity_suffix", "type_integer", "l_quantity", "l_partkey % 83 = 5"),
    ("decimal_comma", "type_decimal", "l_extendedprice", "l_suppkey % 61 = 3"),
    ("impossible_day", "type_date", "l_shipdate", "(l_orderkey + l_linenumber) % 50 <> 0 AND l_partkey % 97 = 13"),
    ("flag_out_of_domain", "boolean_domain", "is_returned", "l_returnflag = 'R' AND l_orderkey % 101 = 0"),
    ("early_extraction", "partition_mismatch", "date_extraction", "l_orderkey % 499 = 1"),
]
# -----------------------------------------------------------------------------


def _row_id(df: DataFrame):
    return F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey")], F.date_format("l_shipdate", "yyyy-MM-dd"))


def truth_table(t: Tables) -> DataFrame:
    """SRC-7: one row per (raw row identity, injected defect category)."""
    li = t.lineitem
    parts = [
        li.filter(F.expr(pred)).select(
            _row_id(li).alias("row_id"), F.lit(cat).alias("category"), F.lit(kind).alias("kind"), F.lit(col).alias("column_name")
        )
        for cat, kind, col, pred in TRUTH_RULES
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def flagged_reasons(t: Tables) -> DataFrame:
    """(row identity, reason kind, column) of every reason produced by the checks."""
    checked = Q.check_rows(landing.lineitem_landing(t, with_identity=True), LINEITEM_LANDING, "path_date")
    parts = F.split(F.col("reason"), ":", 3)
    return checked.select("row_id", F.explode(Q.REASONS).alias("reason")).select(
        "row_id", parts.getItem(0).alias("kind"), parts.getItem(1).alias("column_name")
    )


TRUTH_SQL = "truth AS (" + "\nUNION ALL\n".join(
    f"SELECT l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || strftime(l_shipdate, '%Y-%m-%d') AS row_id, "
    f"'{cat}' AS category, '{kind}' AS kind, '{col}' AS column_name FROM lineitem WHERE {pred}"
    for cat, kind, col, pred in TRUTH_RULES
) + ")"

CONFRONT_SQL = (
    with_sql(
        landing.LINEITEM_LANDING_ID_SQL,
        sqlgen.checked_cte(LINEITEM_LANDING, "lineitem_landing_id", "chk", extra=("row_id",)),
        TRUTH_SQL,
    )
    + """,
flag AS (SELECT row_id, split_part(reason, ':', 1) AS kind, split_part(reason, ':', 2) AS column_name, COUNT(*) AS m
         FROM (SELECT row_id, unnest(string_split(reasons, ';')) AS reason FROM chk WHERE reasons <> '') GROUP BY ALL),
tru AS (SELECT row_id, kind, column_name, COUNT(*) AS n FROM truth GROUP BY ALL),
j AS (SELECT COALESCE(t.kind, f.kind) AS kind, COALESCE(t.column_name, f.column_name) AS column_name,
             COALESCE(t.n, 0) AS n, COALESCE(f.m, 0) AS m
      FROM tru t FULL OUTER JOIN flag f ON t.row_id = f.row_id AND t.kind = f.kind AND t.column_name = f.column_name)
SELECT kind, column_name, CAST(SUM(n) AS BIGINT) AS n_truth, CAST(SUM(m) AS BIGINT) AS n_flagged,
       CAST(SUM(least(n, m)) AS BIGINT) AS n_caught, CAST(SUM(n) - SUM(least(n, m)) AS BIGINT) AS n_missing,
       CAST(SUM(m) - SUM(least(n, m)) AS BIGINT) AS n_extra
FROM j GROUP BY kind, column_name"""
)


@query("dq14_truth_vs_quarantine", sql=CONFRONT_SQL, ops=("DQ-14", "DQ-16", "DQ-17", "SRC-7"))
def dq14_truth_vs_quarantine(spark, sf_dir):
    """Per (reason kind, column): injected rows, flagged rows, caught (multiset
    intersection by row identity), missing and extra. Kinds without an injected
    category (low bound, after extraction, duplicate) show as coincidences."""
    t = Tables(spark, sf_dir)
    tru = truth_table(t).groupBy("row_id", "kind", "column_name").agg(F.count(F.lit(1)).alias("n"))
    flg = flagged_reasons(t).groupBy("row_id", "kind", "column_name").agg(F.count(F.lit(1)).alias("m"))
    j = tru.join(flg, ["row_id", "kind", "column_name"], "full_outer").fillna(0, ["n", "m"])
    caught = F.least("n", "m")
    return j.groupBy("kind", "column_name").agg(
        F.sum("n").cast("long").alias("n_truth"),
        F.sum("m").cast("long").alias("n_flagged"),
        F.sum(caught).cast("long").alias("n_caught"),
        (F.sum("n") - F.sum(caught)).cast("long").alias("n_missing"),
        (F.sum("m") - F.sum(caught)).cast("long").alias("n_extra"),
    )


# ---------------------------------------------------------------- DQ-26 dimension completeness


@query(
    "dq26_dimension_completeness",
    sql=with_sql(*derived.LINEITEM_CTES, *derived.ORDERS_CTES, _codes_sql())
    + """,
used AS (
  SELECT 'order_status' AS code_type, o_orderstatus AS code FROM orders_typed WHERE o_orderstatus IS NOT NULL
  UNION SELECT 'order_priority', o_orderpriority FROM orders_typed WHERE o_orderpriority IS NOT NULL
  UNION SELECT 'return_flag', l_returnflag FROM lineitem_typed WHERE l_returnflag IS NOT NULL
  UNION SELECT 'line_status', l_linestatus FROM lineitem_typed WHERE l_linestatus IS NOT NULL
)
SELECT code_type,
       (SELECT COUNT(*) FROM (SELECT code FROM used u WHERE u.code_type = c.code_type
                              EXCEPT SELECT code FROM codes d WHERE d.code_type = c.code_type)) AS n_used_not_in_dimension,
       (SELECT COUNT(*) FROM (SELECT code FROM codes d WHERE d.code_type = c.code_type
                              EXCEPT SELECT code FROM used u WHERE u.code_type = c.code_type)) AS n_dimension_not_used
FROM (SELECT DISTINCT code_type FROM used) c""",
    ops=("DQ-26", "ST-3", "DIM-3..6"),
)
def dq26_dimension_completeness(spark, sf_dir):
    """Codes used by the typed facts vs the code dimension, both ways, per code type."""
    t = Tables(spark, sf_dir)
    o, li = derived.typed_orders(t), derived.typed_lineitem(t)
    used = reduce(
        lambda a, b: a.unionByName(b),
        [
            o.select(F.lit("order_status").alias("code_type"), F.col("o_orderstatus").alias("code")),
            o.select(F.lit("order_priority").alias("code_type"), F.col("o_orderpriority").alias("code")),
            li.select(F.lit("return_flag").alias("code_type"), F.col("l_returnflag").alias("code")),
            li.select(F.lit("line_status").alias("code_type"), F.col("l_linestatus").alias("code")),
        ],
    ).filter(F.col("code").isNotNull()).distinct()
    dim = data_codes(t).join(used.select("code_type").distinct(), "code_type", "left_semi")
    j = used.withColumn("_u", F.lit(True)).join(dim.withColumn("_d", F.lit(True)), ["code_type", "code"], "full_outer")
    return j.groupBy("code_type").agg(
        F.count_if(F.col("_d").isNull()).alias("n_used_not_in_dimension"),
        F.count_if(F.col("_u").isNull()).alias("n_dimension_not_used"),
    )


# ---------------------------------------------------------------- DQ-43 sample rows exist


def _dq43_sql() -> str:
    from wardline.plans.sets_and_samples import NOTICE, SAMPLE_SIZE

    return f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS rk, COUNT(*) OVER () AS total FROM customer),
s AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM r
  WHERE (rk - 1) % greatest(total // {SAMPLE_SIZE}, 1) = 0 AND (rk - 1) // greatest(total // {SAMPLE_SIZE}, 1) < {SAMPLE_SIZE}
  UNION
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0
)
SELECT (SELECT COUNT(*) FROM s) AS n_sampled,
       (SELECT COUNT(*) FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)) AS n_missing_key,
       (SELECT COUNT(*) FROM (SELECT * FROM s EXCEPT ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer))
         AS n_differing_rows"""


@query(
    "dq43_sample_rows_exist",
    sql=_dq43_sql(),
    ops=("DQ-43",),
)
def dq43_sample_rows_exist(spark, sf_dir):
    """Every sampled row exists in its table with the same values."""
    t = Tables(spark, sf_dir)
    sample = smp1_systematic_sample(spark, sf_dir)
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    missing = sample.join(t.customer.select("c_custkey"), "c_custkey", "left_anti")
    differing = sample.select(*cols).exceptAll(t.customer.select(*cols))
    return measures_row(
        spark,
        {
            "n_sampled": sample.select(F.count(F.lit(1))).scalar(),
            "n_missing_key": missing.select(F.count(F.lit(1))).scalar(),
            "n_differing_rows": differing.select(F.count(F.lit(1))).scalar(),
        },
    )


# ---------------------------------------------------------------- DQ-47, MRT-8, IN-36 provenance


# ---- fixed value: the comment format that carries a column's provenance ----
COMMENT = "provenance={provenance};kind={kind};"
# ----------------------------------------------------------------------------


def _registry_rows():
    return [
        (spec_name, c.name, COMMENT.format(provenance=c.provenance.upper(), kind=c.kind))
        for spec_name, spec in LANDING_SPECS.items()
        for c in spec.columns
    ]


def _catalog_columns(t: Tables) -> dict[str, DataFrame]:
    return {
        "lineitem_landing": landing.lineitem_landing(t),
        "orders_landing": landing.orders_landing(t),
        "events_landing": landing.events_landing(t),
    }


def _coverage_sql() -> str:
    reg = ", ".join(f"('{a}', '{b}')" for a, b, _ in _registry_rows())
    values = [
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE CAST({c} AS VARCHAR) <> '') AS n_values FROM {name}"
        for name in ("lineitem_landing", "orders_landing", "events_landing")
        for c in [*LANDING_SPECS[name].names, "path_date"]
    ]
    return (
        with_sql(landing.LINEITEM_LANDING_SQL, landing.ORDERS_LANDING_SQL, landing.EVENTS_LANDING_SQL)
        + f""",
reg(table_name, column_name) AS (VALUES {reg}),
cat AS ({' UNION ALL '.join(values)})
SELECT table_name, column_name, r.column_name IS NOT NULL AS in_registry, c.column_name IS NOT NULL AS in_catalog, n_values
FROM reg r FULL OUTER JOIN cat c USING (table_name, column_name)"""
    )


@query("dq47_provenance_coverage", sql=_coverage_sql(), ops=("DQ-47",))
def dq47_provenance_coverage(spark, sf_dir):
    """Registry columns vs the columns of the extracts, both ways, with their values that are
    not blank (one pass per extract)."""
    t = Tables(spark, sf_dir)
    reg = spark.createDataFrame([(a, b, True) for a, b, _ in _registry_rows()], "table_name string, column_name string, in_registry boolean")
    parts = []
    for name, df in _catalog_columns(t).items():
        counts = df.agg(*[F.count_if(F.col(c).cast("string") != "").alias(c) for c in df.columns])
        parts.append(counts.unpivot([], df.columns, "column_name", "n_values").withColumn("table_name", F.lit(name)))
    cat = reduce(lambda a, b: a.unionByName(b), parts).withColumn("in_catalog", F.lit(True))
    j = reg.join(cat, ["table_name", "column_name"], "full_outer")
    return j.select("table_name", "column_name", F.coalesce("in_registry", F.lit(False)).alias("in_registry"), F.coalesce("in_catalog", F.lit(False)).alias("in_catalog"), "n_values")


def _provenance_sql() -> str:
    rows = _registry_rows()
    values = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in rows)
    counts = []
    for name in ("lineitem_landing", "orders_landing", "events_landing"):
        for c in LANDING_SPECS[name].columns:
            counts.append(f"SELECT '{name}' AS table_name, '{c.name}' AS column_name, COUNT(*) FILTER (WHERE {c.name} <> '') AS n_values FROM {name}")
    return (
        with_sql(landing.LINEITEM_LANDING_SQL, landing.ORDERS_LANDING_SQL, landing.EVENTS_LANDING_SQL)
        + f""",
reg AS (SELECT * FROM (VALUES {values}) AS r(table_name, column_name, comment)),
vals AS ({' UNION ALL '.join(counts)}),
lab AS (SELECT regexp_extract(comment, 'provenance=([A-Z]+);', 1) AS provenance, r.column_name, v.n_values
        FROM reg r JOIN vals v ON r.table_name = v.table_name AND r.column_name = v.column_name)
SELECT provenance, COUNT(*) AS n_columns, round(COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM lab), 6) AS share,
       CAST(SUM(n_values) AS BIGINT) AS n_values
FROM lab GROUP BY provenance"""
    )


@query("mrt8_provenance_split", sql=_provenance_sql(), ops=("MRT-8", "IN-36", "FN-15", "WN-4"), layer="mart")
def mrt8_provenance_split(spark, sf_dir):
    """Columns by provenance label (captured from the column comment) with their share,
    and how many non-blank values the extracts hold in those columns."""
    t = Tables(spark, sf_dir)
    reg = spark.createDataFrame(_registry_rows(), "table_name string, column_name string, comment string")
    vals = []
    for name, df in _catalog_columns(t).items():
        cols = LANDING_SPECS[name].names
        wide = df.agg(*[F.count_if(F.col(c) != "").alias(c) for c in cols])
        vals.append(wide.unpivot([], cols, "column_name", "n_values").withColumn("table_name", F.lit(name)))
    v = reduce(lambda a, b: a.unionByName(b), vals)
    lab = reg.join(v, ["table_name", "column_name"]).withColumn("provenance", F.regexp_extract("comment", r"provenance=([A-Z]+);", 1))
    g = lab.groupBy("provenance").agg(F.count(F.lit(1)).alias("n_columns"), F.sum("n_values").cast("long").alias("n_values"))
    return with_share(g, "n_columns")


# ---------------------------------------------------------------- remaining indicator series


@query(
    "in21_stays_by_entry_service",
    sql=with_sql(*STAY_CTES)
    + """,
entry AS (SELECT user_id, CAST(ts AS DATE) AS stay_day, arg_min(event_type, (ts, event_type)) AS entry_service
          FROM events_typed WHERE ts IS NOT NULL GROUP BY 1, 2)
SELECT entry_service, COUNT(*) AS n_stays, round(COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM entry), 6) AS share
FROM entry GROUP BY entry_service""",
    ops=("IN-21", "WN-4"),
)
def in21_stays_by_entry_service(spark, sf_dir):
    """Stays by the service of their first movement (earliest instant, then code), with share."""
    ev = derived.typed_events(Tables(spark, sf_dir)).filter(F.col("ts").isNotNull())
    entry = ev.groupBy("user_id", F.to_date("ts").alias("stay_day")).agg(
        F.min(F.struct("ts", "event_type")).getField("event_type").alias("entry_service")
    )
    return with_share(entry.groupBy("entry_service").agg(F.count(F.lit(1)).alias("n_stays")), "n_stays")


@query(
    "in41_booking_artefact",
    sql="""
WITH first_line AS (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1)
SELECT o.o_orderdate = f.first_ship AS booked_on_first_record, COUNT(*) AS n_honoured
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN first_line f ON f.l_orderkey = l.l_orderkey
WHERE l.l_returnflag = 'N' AND l.l_linestatus = 'F'
GROUP BY 1""",
    ops=("IN-41",),
)
def in41_booking_artefact(spark, sf_dir):
    """Honoured lines split by whether the booking day equals the order's first record
    day (min per key, an aggregate joined back)."""
    t = Tables(spark, sf_dir)
    first = t.lineitem.groupBy(F.col("l_orderkey").alias("_k")).agg(F.min("l_shipdate").alias("first_ship"))
    li = t.lineitem.filter((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))
    o = t.orders
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(first, F.col("l_orderkey") == F.col("_k"))
    return j.groupBy((F.col("o_orderdate") == F.col("first_ship")).alias("booked_on_first_record")).agg(F.count(F.lit(1)).alias("n_honoured"))


@query(
    "in43_lead_vs_complement",
    sql=with_sql(*APPT_CTES)
    + """,
g AS (SELECT DISTINCT o_orderpriority AS grp FROM appt)
SELECT g.grp AS o_orderpriority,
       round((SELECT quantile_cont(lead_days, 0.5) FROM appt a WHERE a.o_orderpriority = g.grp AND NOT same_day), 6) AS median_lead_group,
       round((SELECT quantile_cont(lead_days, 0.5) FROM appt a WHERE a.o_orderpriority <> g.grp AND NOT same_day), 6) AS median_lead_others,
       round((SELECT avg(CASE WHEN absent THEN 1.0 ELSE 0.0 END) FROM appt a WHERE a.o_orderpriority = g.grp), 6) AS absence_group,
       round((SELECT avg(CASE WHEN absent THEN 1.0 ELSE 0.0 END) FROM appt a WHERE a.o_orderpriority <> g.grp), 6) AS absence_others
FROM g""",
    ops=("IN-43", "AG-4"),
)
def in43_lead_vs_complement(spark, sf_dir):
    """Per group: median lead and absence rate, for the group and for all other groups.

    Exact complement medians from histograms: each (group, lead, count) bin is
    credited to every OTHER group, then a frequency-weighted exact percentile is
    taken; the expansion is bounded by groups^2 x distinct leads, not by rows.
    """
    a = appointments(Tables(spark, sf_dir))
    pos = a.filter(~F.col("same_day") & F.col("lead_days").isNotNull())
    hist = pos.groupBy("o_orderpriority", "lead_days").agg(F.count(F.lit(1)).alias("n"))
    groups = a.select(F.array_sort(F.collect_set("o_orderpriority"))).scalar()
    comp = hist.select(F.explode(F.array_remove(groups, F.col("o_orderpriority"))).alias("target"), "lead_days", "n")
    med_other = comp.groupBy(F.col("target").alias("o_orderpriority")).agg(
        F.round(F.percentile("lead_days", 0.5, F.col("n")), 6).alias("median_lead_others")
    )
    med_group = hist.groupBy("o_orderpriority").agg(F.round(F.percentile("lead_days", 0.5, F.col("n")), 6).alias("median_lead_group"))
    per = a.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("_n"), F.count_if("absent").alias("_abs"))
    tot_n, tot_abs = per.select(F.sum("_n")).scalar(), per.select(F.sum("_abs")).scalar()
    rates = per.select(
        "o_orderpriority",
        F.round(F.col("_abs") / F.col("_n"), 6).alias("absence_group"),
        F.round((tot_abs - F.col("_abs")) / (tot_n - F.col("_n")), 6).alias("absence_others"),
    )
    return rates.join(med_group, "o_orderpriority", "left").join(med_other, "o_orderpriority", "left")


@query(
    "in46_flow_series",
    sql="""
SELECT 'monthly_scheduled' AS series, round(year(o_orderdate) + (month(o_orderdate) - 1) / 12.0, 6) AS x, COUNT(*) AS n FROM orders GROUP BY 2
UNION ALL
SELECT 'monthly_emergency', round(year(ts) + (month(ts) - 1) / 12.0, 6), COUNT(*) FROM events GROUP BY 2
UNION ALL
SELECT 'hourly_emergency', CAST(hour(ts) AS DOUBLE), COUNT(*) FROM events GROUP BY 2""",
    ops=("IN-46", "FN-9", "FN-7"),
)
def in46_flow_series(spark, sf_dir):
    """Monthly scheduled vs emergency flows on a decimal-year axis, and the hourly profile."""
    t = Tables(spark, sf_dir)
    m1 = t.orders.groupBy(decimal_year("o_orderdate").alias("x")).agg(F.count(F.lit(1)).alias("n")).withColumn("series", F.lit("monthly_scheduled"))
    m2 = t.events.groupBy(decimal_year("ts").alias("x")).agg(F.count(F.lit(1)).alias("n")).withColumn("series", F.lit("monthly_emergency"))
    h = t.events.groupBy(F.hour("ts").cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n")).withColumn("series", F.lit("hourly_emergency"))
    return m1.unionByName(m2).unionByName(h)


# ---------------------------------------------------------------- DQ-15 attribution

ATTRIBUTION_SQL = (
    with_sql(
        landing.LINEITEM_LANDING_ID_SQL,
        sqlgen.checked_cte(LINEITEM_LANDING, "lineitem_landing_id", "chk", extra=("row_id",)),
    )
    + """,
low AS (SELECT reasons, CAST(try_strptime(l_shipdate, '%m/%d/%Y') AS DATE) AS ship,
               (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem) AS first_day
        FROM chk WHERE reasons LIKE '%low_bound:l_shipdate:%')
SELECT CASE WHEN reasons LIKE '%duplicate:%' THEN 'also_duplicate'
            WHEN date_trunc('month', ship) = date_trunc('month', first_day) THEN 'first_month_of_data'
            ELSE 'unexplained' END AS origin,
       COUNT(*) AS n_rows
FROM low GROUP BY 1"""
)


@query("dq15_low_bound_attribution", sql=ATTRIBUTION_SQL, ops=("DQ-15",))
def dq15_low_bound_attribution(spark, sf_dir):
    """Rows rejected for a too-early ship date attributed to an origin: also a repeated
    key, the first month of the data (before the declared bound), or unexplained."""
    t = Tables(spark, sf_dir)
    checked = Q.check_rows(landing.lineitem_landing(t, with_identity=True), LINEITEM_LANDING, "path_date")
    text = F.array_join(Q.REASONS, ";")
    low = checked.filter(text.contains("low_bound:l_shipdate:"))
    first_day = t.lineitem.select(F.min(F.to_date("l_shipdate"))).scalar()
    ship = F.to_date(F.try_to_timestamp(F.col("l_shipdate"), F.lit("MM/dd/yyyy")))
    origin = (
        F.when(text.contains("duplicate:"), "also_duplicate")
        .when(F.trunc(ship, "MM") == F.trunc(first_day, "MM"), "first_month_of_data")
        .otherwise("unexplained")
    )
    return low.groupBy(origin.alias("origin")).agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- FN-16/17 on whole texts

NORM_V1_SQL = r"trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[!-/:-@\[-`{-~]', ' ', 'g'), '\s+', ' ', 'g'))"


_DOC_NORM = f"CASE WHEN trim(text) = '' THEN text ELSE {NORM_V1_SQL} END"


@query(
    "fn16_normalise_documents",
    sql=f"SELECT doc_id, md5({_DOC_NORM}) AS norm_md5, CAST(length({_DOC_NORM}) AS INTEGER) AS norm_chars FROM documents",
    ops=("FN-16",),
)
def fn16_normalise_documents(spark, sf_dir):
    """v1 normalisation of every whole document (accents, case, punctuation, spaces);
    the digest lets two engines compare the full normalised texts."""
    from wardline.functions.similarity import v1

    d = Tables(spark, sf_dir).documents
    n = v1("text")
    return d.select("doc_id", F.md5(n).alias("norm_md5"), F.length(n).alias("norm_chars"))


@query(
    "fn17_sorted_tokens_conversations",
    sql=f"""
SELECT conv_id, turn,
       md5(CASE WHEN trim(text) = '' THEN text ELSE array_to_string(list_sort(string_split({NORM_V1_SQL}, ' ')), ' ') END) AS norm_md5
FROM conversations""",
    ops=("FN-17",),
)
def fn17_sorted_tokens_conversations(spark, sf_dir):
    """v2 normalisation (v1, then tokens sorted) of every conversation turn."""
    from wardline.functions.similarity import v2

    c = Tables(spark, sf_dir).conversations
    return c.select("conv_id", "turn", F.md5(v2("text")).alias("norm_md5"))
