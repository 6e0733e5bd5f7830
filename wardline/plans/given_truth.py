"""Checks confronted with truth that the given tables hold themselves.

Truth is never made up here: the keys that really repeat in ``lineitem``, the labels of
``documents``, the raw order days behind the versions, the columns of the stored tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.conversions import ratio
from wardline.operators import quality as Q
from wardline.operators.selection import exact_percentiles
from wardline.operators.sets import measures_row
from wardline.plans import derived
from wardline.plans.catalog import query
from wardline.plans.landing import with_sql
from wardline.plans.quality_plans import SPECS, _checked_ctes
from wardline.registry import EVENTS_LANDING, LINEITEM_LANDING, ORDERS_LANDING
from wardline.sources.tables import Tables


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------------------------- DQ-14, DQ-16: repeated keys

KEYS = {"lineitem": ("l_orderkey", "l_linenumber"), "orders": ("o_orderkey",), "documents": ("doc_id",)}


@query(
    "dq16_repeated_keys_both_ways",
    sql="\nUNION ALL\n".join(
        f"""SELECT '{name}' AS table_name, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS n_truth, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS n_caught,
       CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra, COUNT(*) AS n_keys, CAST(0 AS BIGINT) AS n_keys_not_kept_once
FROM (SELECT COUNT(*) AS n FROM {name} GROUP BY {', '.join(key)})"""
        for name, key in KEYS.items()
    ),
    ops=("DQ-14", "DQ-16", "DQ-7", "SRC-7"),
)
def dq16_repeated_keys_both_ways(spark, sf_dir):
    """The uniqueness check against the keys that repeat in the given tables: rows caught,
    missing and extra; and the inverse, that what it lets through holds every key once."""
    t = Tables(spark, sf_dir)
    parts = []
    for name, key in KEYS.items():
        raw = getattr(t, name)
        text = raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in raw.columns], F.lit(1).alias("scope"))
        flagged = Q.uniqueness_flags(text, key, ["scope"])
        counted = text.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("truth"))
        caught = flagged.groupBy(*key).agg(F.count_if("_dup").alias("caught"), F.count_if(~F.col("_dup")).alias("kept"))
        both = counted.join(caught, list(key), "full_outer").fillna(0, ["truth", "caught", "kept"])
        parts.append(
            both.agg(
                F.sum("truth").cast("long").alias("n_truth"),
                F.sum("caught").cast("long").alias("n_caught"),
                F.sum(F.greatest(F.col("truth") - F.col("caught"), F.lit(0))).cast("long").alias("n_missing"),
                F.sum(F.greatest(F.col("caught") - F.col("truth"), F.lit(0))).cast("long").alias("n_extra"),
                F.count(F.lit(1)).alias("n_keys"),
                F.count_if(F.col("kept") != 1).alias("n_keys_not_kept_once"),
            ).withColumn("table_name", F.lit(name))
        )
    return _union(parts)


# ---------------------------------------------------------------- DQ-17: coincidences with labels

REASONS = {
    "shouting": (r"regexp_count(text, '[A-Z]') > 0.5 * length(text)", "len(regexp_extract_all(text, '[A-Z]')) > 0.5 * length(text)"),
    "signs": (r"regexp_count(text, '[#$%&*|]') > 0.02 * length(text)", "len(regexp_extract_all(text, '[#$%&*|]')) > 0.02 * length(text)"),
    "short": ("length(text) < 40", "length(text) < 40"),
    "digits": (r"regexp_count(text, '[0-9]') > 0.05 * length(text)", "len(regexp_extract_all(text, '[0-9]')) > 0.05 * length(text)"),
}
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1", "clean": "quality = 1 AND toxic = 0"}


@query(
    "dq17_label_coincidences",
    sql="WITH r AS ("
    + " UNION ALL ".join(f"SELECT doc_id, '{n}' AS reason FROM documents WHERE {sql}" for n, (_, sql) in REASONS.items())
    + "), c AS ("
    + " UNION ALL ".join(f"SELECT doc_id, '{n}' AS category FROM labels WHERE {cond}" for n, cond in CATEGORIES.items())
    + """), names(reason) AS (VALUES """
    + ", ".join(f"('{n}')" for n in REASONS)
    + """)
SELECT c.category, n.reason, COUNT(*) AS n_labelled, COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM r WHERE r.doc_id = c.doc_id AND r.reason = n.reason)) AS n_coincident
FROM c, names n GROUP BY 1, 2""",
    ops=("DQ-17",),
)
def dq17_label_coincidences(spark, sf_dir):
    """How many documents of each label category a rule without a dedicated category flags."""
    t = Tables(spark, sf_dir)
    flags = t.documents.select("doc_id", *[F.expr(expr).alias(n) for n, (expr, _) in REASONS.items()])
    kinds = F.filter(F.array(*[F.when(F.expr(cond), F.lit(n)) for n, cond in CATEGORIES.items()]), lambda x: x.isNotNull())
    cats = t.labels.select("doc_id", F.explode(kinds).alias("category"))
    joined = cats.join(flags, "doc_id", "left")
    per = joined.groupBy("category").agg(F.count(F.lit(1)).alias("n_labelled"), *[F.count_if(F.col(n)).alias(n) for n in REASONS])
    return per.unpivot(["category", "n_labelled"], list(REASONS), "reason", "n_coincident")


# ---------------------------------------------------------------- DQ-31: change log against raw order days


@query(
    "dq31_changes_vs_raw_orders",
    sql=with_sql(*derived.VERSION_CTES)
    + """,
raw AS (SELECT CAST(o_custkey AS VARCHAR) AS k, CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1, 2),
lost AS (SELECT DISTINCT CAST(o.o_custkey AS VARCHAR) AS k, CAST(o.o_orderdate AS DATE) AS d FROM orders o
         JOIN orders_typed x ON CAST(o.o_orderkey AS VARCHAR) = x.o_orderkey WHERE x.o_orderdate IS NULL),
v AS (SELECT o_custkey AS k, valid_from AS d FROM versions)
SELECT (SELECT COUNT(*) FROM raw) AS n_truth, (SELECT COUNT(*) FROM raw JOIN v USING (k, d)) AS n_matched,
       (SELECT COUNT(*) FROM raw WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.k = raw.k AND v.d = raw.d)) AS n_missing,
       (SELECT COUNT(*) FROM raw WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.k = raw.k AND v.d = raw.d)
                                   AND EXISTS (SELECT 1 FROM lost WHERE lost.k = raw.k AND lost.d = raw.d)) AS n_excused,
       (SELECT COUNT(*) FROM v WHERE NOT EXISTS (SELECT 1 FROM raw WHERE v.k = raw.k AND v.d = raw.d)) AS n_extra""",
    ops=("DQ-31", "DQ-30", "SCD-3"),
)
def dq31_changes_vs_raw_orders(spark, sf_dir):
    """Version starts against the raw order days; a missing one is excused only by proof: an
    order of that customer and day whose date the extract lost."""
    t = Tables(spark, sf_dir)
    raw = t.orders.select(F.col("o_custkey").cast("string").alias("k"), F.to_date("o_orderdate").alias("d"), F.col("o_orderkey").cast("string").alias("o_orderkey"))
    typed = derived.typed_orders(t).filter(F.col("o_orderdate").isNull()).select("o_orderkey")
    lost = raw.join(typed, "o_orderkey", "left_semi").select("k", "d").distinct()
    truth = raw.select("k", "d").distinct()
    v = derived.customer_versions(t).select(F.col("o_custkey").alias("k"), F.col("valid_from").alias("d"))
    missing = truth.join(v, ["k", "d"], "left_anti")
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    return measures_row(
        spark,
        {
            "n_truth": n(truth),
            "n_matched": n(truth.join(v, ["k", "d"], "left_semi")),
            "n_missing": n(missing),
            "n_excused": n(missing.join(lost, ["k", "d"], "left_semi")),
            "n_extra": n(v.join(truth, ["k", "d"], "left_anti")),
        },
    )


# ---------------------------------------------------------------- DQ-29, DQ-29b: more rules

RATE_TOLERANCE = 0.03
# ---- fixed values: expected rates of the given data ----
EXPECTED = {"urgent_share": 0.2, "returned_share": 1 / 3, "fulfilled_share": 0.5}
# ---------------------------------------------------------
RATES = {
    "urgent_share": ("orders", "o_orderpriority = '1-URGENT'"),
    "returned_share": ("lineitem", "l_returnflag = 'R'"),
    "fulfilled_share": ("lineitem", "l_linestatus = 'F'"),
}


@query(
    "dq29b_rates_follow_parameters",
    sql="\nUNION ALL\n".join(
        f"""SELECT '{n}' AS rate, round(avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END), 6) AS measured, CAST({EXPECTED[n]!r} AS DOUBLE) AS expected,
       abs(avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END) - {EXPECTED[n]!r}) <= {RATE_TOLERANCE} AS within FROM {table}"""
        for n, (table, cond) in RATES.items()
    ),
    ops=("DQ-29b",),
)
def dq29b_rates_follow_parameters(spark, sf_dir):
    """Measured shares against the declared parameter, within a tolerance."""
    t = Tables(spark, sf_dir)
    parts = []
    for name, (table, cond) in RATES.items():
        share = F.avg(F.when(F.expr(cond), 1.0).otherwise(0.0))
        parts.append(
            getattr(t, table).agg(F.round(share, 6).alias("measured"), (F.abs(share - EXPECTED[name]) <= RATE_TOLERANCE).alias("within")).select(
                F.lit(name).alias("rate"), "measured", F.lit(EXPECTED[name]).alias("expected"), "within"
            )
        )
    return _union(parts)


CENSOR_DAYS = 30


@query(
    "dq29b_mean_stay_censored",
    sql=f"""WITH cut AS (SELECT max(CAST(l_shipdate AS DATE)) - {CENSOR_DAYS} AS d FROM lineitem)
SELECT o_orderpriority AS service, COUNT(*) AS n_stays, COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) > (SELECT d FROM cut)) AS n_censored,
       round(avg(CASE WHEN CAST(o_orderdate AS DATE) <= (SELECT d FROM cut) THEN datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) END), 6) AS mean_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate GROUP BY 1""",
    ops=("DQ-29b", "IN-49"),
)
def dq29b_mean_stay_censored(spark, sf_dir):
    """Mean days from order to shipment by priority, without those that began too late to be
    seen to their end."""
    t = Tables(spark, sf_dir)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).filter(F.col("l_shipdate") >= F.col("o_orderdate"))
    cut = t.lineitem.select(F.date_sub(F.max(F.to_date("l_shipdate")), CENSOR_DAYS)).scalar()
    start = F.to_date("o_orderdate")
    return j.groupBy(F.col("o_orderpriority").alias("service")).agg(
        F.count(F.lit(1)).alias("n_stays"),
        F.count_if(start > cut).alias("n_censored"),
        F.round(F.avg(F.when(start <= cut, F.datediff(F.to_date("l_shipdate"), start))), 6).alias("mean_days"),
    )


RULES = {
    "line_part_known": "SELECT COUNT(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)",
    "line_supplier_known": "SELECT COUNT(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)",
    "order_has_lines": "SELECT COUNT(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "customer_nation_known": "SELECT COUNT(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey)",
    "nation_region_known": "SELECT COUNT(*) FROM nation WHERE NOT EXISTS (SELECT 1 FROM region WHERE r_regionkey = n_regionkey)",
    "label_has_document": "SELECT COUNT(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)",
    "stated_length_true": "SELECT COUNT(*) FROM documents WHERE n_chars <> length(text)",
    "turns_gapless": "SELECT COUNT(*) FROM (SELECT conv_id FROM conversations GROUP BY conv_id HAVING max(turn) - min(turn) + 1 <> COUNT(DISTINCT turn))",
}


@query(
    "dq29_cross_table_rules",
    sql="\nUNION ALL\n".join(f"SELECT '{n}' AS rule, ({sql}) AS n_violations" for n, sql in RULES.items()),
    ops=("DQ-29", "JN-8", "JN-7"),
)
def dq29_cross_table_rules(spark, sf_dir):
    """Rules across the given tables: every reference is known, stated lengths and turns hold."""
    t = Tables(spark, sf_dir)

    def unknown(df: DataFrame, col: str, other: DataFrame, key: str) -> Column:
        return df.join(other.select(F.col(key).alias(col)).distinct(), col, "left_anti").select(F.count(F.lit(1))).scalar()

    turns = t.conversations.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1).alias("span"), F.countDistinct("turn").alias("n"))
    found = {
        "line_part_known": unknown(t.lineitem, "l_partkey", t.part, "p_partkey"),
        "line_supplier_known": unknown(t.lineitem, "l_suppkey", t.supplier, "s_suppkey"),
        "order_has_lines": unknown(t.orders, "o_orderkey", t.lineitem, "l_orderkey"),
        "customer_nation_known": unknown(t.customer, "c_nationkey", t.nation, "n_nationkey"),
        "nation_region_known": unknown(t.nation, "n_regionkey", t.region, "r_regionkey"),
        "label_has_document": unknown(t.labels, "doc_id", t.documents, "doc_id"),
        "stated_length_true": t.documents.filter(F.col("n_chars") != F.length("text")).select(F.count(F.lit(1))).scalar(),
        "turns_gapless": turns.filter(F.col("span") != F.col("n")).select(F.count(F.lit(1))).scalar(),
    }
    row = measures_row(spark, found)
    return row.unpivot([], list(found), "rule", "n_violations")


# ---------------------------------------------------------------- DQ-47: registry and stored columns

STORED = {"lineitem": LINEITEM_LANDING, "orders": ORDERS_LANDING, "events": EVENTS_LANDING}


def _declared() -> list[tuple[str, str]]:
    return [(table, c.name) for table, spec in STORED.items() for c in spec.columns]


@query(
    "dq47_registry_vs_stored_columns",
    sql="WITH reg(table_name, column_name) AS (VALUES "
    + ", ".join(f"('{a}', '{b}')" for a, b in _declared())
    + "), cat AS ("
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, column_name FROM (DESCRIBE {t})" for t in STORED)
    + """), n AS ("""
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in STORED)
    + """)
SELECT table_name, column_name, r.column_name IS NOT NULL AS in_registry, c.column_name IS NOT NULL AS in_table, n_rows
FROM reg r FULL OUTER JOIN cat c USING (table_name, column_name) JOIN n USING (table_name)""",
    ops=("DQ-47",),
)
def dq47_registry_vs_stored_columns(spark, sf_dir):
    """Declared columns and the columns of the stored tables, both ways, with the rows behind."""
    t = Tables(spark, sf_dir)
    reg = spark.createDataFrame(_declared(), "table_name string, column_name string").withColumn("in_registry", F.lit(True))
    tables = {name: getattr(t, name) for name in STORED}
    cat = spark.createDataFrame([(n, c) for n, df in tables.items() for c in df.columns], "table_name string, column_name string").withColumn("in_table", F.lit(True))
    rows = _union([df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(n)) for n, df in tables.items()])
    both = reg.join(cat, ["table_name", "column_name"], "full_outer").join(rows, "table_name")
    return both.select("table_name", "column_name", F.coalesce("in_registry", F.lit(False)).alias("in_registry"), F.coalesce("in_table", F.lit(False)).alias("in_table"), "n_rows")


# ---------------------------------------------------------------- IN-45, IN-48, IN-49


@query(
    "in45_relative_drop",
    sql="""WITH d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1),
w AS (SELECT CAST(isodow(day) AS INTEGER) AS iso_weekday, SUM(n)::DOUBLE / COUNT(*) AS mean_open FROM d GROUP BY 1),
ref AS (SELECT SUM(n)::DOUBLE / COUNT(*) AS m FROM d WHERE isodow(day) <= 5)
SELECT iso_weekday, round(mean_open, 6) AS mean_per_open_day, round(1 - mean_open / (SELECT m FROM ref), 6) AS relative_drop FROM w""",
    ops=("IN-45",),
)
def in45_relative_drop(spark, sf_dir):
    """Mean per open day of each weekday, and its drop against working days as a whole."""
    t = Tables(spark, sf_dir)
    days = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    weekday = F.weekday("day") + 1
    reference = days.filter(weekday <= 5).select(ratio(F.sum("n"), F.count(F.lit(1)))).scalar()
    mean = ratio(F.sum("n"), F.count(F.lit(1)))
    return days.groupBy(weekday.cast("int").alias("iso_weekday")).agg(F.round(mean, 6).alias("mean_per_open_day"), F.round(1 - mean / reference, 6).alias("relative_drop"))


@query(
    "in48_quality_by_table",
    sql=with_sql(*_checked_ctes())
    + "\nSELECT table_name, n_read, n_rejected, round(n_rejected::DOUBLE / n_read, 6) AS reject_rate, "
    + "CAST(row_number() OVER (ORDER BY n_rejected::DOUBLE / n_read DESC, table_name) AS INTEGER) AS rank FROM ("
    + "\nUNION ALL\n".join(f"SELECT '{sp.name}' AS table_name, CAST(SUM(n_read) AS BIGINT) AS n_read, CAST(SUM(n_rejected) AS BIGINT) AS n_rejected FROM {sp.name}_gate" for sp, _, _ in SPECS)
    + ")",
    ops=("IN-48", "WN-7"),
)
def in48_quality_by_table(spark, sf_dir):
    """Rows read and rejected per extract, ranked by reject rate."""
    from pyspark.sql import Window

    t = Tables(spark, sf_dir)
    parts = []
    for spec, build, _ in SPECS:
        gate = Q.file_gate(Q.check_rows(build(t), spec, "path_date"), ["path_date"])
        parts.append(gate.agg(F.sum("n_read").cast("long").alias("n_read"), F.sum("n_rejected").cast("long").alias("n_rejected")).withColumn("table_name", F.lit(spec.name)))
    rate = F.col("n_rejected") / F.col("n_read")
    rank = F.row_number().over(Window.orderBy(rate.desc(), "table_name"))  # one row per extract
    return _union(parts).select("table_name", "n_read", "n_rejected", F.round(rate, 6).alias("reject_rate"), rank.cast("int").alias("rank"))


@query(
    "in49_amount_share_by_type",
    sql="""SELECT o_orderpriority AS order_type, COUNT(*) AS n_orders, round(COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM orders), 6) AS share,
       round(SUM(o_totalprice)::DOUBLE / (SELECT SUM(o_totalprice) FROM orders), 6) AS amount_share,
       round(quantile_cont(o_totalprice, 0.5), 4) AS median_amount, round(quantile_cont(o_totalprice, 0.9), 4) AS p90_amount
FROM orders GROUP BY 1""",
    ops=("IN-49", "WN-4", "AG-4"),
)
def in49_amount_share_by_type(spark, sf_dir):
    """Per order type: share of orders and of the amount, median and 90th percentile.

    Amounts are nearly all different, so their percentiles are selected, not buffered.
    """
    o = Tables(spark, sf_dir).orders.withColumns({"order_type": F.col("o_orderpriority"), "price": F.col("o_totalprice").cast("double")})
    total = o.select(F.sum("price")).scalar()
    n = o.select(F.count(F.lit(1))).scalar()
    shares = o.groupBy("order_type").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.count(F.lit(1)) / n, 6).alias("share"), F.round(F.sum("price") / total, 6).alias("amount_share")
    )
    levels = exact_percentiles(o, ["order_type"], "price", {"median_amount": 0.5, "p90_amount": 0.9})
    levels = levels.select(F.col("order_type").alias("_type"), F.round("median_amount", 4).alias("median_amount"), F.round("p90_amount", 4).alias("p90_amount"))
    return shares.join(levels, F.col("order_type").eqNullSafe(F.col("_type")), "left").drop("_type")


# ---------------------------------------------------------------- DQ-45: yearly volumes

VOLUME_TOLERANCE = 0.25
VOLUMES = {"orders": ("orders", "o_orderdate"), "shipments": ("lineitem", "l_shipdate")}


@query(
    "dq45_yearly_volumes_vs_mean",
    sql="\nUNION ALL\n".join(
        f"""SELECT '{n}' AS family, CAST(y AS INTEGER) AS year, c AS n_rows, round(m, 6) AS target, round(abs(c - m) / m, 6) AS relative_gap, abs(c - m) / m <= {VOLUME_TOLERANCE} AS within
FROM (SELECT y, c, avg(c) OVER () AS m FROM (SELECT year({col}) AS y, COUNT(*) AS c FROM {table} GROUP BY 1))"""
        for n, (table, col) in VOLUMES.items()
    ),
    ops=("DQ-45",),
)
def dq45_yearly_volumes_vs_mean(spark, sf_dir):
    """Yearly volumes of each family against the mean of its years."""
    t = Tables(spark, sf_dir)
    parts = []
    for name, (table, col) in VOLUMES.items():
        per = getattr(t, table).groupBy(F.year(col).alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))
        target = per.select(F.avg("n_rows")).scalar()
        gap = F.abs(F.col("n_rows") - target) / target
        parts.append(per.select(F.lit(name).alias("family"), "year", "n_rows", F.round(target, 6).alias("target"), F.round(gap, 6).alias("relative_gap"), (gap <= VOLUME_TOLERANCE).alias("within")))
    return _union(parts)
