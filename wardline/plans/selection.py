"""Periods and selections: declared date filters, filtered exports, period loads, reference date."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.plans import landing, sqlgen
from wardline.plans.catalog import query
from wardline.plans.landing import with_sql
from wardline.registry import LINEITEM_LANDING
from wardline.sinks import files
from wardline.sinks.landing_io import load, read_source, write_landing
from wardline.sinks.snapshot import export_selection
from wardline.sources.tables import Tables
from wardline.streaming.landing_stream import data_reference_date

PERIOD = (dt.date(1996, 1, 1), dt.date(1996, 12, 31))

#: the date column that a period filters for each indicator; None: the indicator has no period
DATE_COLUMNS: dict[str, tuple[str, str | None]] = {
    "orders": ("orders", "o_orderdate"),
    "shipments": ("lineitem", "l_shipdate"),
    "events": ("events", "ts"),
    "parts": ("part", None),
    "documents": ("documents", None),
}


def in_period(df: DataFrame, indicator: str, period: tuple[dt.date, dt.date]) -> DataFrame:
    """FLT-1: the rows of ``period`` by the indicator's declared column; all rows if it has none."""
    if indicator not in DATE_COLUMNS:
        raise KeyError(f"no period is declared for {indicator!r}")
    column = DATE_COLUMNS[indicator][1]
    if column is None:
        return df
    # half-open on the raw column, so the filter reaches the scan
    return df.filter((F.col(column) >= F.lit(period[0])) & (F.col(column) < F.lit(period[1] + dt.timedelta(days=1))))


@query(
    "flt1_declared_periods",
    sql="\nUNION ALL\n".join(
        f"SELECT '{n}' AS indicator, {'TRUE' if c else 'FALSE'} AS filterable, COUNT(*) AS n_rows FROM {t}"
        + (f" WHERE {c} >= DATE '{PERIOD[0]}' AND {c} < DATE '{PERIOD[1] + dt.timedelta(days=1)}'" if c else "")
        for n, (t, c) in DATE_COLUMNS.items()
    ),
    ops=("FLT-1",),
)
def flt1_declared_periods(spark, sf_dir):
    """Each indicator's rows in one period, by its own declared date column."""
    t = Tables(spark, sf_dir)
    parts = [
        in_period(getattr(t, table), name, PERIOD).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("indicator"), F.lit(column is not None).alias("filterable"), "n_rows")
        for name, (table, column) in DATE_COLUMNS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "snk13_filtered_export",
    sql=f"""SELECT o_orderpriority, COUNT(*) AS n_rows, round(SUM(o_totalprice), 2) AS amount FROM orders
WHERE o_orderdate >= DATE '{PERIOD[0]}' AND o_orderdate < DATE '{PERIOD[1] + dt.timedelta(days=1)}' GROUP BY 1""",
    ops=("SNK-13", "IN-40"),
)
def snk13_filtered_export(spark, sf_dir):
    """Every row of a filtered selection written as CSV, and counted from what was written."""
    path = f"{files.fresh_dir(spark, 'selection')}/orders"
    export_selection(in_period(Tables(spark, sf_dir).orders, "orders", PERIOD), F.lit(True), path)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(F.col("o_totalprice").cast("double")), 2).alias("amount"))


GATE = with_sql(
    landing.LINEITEM_LANDING_SQL,
    sqlgen.checked_cte(LINEITEM_LANDING, "lineitem_landing", "chk"),
    sqlgen.gate_cte("chk", "gate", LINEITEM_LANDING.name),
)


@query(
    "src3_period_load_reference_date",
    sql=GATE
    + f"""
SELECT COUNT(*) AS n_dates, CAST(SUM(n_inserted) AS BIGINT) AS n_source, max(CASE WHEN n_inserted > 0 THEN path_date END) AS reference_date
FROM gate WHERE path_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'""",
    ops=("SRC-3", "SS-3", "SNK-1"),
)
def src3_period_load_reference_date(spark, sf_dir):
    """A load of one period only: dates reported, rows written, and the reference date, which
    is the latest extraction date loaded."""
    root, target = files.fresh_dir(spark, "landing"), files.fresh_dir(spark, "target")
    write_landing(landing.lineitem_landing(Tables(spark, sf_dir)), root, LINEITEM_LANDING)
    report = load(spark, root, target, LINEITEM_LANDING, date_from=PERIOD[0], date_to=PERIOD[1])
    written = read_source(spark, target, LINEITEM_LANDING).select(F.count(F.lit(1))).scalar()
    reference = data_reference_date(spark, target, [LINEITEM_LANDING])
    return report.agg(F.count(F.lit(1)).alias("n_dates")).select("n_dates", written.alias("n_source"), F.lit(reference).cast("date").alias("reference_date"))
