"""Calendar rules (SRC-6, GEN-2, GEN-3) exploded to days by Spark.

The rule table is tiny and fixed; the days it yields are bounded by the number
of days in the period, so the result is broadcast when joined to facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: public-holiday calendar ----------------------------------
# Fixed holidays: (month, day, label, first year the holiday applies or None).
FIXED_HOLIDAYS = [
    (1, 1, "new_year", None),
    (1, 11, "independence_manifesto", None),
    (1, 14, "amazigh_new_year", None),
    (5, 1, "labour_day", None),
    (7, 30, "throne_day", None),
    (8, 14, "oued_eddahab", None),
    (8, 20, "revolution_king_people", None),
    (8, 21, "youth_day", None),
    (10, 31, "unity_day", 2026),
    (11, 6, "green_march", None),
    (11, 18, "independence_day", None),
]
# Movable observances per year: (year, Ramadan first day, Ramadan last day,
# Eid al-Fitr first day, Eid al-Adha first day).
MOVABLE = [
    (2024, "2024-03-11", "2024-04-09", "2024-04-10", "2024-06-17"),
    (2025, "2025-03-01", "2025-03-30", "2025-03-31", "2025-06-07"),
    (2026, "2026-02-19", "2026-03-19", "2026-03-20", "2026-05-27"),
]
EID_DAYS = 2
# -----------------------------------------------------------------------------

CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("category", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)


def calendar_days(spark: SparkSession, years: DataFrame) -> DataFrame:
    """Calendar seed rows (day, category, label) for ``years`` (a column ``year``).

    category in ('fixed_holiday', 'movable_holiday', 'ramadan'); fixed rules are
    exploded over the years, movable ones over their spans.
    """
    fixed = spark.createDataFrame(
        [(m, d, f"fixed_{label}", first) for m, d, label, first in FIXED_HOLIDAYS],
        "month int, dom int, label string, first_year int",
    )
    every = F.col("first_year").isNull() | (F.col("year") >= F.col("first_year"))
    fixed_days = (
        years.join(fixed, every)  # a few rules for each year of the data
        .select(
            F.make_date("year", "month", "dom").alias("day"),
            F.lit("fixed_holiday").alias("category"),
            "label",
        )
    )
    movable = spark.createDataFrame(
        [
            (y, dt.date.fromisoformat(a), dt.date.fromisoformat(b), dt.date.fromisoformat(c), dt.date.fromisoformat(d))
            for y, a, b, c, d in MOVABLE
        ],
        "year int, ramadan_start date, ramadan_end date, fitr date, adha date",
    ).join(years, "year", "left_semi")
    eid = movable.select(
        F.explode(
            F.array(
                F.struct(F.col("fitr").alias("start"), F.lit("eid_al_fitr").alias("label")),
                F.struct(F.col("adha").alias("start"), F.lit("eid_al_adha").alias("label")),
            )
        ).alias("e")
    ).select(
        F.explode(F.sequence(F.col("e.start"), F.date_add(F.col("e.start"), EID_DAYS - 1))).alias("day"),
        F.lit("movable_holiday").alias("category"),
        F.col("e.label").alias("label"),
    )
    ramadan = movable.select(
        F.explode(F.sequence("ramadan_start", "ramadan_end")).alias("day"),
        F.lit("ramadan").alias("category"),
        F.lit("ramadan").alias("label"),
    )
    return fixed_days.unionByName(eid).unionByName(ramadan)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def calendar_sql(lo: str, hi: str) -> str:
    """The same days in DuckDB SQL, from the rule rows; ``lo`` and ``hi`` are year expressions."""
    return f"""(
  WITH fixed(month, dom, label, first_year) AS (VALUES {_values(FIXED_HOLIDAYS)}),
       movable(year, r_from, r_to, fitr, adha) AS (VALUES {_values(MOVABLE)}),
       feast AS (SELECT CAST(fitr AS DATE) AS start, 'eid_al_fitr' AS label, year FROM movable
                 UNION ALL SELECT CAST(adha AS DATE), 'eid_al_adha', year FROM movable)
  SELECT make_date(y, month, dom) AS day, 'fixed_holiday' AS category, 'fixed_' || label AS label
  FROM fixed, generate_series({lo}, {hi}) AS g(y) WHERE first_year IS NULL OR y >= first_year
  UNION ALL
  SELECT start + CAST(k AS INTEGER), 'movable_holiday', label FROM feast, generate_series(0, {EID_DAYS - 1}) AS g(k) WHERE year BETWEEN {lo} AND {hi}
  UNION ALL
  SELECT CAST(unnest(generate_series(CAST(r_from AS DATE), CAST(r_to AS DATE), INTERVAL 1 DAY)) AS DATE), 'ramadan', 'ramadan'
  FROM movable WHERE year BETWEEN {lo} AND {hi}) AS cal(day, category, label)"""
