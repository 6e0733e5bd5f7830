"""Set operations over DataFrames: code sets, two-way differences, measure rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def code_set(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """ST-2: distinct (code_type, code) of several coded columns in ONE scan.

    ``columns`` = [(code_type, column), ...]. Equivalent to a UNION of one
    SELECT per column, without re-reading the table per column.
    """
    pairs = F.array(*[F.struct(F.lit(t).alias("code_type"), F.col(c).alias("code")) for t, c in columns])
    return (
        df.select(F.explode(pairs).alias("p"))
        .select("p.code_type", "p.code")
        .filter(F.col("code").isNotNull())
        .distinct()
    )


def two_way_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ST-3: one row with the counts of distinct keys only on the left / only on the right.

    A full outer join of the distinct key sets, so each side is shuffled once.
    """
    a = left.select(*keys).distinct().withColumn("_l", F.lit(True))
    b = right.select(*keys).distinct().withColumn("_r", F.lit(True))
    j = a.join(b, list(keys), "full_outer")
    return j.agg(
        F.count_if(F.col("_r").isNull()).alias("n_left_only"),
        F.count_if(F.col("_l").isNull()).alias("n_right_only"),
        F.count_if(F.col("_l") & F.col("_r")).alias("n_both"),
    )


def measures_row(spark: SparkSession, measures: dict[str, Column]) -> DataFrame:
    """JN-14: put single-value measures side by side in one row.

    Each measure is a scalar subquery (``DataFrame.scalar()``), evaluated once;
    no cross join is planned.
    """
    return spark.range(1).select(*[c.alias(n) for n, c in measures.items()])


def scalar(df: DataFrame, expr: Column) -> Column:
    """The single value of an aggregate over ``df`` as a scalar-subquery column."""
    return df.select(expr).scalar()
