"""Valid embedding vectors, and equal vectors as one class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid(col: str):
    """Not null, without null or non-finite components, and not all zero."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(col) > 0) & F.forall(col, lambda x: F.coalesce(good(x), F.lit(False))) & F.exists(col, lambda x: x != 0), F.lit(False))


def normal_zeros(col: str):
    """-0.0 as 0.0, so that equal vectors are equal arrays."""
    return F.transform(col, lambda x: x + F.lit(0.0).cast("float"))


def numbered(df: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the valid vectors."""
    return df.where(F.col("vec_id").isNotNull() & valid("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")


#: the valid vectors as doubles, in DuckDB
VALID_SQL = """
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0)"""
