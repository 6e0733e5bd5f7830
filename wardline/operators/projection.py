"""PRJ-1: registry-driven typed projection of an all-text landing table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardline.functions.conversions import typed_value
from wardline.registry import TableSpec


def type_table(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ("path_date",)) -> DataFrame:
    """Each declared column through its kind's conversion; blanks and malformed
    values become NULL (the row checks, not the typing, report them)."""
    extra = [c for c in keep if c in df.columns]
    return df.select(*[typed_value(c) for c in spec.columns], *extra)
