"""Column expressions: text typing, date arithmetic, guarded ratios, buckets.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.registry import DATE_FORMAT, TIMESTAMP_FORMAT, TYPED, Col

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """FN-1: empty string means missing."""
    return F.nullif(_c(c), F.lit(""))


def text_to_date(c: ColumnOrName, fmt: str = DATE_FORMAT) -> Column:
    """FN-2: strict two-digit ``MM/dd/yyyy``; NULL when blank or malformed."""
    return F.to_date(F.try_to_timestamp(blank_to_null(c), F.lit(fmt)))


def text_to_timestamp(c: ColumnOrName, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """FN-2: 12-hour clock with AM/PM; NULL when blank or malformed. The result is a
    wall-clock instant without zone (TIMESTAMP_NTZ), as written in the extract."""
    return F.try_to_timestamp(blank_to_null(c), F.lit(fmt)).cast("timestamp_ntz")


def text_to_decimal(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    return blank_to_null(c).try_cast(f"decimal({precision},{scale})")


def text_to_integer(c: ColumnOrName) -> Column:
    return blank_to_null(c).try_cast("int")


def text_to_boolean(c: ColumnOrName) -> Column:
    c = _c(c)
    return F.when(c == "1", F.lit(True)).when(c == "0", F.lit(False))


def typed_value(col: Col) -> Column:
    """PRJ-1: the typed projection of one declared landing column."""
    raw = F.col(col.name)
    if col.kind in ("code", "text"):
        out = blank_to_null(raw)
    elif col.kind == "date":
        out = text_to_date(raw)
    elif col.kind == "timestamp":
        out = text_to_timestamp(raw)
    elif col.kind == "decimal":
        out = text_to_decimal(raw)
    elif col.kind == "integer":
        out = text_to_integer(raw)
    elif col.kind == "boolean":
        out = text_to_boolean(raw)
    else:  # pragma: no cover - guarded by Col
        raise ValueError(col.kind)
    return out.cast(TYPED[col.kind]).alias(col.name)


def to_day(c: ColumnOrName) -> Column:
    """FN-3."""
    return F.to_date(_c(c))


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """FN-4: whole days, date minus date."""
    return F.datediff(to_day(later), to_day(earlier))


def minutes_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """FN-5: elapsed minutes as a double (epoch difference / 60)."""
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / F.lit(60e6)


def elapsed_days(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """FN-5: elapsed days as a double (epoch difference / 86400)."""
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / F.lit(86400e6)


def iso_weekday(c: ColumnOrName) -> Column:
    """FN-6: Monday = 1 .. Sunday = 7."""
    return F.weekday(_c(c)) + 1


def is_weekend(c: ColumnOrName) -> Column:
    return iso_weekday(c) >= 6


def decimal_year(c: ColumnOrName) -> Column:
    """FN-9: ``year + (month - 1) / 12`` rounded to 6 places."""
    c = _c(c)
    return F.round(F.year(c) + (F.month(c) - 1) / F.lit(12.0), 6)


def distinct_from(a: ColumnOrName, b: ColumnOrName) -> Column:
    """FN-11: ``a IS DISTINCT FROM b``."""
    return ~_c(a).eqNullSafe(_c(b))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """FN-12: ``num / nullif(den, 0)`` as double."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def bucket_label(value: ColumnOrName, bounds: Sequence[int], unit: str = "d") -> Column:
    """FN-24: label of the bucket ``value`` falls into for ascending ``bounds``.

    With bounds (30, 60, 90, 180): '0-30d', '31-60d', '61-90d', '91-180d', '>180d'.
    """
    value = _c(value)
    expr = None
    low = 0
    for b in bounds:
        label = f"{low}-{b}{unit}"
        cond = value <= b
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        low = b + 1
    return expr.when(value.isNotNull(), F.lit(f">{bounds[-1]}{unit}"))


def concat_code(prefix: str, c: ColumnOrName) -> Column:
    """FN-14."""
    return F.concat(F.lit(prefix), _c(c))
