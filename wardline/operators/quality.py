"""Row checks, uniqueness, the file-level gate and the accepted / quarantine split.

Reasons are strings ``kind:column:value`` kept in an array, in declared column
order, then the partition check, then uniqueness last. Emptiness passes every
value check ('0' is a value). Nothing here collects rows to the driver.

Reason kinds: type_date, type_timestamp, type_decimal, type_integer,
boolean_domain, low_bound, after_extraction, partition_mismatch, empty_key,
duplicate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.conversions import text_to_date, text_to_decimal, text_to_integer, text_to_timestamp
from wardline.registry import (
    BLOCKING_REJECT_FLOOR,
    BOOLEAN_DOMAIN,
    DATE_FORMAT,
    REJECT_RATE_THRESHOLD,
    TableSpec,
)
from wardline.sinks.scratch import Scratch

REASONS = "reasons"


def _reason(kind: str, column: str, value: Column) -> Column:
    return F.concat(F.lit(f"{kind}:{column}:"), value)


def column_reason_exprs(spec: TableSpec) -> list[Column]:
    """DQ-1..6: one nullable reason expression per check, in column order."""
    exprs: list[Column] = []
    parsed_extraction = text_to_date(F.col(spec.partition_col)) if spec.partition_col in spec.names else None
    for col in spec.columns:
        raw = F.col(col.name)
        present = raw != F.lit("")
        if col.kind in ("date", "timestamp"):
            parsed = text_to_date(raw) if col.kind == "date" else text_to_timestamp(raw)
            ok = present & parsed.isNotNull()
            exprs.append(F.when(present & parsed.isNull(), _reason(f"type_{col.kind}", col.name, raw)))
            if col.low_bound is not None:
                bound = F.lit(col.low_bound)
                low = parsed < (bound if col.kind == "date" else bound.cast("timestamp"))
                exprs.append(F.when(ok & low, _reason("low_bound", col.name, raw)))
            if col.not_after is not None and parsed_extraction is not None:
                limit = parsed_extraction if col.kind == "date" else parsed_extraction.cast("timestamp")
                exprs.append(F.when(ok & (parsed > limit), _reason("after_extraction", col.name, raw)))
        elif col.kind == "decimal":
            # the declared type must hold the value without rounding it
            exact = raw.try_cast("decimal(38,18)")
            bad = present & ~F.coalesce(text_to_decimal(raw) == exact, F.lit(False))
            exprs.append(F.when(bad, _reason("type_decimal", col.name, raw)))
        elif col.kind == "integer":
            bad = present & text_to_integer(raw).isNull()
            exprs.append(F.when(bad, _reason("type_integer", col.name, raw)))
        elif col.kind == "boolean":
            bad = present & ~raw.isin(*BOOLEAN_DOMAIN)
            exprs.append(F.when(bad, _reason("boolean_domain", col.name, raw)))
    return exprs


def partition_reason_expr(spec: TableSpec, path_date_col: str) -> Column:
    """DQ-8: the row's extraction date must equal the date of the file's partition."""
    raw = F.col(spec.partition_col)
    expected = F.date_format(F.col(path_date_col), DATE_FORMAT)
    return F.when((raw != F.lit("")) & (raw != expected), _reason("partition_mismatch", spec.partition_col, raw))


def with_row_reasons(df: DataFrame, spec: TableSpec, path_date_col: str | None = "path_date") -> DataFrame:
    """DQ-8b (without uniqueness): accumulate every row-level reason."""
    exprs = column_reason_exprs(spec)
    if path_date_col is not None:
        exprs.append(partition_reason_expr(spec, path_date_col))
    return df.withColumn(REASONS, F.array_compact(F.array(*exprs)))


def uniqueness_flags(
    df: DataFrame, key: tuple[str, ...] | list[str], scope: list[str], chunk: int = 4096, scratch: Scratch | None = None
) -> DataFrame:
    """DQ-7: flag, inside each ``scope`` (one partition file), the 2nd+ row of a key.

    "First" is the smallest row content (all columns, byte order) because a
    distributed scan has no file order; exact copies are interchangeable, so
    exactly one copy of the smallest row is kept. Rows with an empty key part
    are flagged ``_empty`` and take no part in the check.

    Only the keys are counted over all rows. Those that come more than once are kept (in
    ``scratch``, which the rows returned read from), so that Spark knows their size and
    broadcasts them where they are few; rows of other keys stay where they are, and whole
    rows move for repeated keys only.
    """
    key = list(key)
    keys = [*scope, *key]
    content = list(df.columns)
    empty = reduce(lambda a, b: a | b, [F.col(k) == F.lit("") for k in key])
    taking_part = df.filter(~F.coalesce(empty, F.lit(False)))
    counted = taking_part.groupBy(*[F.col(c).alias(f"_k_{c}") for c in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    scratch = scratch or Scratch(df.sparkSession, "repeated-keys")
    repeated = scratch.keep(counted.filter(F.col("_rows") > 1).drop("_rows"), "repeated")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    alone = df.join(repeated, same, "left_anti").select(*content, empty.alias("_empty"), F.lit(False).alias("_dup"))
    return alone.unionByName(_repeated_flags(df.join(repeated, same, "left_semi"), key, scope, chunk))


def _repeated_flags(df: DataFrame, key: list[str], scope: list[str], chunk: int) -> DataFrame:
    """The flags of rows whose keys repeat.

    Rows are aggregated by full content (identical copies collapse map-side into a count), and
    both sides of the join back, the contents and each key's smallest content, start from that
    same exchange. It stays the same on both sides because nothing is filtered (empty keys are
    a condition inside the aggregate) and because the null-safe join implies no filter. No
    window over a key.
    """
    content = list(df.columns)
    empty = reduce(lambda a, b: a | b, [F.col(k) == F.lit("") for k in key])
    copies = df.groupBy(*content).agg(F.count(F.lit(1)).alias("_n")).withColumn("_empty", empty)
    per_key = copies.groupBy(*[F.col(c).alias(f"_k_{c}") for c in (*scope, *key)]).agg(
        F.min(F.when(~F.col("_empty"), F.struct(*content))).alias("_first"), F.sum("_n").alias("_key_rows")
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*scope, *key)])
    j = copies.join(per_key, same, "left")
    is_first = F.struct(*content) == F.col("_first")
    n_dup = (
        F.when(F.col("_empty") | (F.col("_key_rows") <= 1), F.lit(0))
        .when(is_first, F.col("_n") - 1)
        .otherwise(F.col("_n"))
    )
    j = j.select(*content, "_empty", "_n", (F.col("_n") - n_dup).alias("_keep"), n_dup.alias("_dupn"))

    def expand(keep: Column, dup: Column) -> Column:
        return F.explode(
            F.concat(F.array_repeat(F.lit(False), keep.cast("int")), F.array_repeat(F.lit(True), dup.cast("int")))
        ).alias("_dup")

    # copies of a row are restored by a two-level explode (chunk ids, then at most
    # `chunk` copies each): memory stays bounded however often one row is repeated
    chunks = j.select(
        *content, "_empty", "_n", "_keep", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / chunk).cast("int") - 1)).alias("_c")
    )
    in_chunk = F.least(F.lit(chunk), F.col("_n") - F.col("_c") * chunk)
    keep_c = F.when(F.col("_c") == 0, F.col("_keep")).otherwise(F.lit(0))
    return chunks.select(*content, "_empty", expand(keep_c, in_chunk - keep_c))


def with_uniqueness_reasons(flagged: DataFrame, key, reasons_col: str = REASONS) -> DataFrame:
    key = list(key)
    key_name = ",".join(key)
    extra = F.array_compact(
        F.array(
            F.when(F.col("_empty"), F.lit(f"empty_key:{key_name}")),
            F.when(F.col("_dup"), F.concat(F.lit(f"duplicate:{key_name}:"), F.concat_ws("|", *[F.col(k) for k in key]))),
        )
    )
    return flagged.withColumn(reasons_col, F.concat(F.col(reasons_col), extra)).drop("_empty", "_dup")


def check_rows(df: DataFrame, spec: TableSpec, path_date_col: str = "path_date", scratch: Scratch | None = None) -> DataFrame:
    """All row checks of one landing table; scope of uniqueness = the partition file.

    Uniqueness is decided on the raw text first; the per-column reasons are then
    computed once per row (a narrow projection) and the uniqueness reason goes last.
    """
    flagged = uniqueness_flags(df, spec.key, [path_date_col], scratch=scratch)
    return with_uniqueness_reasons(with_row_reasons(flagged, spec, path_date_col), spec.key)


def file_gate(
    checked: DataFrame,
    scope: list[str],
    threshold: float = REJECT_RATE_THRESHOLD,
    floor: int = BLOCKING_REJECT_FLOOR,
    table_name: str | None = None,
) -> DataFrame:
    """DQ-8d/8e: one row per file with read / rejected counts and the load state.

    A file is blocked when its reject rate exceeds ``threshold`` and it holds at
    least ``floor`` rejected rows; a blocked file writes nothing.
    """
    stats = checked.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(F.size(REASONS) > 0).alias("n_rejected"),
    )
    blocked = (F.col("n_read") > 0) & (
        F.col("n_rejected").cast("double") / F.col("n_read") > F.lit(threshold)
    ) & (F.col("n_rejected") >= F.lit(floor))
    out = stats.select(
        *scope,
        F.when(blocked, F.lit("blocked")).otherwise(F.lit("loaded")).alias("state"),
        "n_read",
        F.when(blocked, F.lit(0)).otherwise(F.col("n_read") - F.col("n_rejected")).cast("long").alias("n_inserted"),
        "n_rejected",
    )
    if table_name is not None:
        out = out.withColumn("table_name", F.lit(table_name))
    return out


def outcome(checked: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """What the gate and the quarantine need of checked rows, kept: every row's scope and
    reasons, the other columns of rejected rows only (NULL for the others)."""
    held = [F.when(F.size(REASONS) > 0, F.col(c)).alias(c) for c in checked.columns if c not in ("path_date", REASONS)]
    scratch = scratch or Scratch(checked.sparkSession, "outcome")
    return scratch.keep(checked.select(*held, "path_date", REASONS), "outcome")


def split_loaded(checked: DataFrame, gate: DataFrame, scope: list[str]) -> tuple[DataFrame, DataFrame]:
    """DQ-8c: accepted and quarantined rows of the files the gate lets through.

    The gate has one row per extraction date; Spark broadcasts it by its size.
    """
    loaded = gate.filter(F.col("state") == "loaded").select(*scope)
    kept = checked.join(loaded, on=scope, how="left_semi")
    accepted = kept.filter(F.size(REASONS) == 0).drop(REASONS)
    rejected = kept.filter(F.size(REASONS) > 0)
    return accepted, rejected


def quarantine_rows(rejected: DataFrame, path_date_col: str = "path_date") -> DataFrame:
    """SNK-3: ``;``-joined reasons, load instant and ISO partition label."""
    return rejected.select(
        *[c for c in rejected.columns if c not in (REASONS, path_date_col)],
        F.array_join(REASONS, ";").alias("reject_reasons"),
        F.current_timestamp().alias("reject_loaded_at"),
        F.date_format(path_date_col, "yyyy-MM-dd").alias("reject_partition"),
    )


def explode_reasons(df: DataFrame, reasons_text_col: str = "reject_reasons") -> DataFrame:
    """DQ-12: parse ``kind:column:value`` back out of the ``;``-joined text."""
    parts = F.split(F.col("reason"), ":", 3)
    return (
        df.select(F.explode(F.split(F.col(reasons_text_col), ";")).alias("reason"))
        .select(
            parts.getItem(0).alias("reason_kind"),
            parts.getItem(1).alias("column_name"),
            F.when(F.size(parts) > 2, parts.getItem(2)).alias("value"),
        )
    )
