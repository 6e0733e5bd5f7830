"""DuckDB text of the oracle side, generated from the same declared registry.

The Spark side computes checks with Spark expressions; these helpers render the
same declared rules with DuckDB functions so the oracle is an independent
evaluation of the registry, not a replay of the Spark plan.
"""

from __future__ import annotations

from wardline.registry import BOOLEAN_DOMAIN, TableSpec

DUCK_DATE = "%m/%d/%Y"
DUCK_TS = "%m/%d/%Y %I:%M:%S %p"


def _parse(col: str, kind: str) -> str:
    fmt = DUCK_DATE if kind == "date" else DUCK_TS
    return f"try_strptime(NULLIF({col}, ''), '{fmt}')"


def reason_exprs(spec: TableSpec, path_col: str | None = "path_date") -> list[str]:
    out: list[str] = []
    extraction = _parse(spec.partition_col, "date")
    for c in spec.columns:
        n = c.name
        if c.kind in ("date", "timestamp"):
            p = _parse(n, c.kind)
            out.append(f"CASE WHEN {n} <> '' AND {p} IS NULL THEN 'type_{c.kind}:{n}:' || {n} END")
            if c.low_bound is not None:
                out.append(
                    f"CASE WHEN {n} <> '' AND {p} < TIMESTAMP '{c.low_bound.isoformat()} 00:00:00' "
                    f"THEN 'low_bound:{n}:' || {n} END"
                )
            if c.not_after is not None:
                out.append(f"CASE WHEN {n} <> '' AND {p} > {extraction} THEN 'after_extraction:{n}:' || {n} END")
        elif c.kind == "decimal":
            out.append(
                f"CASE WHEN {n} <> '' AND NOT COALESCE(TRY_CAST({n} AS DECIMAL(18,2)) = TRY_CAST({n} AS DECIMAL(38,18)), FALSE) THEN 'type_decimal:{n}:' || {n} END"
            )
        elif c.kind == "integer":
            out.append(f"CASE WHEN {n} <> '' AND TRY_CAST({n} AS INTEGER) IS NULL THEN 'type_integer:{n}:' || {n} END")
        elif c.kind == "boolean":
            dom = ", ".join(f"'{v}'" for v in BOOLEAN_DOMAIN)
            out.append(f"CASE WHEN {n} <> '' AND {n} NOT IN ({dom}) THEN 'boolean_domain:{n}:' || {n} END")
    if path_col is not None:
        pc = spec.partition_col
        out.append(
            f"CASE WHEN {pc} <> '' AND {pc} <> strftime({path_col}, '{DUCK_DATE}') "
            f"THEN 'partition_mismatch:{pc}:' || {pc} END"
        )
    return out


def uniqueness_expr(spec: TableSpec, path_col: str = "path_date", extra: tuple[str, ...] = ()) -> str:
    keys = list(spec.key)
    kname = ",".join(keys)
    empty = " OR ".join(f"{k} = ''" for k in keys)
    content = ", ".join([*spec.names, path_col, *extra])
    display = " || '|' || ".join(keys)
    return (
        f"CASE WHEN {empty} THEN 'empty_key:{kname}' "
        f"WHEN row_number() OVER (PARTITION BY {path_col}, {', '.join(keys)} ORDER BY {content}) > 1 "
        f"THEN 'duplicate:{kname}:' || {display} END"
    )


def checked_cte(spec: TableSpec, source: str, name: str, path_col: str = "path_date", extra: tuple[str, ...] = ()) -> str:
    """CTE ``name`` = source rows + ``reasons`` (';'-joined text, '' when none)."""
    parts = reason_exprs(spec, path_col) + [uniqueness_expr(spec, path_col, extra)]
    return f"""
{name} AS (
  SELECT *, concat_ws(';', {', '.join(parts)}) AS reasons
  FROM {source}
)"""


def gate_cte(checked: str, name: str, table_name: str, path_col: str = "path_date") -> str:
    return f"""
{name} AS (
  SELECT '{table_name}' AS table_name, {path_col},
         CASE WHEN n_read > 0 AND n_rejected::DOUBLE / n_read > 0.05 AND n_rejected >= 2
              THEN 'blocked' ELSE 'loaded' END AS state,
         n_read,
         CAST(CASE WHEN n_read > 0 AND n_rejected::DOUBLE / n_read > 0.05 AND n_rejected >= 2
              THEN 0 ELSE n_read - n_rejected END AS BIGINT) AS n_inserted,
         n_rejected
  FROM (SELECT {path_col}, COUNT(*) AS n_read, COUNT(*) FILTER (WHERE reasons <> '') AS n_rejected
        FROM {checked} GROUP BY {path_col})
)"""


def typed_cte(spec: TableSpec, source: str, name: str, extra: str = "path_date") -> str:
    """CTE ``name`` = PRJ-1 typed projection of a landing CTE, DuckDB side."""
    cols = []
    for c in spec.columns:
        n = c.name
        if c.kind in ("code", "text"):
            cols.append(f"NULLIF({n}, '') AS {n}")
        elif c.kind == "date":
            cols.append(f"CAST({_parse(n, 'date')} AS DATE) AS {n}")
        elif c.kind == "timestamp":
            cols.append(f"{_parse(n, 'timestamp')} AS {n}")
        elif c.kind == "decimal":
            cols.append(f"TRY_CAST(NULLIF({n}, '') AS DECIMAL(18,2)) AS {n}")
        elif c.kind == "integer":
            cols.append(f"TRY_CAST(NULLIF({n}, '') AS INTEGER) AS {n}")
        elif c.kind == "boolean":
            cols.append(f"CASE {n} WHEN '1' THEN TRUE WHEN '0' THEN FALSE END AS {n}")
    if extra:
        cols.append(extra)
    return f"""
{name} AS (
  SELECT {', '.join(cols)}
  FROM {source}
)"""
