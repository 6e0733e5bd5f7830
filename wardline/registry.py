"""Declared schemas of the landing (all-text) tables and the check parameters.

A landing table is a list of columns, each with a business kind. The kind decides
the typed Spark type and the row checks applied to the raw text. The header of a
landing file must equal the declared column list, in order.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---- fixed values: formats, bounds and thresholds of the ingestion checks ----
DATE_FORMAT = "MM/dd/yyyy"
TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"
BOOLEAN_DOMAIN = ("0", "1")
EVENT_LOW_BOUND = dt.date(2000, 1, 1)
BIRTH_LOW_BOUND = dt.date(1890, 1, 1)
REJECT_RATE_THRESHOLD = 0.05
BLOCKING_REJECT_FLOOR = 2
# -----------------------------------------------------------------------------

KINDS = ("code", "text", "date", "timestamp", "decimal", "integer", "boolean")

TYPED = {
    "code": T.StringType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),  # wall-clock instants without zone
    "decimal": T.DecimalType(18, 2),
    "integer": T.IntegerType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class Col:
    name: str
    kind: str
    low_bound: dt.date | None = None
    # name of a date column of the same row this value may not exceed
    not_after: str | None = None
    description: str = ""
    provenance: str = "observed"

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r} for {self.name}")


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...]
    partition_col: str = "date_extraction"
    description: str = ""
    exempt_degenerate: tuple[str, ...] = field(default_factory=tuple)
    #: quoted fields may hold line breaks; such files cannot be split into tasks
    multi_line: bool = False

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def col(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def text_schema(self) -> T.StructType:
        """All-string schema used to read landing files."""
        return T.StructType([T.StructField(c.name, T.StringType(), True) for c in self.columns])

    def typed_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(
                    c.name,
                    TYPED[c.kind],
                    True,
                    metadata={"kind": c.kind, "description": c.description, "provenance": c.provenance},
                )
                for c in self.columns
            ]
        )


# Landing analogues of the driver tables (see plans/landing.py for the derivation).
LINEITEM_LANDING = TableSpec(
    name="lineitem_landing",
    description="Shipment lines as daily all-text extracts, one file per extraction month.",
    columns=(
        Col("l_orderkey", "code", description="order number"),
        Col("l_linenumber", "integer", description="line number inside the order"),
        Col("l_partkey", "code", description="part code"),
        Col("l_suppkey", "code", description="supplier code"),
        Col("l_quantity", "integer", description="quantity"),
        Col("l_extendedprice", "decimal", description="line amount"),
        Col("l_discount", "decimal", description="discount rate"),
        Col("l_returnflag", "code", description="return flag"),
        Col("l_linestatus", "code", description="line status"),
        Col(
            "l_shipdate",
            "date",
            low_bound=dt.date(1995, 2, 1),
            not_after="date_extraction",
            description="ship date",
        ),
        Col("is_returned", "boolean", description="returned line flag"),
        Col("date_extraction", "date", description="extraction date", provenance="technical"),
    ),
    key=("l_orderkey", "l_linenumber"),
)

ORDERS_LANDING = TableSpec(
    name="orders_landing",
    description="Order headers as all-text extracts, one file per extraction month.",
    columns=(
        Col("o_orderkey", "code", description="order number"),
        Col("o_custkey", "code", description="customer number"),
        Col("o_orderstatus", "code", description="order status"),
        Col("o_totalprice", "decimal", description="order total"),
        Col("o_orderdate", "date", low_bound=dt.date(1995, 1, 1), description="order date"),
        Col("o_orderpriority", "code", description="priority code"),
        Col("date_extraction", "date", description="extraction date", provenance="technical"),
    ),
    key=("o_orderkey",),
)

EVENTS_LANDING = TableSpec(
    name="events_landing",
    description="User events as all-text extracts, one file per extraction day.",
    columns=(
        Col("event_id", "code", description="event number"),
        Col("ts", "timestamp", low_bound=dt.date(2000, 1, 1), not_after="date_extraction", description="event instant"),
        Col("user_id", "code", description="user number"),
        Col("event_type", "code", description="event type"),
        Col("value", "decimal", description="event value"),
        Col("date_extraction", "date", description="extraction date", provenance="technical"),
    ),
    key=("event_id",),
)

LANDING_SPECS = {s.name: s for s in (LINEITEM_LANDING, ORDERS_LANDING, EVENTS_LANDING)}
