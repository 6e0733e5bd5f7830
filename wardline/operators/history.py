"""Type-2 history: versions, the version in force at an event, change log.

Versions are half-open ``[valid_from, valid_to)``, ``valid_to`` NULL for the
current version. A key has at most one version per day, so the versions of one
key are bounded by the number of days in the period; windows partitioned by
key over versions are therefore bounded whatever the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import checkpoint_dir

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"


def build_versions(
    df: DataFrame,
    key: str,
    day_col: str,
    attrs: Sequence[str],
    tie_col: str,
) -> DataFrame:
    """DIM-1: one version per (key, distinct day), attributes of the row with the
    largest ``tie_col`` that day, ``valid_to`` = the next version's day.

    The per-day pick is an aggregate (``max_by``, map-side combined), so a hot
    key spreads over its days; only the bounded per-key version list is windowed.
    """
    per_day = (
        df.filter(F.col(key).isNotNull() & F.col(day_col).isNotNull())
        .groupBy(key, F.col(day_col).alias(VALID_FROM))
        .agg(F.max_by(F.struct(*attrs), F.col(tie_col)).alias("_a"))
    )
    w = Window.partitionBy(key).orderBy(VALID_FROM)
    return per_day.select(
        key,
        VALID_FROM,
        F.lead(VALID_FROM).over(w).alias(VALID_TO),
        *[F.col(f"_a.{a}").alias(a) for a in attrs],
    ).withColumn(IS_CURRENT, F.col(VALID_TO).isNull())


#: a key with more facts than this, and than a thousandth of all, is read in several tasks
HOT_FACTS = 100_000


def _scanned(facts: DataFrame, versions: DataFrame, key: str, event_col: str, take: Sequence[str], version_key: str, hot_facts: int, onwards: bool) -> DataFrame:
    """``facts`` as ``f`` with ``at``, the last version of the key on or before the event day.

    Facts and versions are read together in the order of (key, day), the last version seen being
    carried along: no fact meets more than one version. With ``onwards``, ``next`` is the first
    version on or after the day. A key of more than ``hot_facts`` facts (and a thousandth of
    all: fewer than a thousand keys) is dealt to several tasks, each with all its versions, of
    which there is one a day at most; facts without a key are dealt at random.
    """
    checkpoint_dir(facts.sparkSession)
    kept = facts.select(F.col(key).alias("_key"), F.to_date(F.col(event_col)).alias("_day"), F.struct(*facts.columns).alias("f")).checkpoint()
    counts = kept.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    limit = F.greatest(F.lit(hot_facts), F.floor(kept.select(F.count(F.lit(1))).scalar() / 1000))
    hot = counts.withColumn("_limit", limit).filter("_n > _limit").select(F.col("_key").alias("_hot"), F.ceil(F.col("_n") / F.col("_limit")).cast("int").alias("_parts"))
    dealt = kept.join(F.broadcast(hot), F.col("_key") == F.col("_hot"), "left")
    parts = F.when(F.col("_key").isNull(), 1009).otherwise(F.coalesce("_parts", F.lit(1)))
    fact = dealt.select("_key", F.pmod(F.xxhash64("f"), parts).cast("int").alias("_part"), "_day", F.lit(1).alias("_kind"), "f")
    known = versions.filter(F.col(version_key).isNotNull() & F.col(VALID_FROM).isNotNull())
    version = known.select(F.col(version_key).alias("_key"), F.col(VALID_FROM).alias("_day"), F.struct(VALID_FROM, VALID_TO, *take).alias("v"))
    version = version.join(F.broadcast(hot), F.col("_key") == F.col("_hot"), "left")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    version = version.select("_key", copies.alias("_part"), "_day", F.lit(0).alias("_kind"), "v")
    both = fact.unionByName(version, allowMissingColumns=True)
    part = Window.partitionBy("_key", "_part")
    until = part.orderBy(F.col("_day").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("at", F.last("v", ignorenulls=True).over(until))
    if onwards:
        back = part.orderBy(F.col("_day").desc_nulls_last(), F.col("_kind").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        both = both.withColumn("next", F.last("v", ignorenulls=True).over(back))
    return both.filter("_kind = 1")


def version_in_force(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    event_col: str,
    take: Sequence[str],
    prefix: str = "v_",
    version_key: str | None = None,
    hot_facts: int = HOT_FACTS,
) -> DataFrame:
    """JN-3: each fact with the version of its key in force on the event day, or NULLs."""
    found = _scanned(facts, versions, key, event_col, take, version_key or key, hot_facts, False)
    in_force = F.col(f"at.{VALID_TO}").isNull() | (F.col("_day") < F.col(f"at.{VALID_TO}"))
    at = lambda c: F.when(in_force, F.col(f"at.{c}")).alias(prefix + c)
    return found.select("f.*", at(VALID_FROM), *[at(c) for c in take])


def as_of_with_fallback(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    event_col: str,
    take: Sequence[str],
    prefix: str = "v_",
    hot_facts: int = HOT_FACTS,
) -> DataFrame:
    """JN-4: the last version on or before the event day, else the key's first version.

    Without a version before it, the next one is the key's first.
    """
    found = _scanned(facts, versions, key, event_col, take, key, hot_facts, True)
    missing = F.col("at").isNull()
    of = lambda c: F.when(missing, F.col(f"next.{c}")).otherwise(F.col(f"at.{c}")).alias(prefix + c)
    return found.select("f.*", of(VALID_FROM), *[of(c) for c in take], missing.alias("used_fallback"))


def change_log(
    versions: DataFrame,
    key: str,
    tracked: Sequence[str],
    rules: Sequence[tuple[str, Sequence[str]]] = (),
    order_col: str = VALID_FROM,
) -> DataFrame:
    """SCD-3: changes between successive versions of a key.

    One row per version after the first that changed a tracked column:
    ``changes`` = array of (column, before, after) as text, and ``change_type``
    = the first rule whose column set contains every changed column, else
    'mixed'. Columns not listed in ``tracked`` (technical ones) are ignored.
    """
    w = Window.partitionBy(key).orderBy(order_col)
    prev = F.lag(F.struct(*[F.col(c) for c in tracked])).over(w)
    staged = versions.select(key, order_col, *tracked, prev.alias("_prev"))
    diffs = [
        F.when(
            ~F.col(f"_prev.{c}").eqNullSafe(F.col(c)),
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_prev.{c}").cast("string").alias("before"),
                F.col(c).cast("string").alias("after"),
            ),
        )
        for c in tracked
    ]
    changes = F.array_compact(F.array(*diffs))
    out = staged.filter(F.col("_prev").isNotNull()).select(key, order_col, changes.alias("changes"))
    out = out.filter(F.size("changes") > 0)
    changed_names = F.transform("changes", lambda s: s["column"])
    ctype: Column | None = None
    for label, cols in rules:
        cond = F.size(F.array_except(changed_names, F.array(*[F.lit(c) for c in cols]))) == 0
        ctype = F.when(cond, F.lit(label)) if ctype is None else ctype.when(cond, F.lit(label))
    ctype = F.lit("mixed") if ctype is None else ctype.otherwise(F.lit("mixed"))
    return out.withColumn("change_type", ctype)


def scd_violations(versions: DataFrame, key: str) -> DataFrame:
    """DQ-22: per key, overlaps, continuity breaks and the number of current rows.

    Uses the ordered neighbour (lag) rather than a self-join, so no pair of
    versions is ever materialised.
    """
    w = Window.partitionBy(key).orderBy(VALID_FROM)
    prev_to = F.lag(VALID_TO).over(w)
    prev_exists = F.lag(VALID_FROM).over(w).isNotNull()
    staged = versions.select(
        key,
        (prev_exists & (prev_to.isNull() | (prev_to > F.col(VALID_FROM)))).alias("_overlap"),
        (prev_exists & prev_to.isNotNull() & (prev_to != F.col(VALID_FROM))).alias("_gap"),
        F.col(IS_CURRENT),
    )
    return staged.groupBy(key).agg(
        F.count_if("_overlap").alias("n_overlaps"),
        F.count_if("_gap").alias("n_gaps"),
        F.count_if(IS_CURRENT).alias("n_current"),
    )
