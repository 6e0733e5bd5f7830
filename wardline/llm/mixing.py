"""Mixing sources to target weights.

Per source, the tokens (words) of all documents are summed and a target is set: the
mix takes ``total_ratio`` times all words, shared by weight; a target stops at ``cap``
times its source's words and the excess is shared again by weight until none is above.
The repetition rate of a source is target / words. Each document is emitted
floor(rate) times, plus once more if a draw seeded by a hash of its id falls under the
fraction. The draw is Bernoulli with exactly that probability for every seed; of
``N_SEEDS`` seeds each source uses the one whose realised total lies nearest to its
target, so that small sources with a few large documents still meet their share.

Cases: null and empty texts have size 0 and never move a total; a source without words
has target 0 and rate 0 (its documents are not taken); null is a source of its own,
ordered last; repeated rows (same id) get the same draw; an empty table gives an empty
result; extra columns, whatever their names, pass through ``mix_documents`` unchanged.

Everything is one aggregate over (source) with map-side partial sums, so a source that
holds a third of the rows is no hot group; the per-source plan has one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import cut, digest, fresh, hex_fraction, word_count

WEIGHTS = (3, 1, 2)
TOTAL_PERCENT = 150
CAP = 2
N_SEEDS = 16  # one per starting digit of the 32-digit digest; 13 digits make a draw


def _draw(doc_id: Column, seed: Column | int) -> Column:
    """Uniform draw of a document under seed 0..N_SEEDS-1: the digits of one digest, read from digit ``seed``."""
    d = digest("mix", doc_id)
    if isinstance(seed, int):
        return hex_fraction(d, seed)
    return F.conv(F.substring(d, seed + F.lit(1), F.lit(13)), 16, 10).cast("double") / F.lit(float(16**13))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, size) per document -> (source, source_size, weight, target, rate).

    Water-filling in closed form: by rising cap / weight, a source is full when its cap
    is at most its share of what the full ones before it left.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("pos") % len(WEIGHTS) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    level = F.expr(f"source_size * {CAP} * 6 div weight")  # 6: weights 1, 2, 3 divide it
    before = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = (
        per.withColumn("pos", F.row_number().over(by_name) - 1)
        .withColumn("weight", cycle.cast("long"))
        .withColumn("level", level)
        .withColumn("left_total", F.sum("source_size").over(whole) * TOTAL_PERCENT / F.lit(100.0) - F.coalesce(F.sum("source_size").over(before) * CAP, F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("share", F.col("left_total") / F.col("left_weight"))
        .withColumn("full", F.col("source_size") * CAP <= F.col("weight") * F.col("share"))
    )
    # the share of the first source (in level order) that is not full holds for all others
    open_share = F.min_by(F.when(~F.col("full"), F.col("share")), F.when(~F.col("full"), F.struct("level", F.expr("source is null"), "source"))).over(whole)
    target = F.when(F.col("full"), (F.col("source_size") * CAP).cast("double")).otherwise(F.col("weight") * F.col("open_share"))
    return (
        ranked.withColumn("open_share", open_share)
        .withColumn("target", target)
        .select(
            "source",
            "source_size",
            "weight",
            "target",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        )
    )


def mixing_plan(sizes: DataFrame) -> DataFrame:
    """(doc_id, source, size) -> per source: source_size, target, rate, seed."""
    targets = source_targets(sizes.select("source", "size"))
    t = targets.select(F.col("source").alias("t_source"), "target", "source_size", F.expr("rate - floor(rate)").alias("fraction"), F.expr("floor(rate)").alias("whole"))
    joined = sizes.join(t, F.col("source").eqNullSafe(F.col("t_source")))
    realised = joined.groupBy("source").agg(
        F.first("target").alias("goal"),
        F.first("whole").alias("whole"),
        F.first("source_size").alias("words"),
        *[F.sum(F.when(_draw(F.col("doc_id"), s) < F.col("fraction"), F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(N_SEEDS)],
    )
    miss = [F.struct(F.abs(F.col("whole") * F.col("words") + F.col(f"s{s}") - F.col("goal")).alias("miss"), F.lit(s).alias("seed")) for s in range(N_SEEDS)]
    seeds = realised.select(F.col("source").alias("s_source"), F.least(*miss)["seed"].alias("seed"))
    return targets.join(seeds, F.col("source").eqNullSafe(F.col("s_source"))).select("source", "source_size", "target", "rate", "seed")


def copies(doc_id: Column, rate: Column, seed: Column) -> Column:
    """floor(rate) copies plus one with probability rate - floor(rate), drawn by the document's id."""
    return (F.floor(rate) + F.when(_draw(doc_id, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def document_sizes(docs: DataFrame) -> DataFrame:
    """Narrow table (doc_id, source, size), written once since three passes read it."""
    return cut(docs.select("doc_id", "source", word_count("text").alias("size")))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, same columns."""
    plan = mixing_plan(document_sizes(docs))
    src, rate, seed, n = (fresh(docs, c) for c in ("mix_source", "mix_rate", "mix_seed", "mix_copy"))
    plan = plan.select(F.col("source").alias(src), F.col("rate").alias(rate), F.col("seed").alias(seed))
    out = docs.join(plan, docs["source"].eqNullSafe(F.col(src)))
    times = copies(F.col("doc_id"), F.col(rate), F.col(seed)).cast("int")
    return out.withColumn(n, F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)


def mixing_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sizes = document_sizes(docs)
    plan = mixing_plan(sizes).withColumnRenamed("source", "p_source")
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("doc_id"), F.col("rate"), F.col("seed"))).alias("taken"), "source", "rate", F.col("seed").cast("int").alias("seed"))


REPORT_SQL = """
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS dig
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
wt AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM per),
lv AS (SELECT *, source_size * 12 // weight AS level FROM wt),
rk AS (
  SELECT *, sum(source_size) OVER () * 1.5 - coalesce(sum(source_size) OVER b * 2, 0) AS left_total,
         sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS left_weight
  FROM lv WINDOW b AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
sh AS (SELECT *, CAST(left_total AS DOUBLE) / left_weight AS share,
              source_size * 2 <= weight * (CAST(left_total AS DOUBLE) / left_weight) AS is_full,
              row_number() OVER (ORDER BY level, source NULLS LAST) AS rn FROM rk),
op AS (SELECT share AS open_share FROM sh WHERE NOT is_full ORDER BY rn LIMIT 1),
tg AS (SELECT source, source_size,
              CASE WHEN is_full THEN CAST(source_size * 2 AS DOUBLE) ELSE weight * (SELECT open_share FROM op) END AS target FROM sh),
rt AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM tg),
draws AS (
  SELECT s.doc_id, s.source, s.size, k.seed,
         CAST(CAST('0x' || substr(s.dig, k.seed + 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM sizes s CROSS JOIN (SELECT CAST(range AS INTEGER) AS seed FROM range(16)) k),
tot AS (
  SELECT d.source, d.seed, abs(floor(any_value(r.rate)) * any_value(r.source_size) +
         sum(CASE WHEN d.u < r.rate - floor(r.rate) THEN d.size ELSE 0 END) - any_value(r.target)) AS miss
  FROM draws d JOIN rt r ON d.source IS NOT DISTINCT FROM r.source GROUP BY d.source, d.seed),
best AS (SELECT source, seed FROM tot QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, seed) = 1)
SELECT d.doc_id, d.size, r.source_size, r.target,
       CAST(d.size * (floor(r.rate) + CASE WHEN d.u < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       d.source, r.rate, d.seed
FROM draws d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.seed = b.seed
JOIN rt r ON d.source IS NOT DISTINCT FROM r.source
"""
