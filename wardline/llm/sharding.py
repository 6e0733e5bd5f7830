"""Proportional stratified interleaving of documents into shards.

Rows are shuffled by a seeded hash and ranked within their source; sorted by fractional
rank (2r - 1) / 2n all sources run through at the same pace, so a cut of that order into
equal pieces gives every shard the mixture of the whole. Law ``rows``: shard sizes
differ by one row at most, slots are gapless from 0.

Neither rank uses a window over a whole source or the whole table: rows fall into
buckets of the (uniform) sort key, bucket counts are summed up in front of each bucket,
and a row's rank is that offset plus its number within the bucket. A source with a
third of the rows is spread over all its buckets.

Cases: null and empty texts count no bytes (size 1); null is a source of its own; rows
with the same id and content are interchangeable and get neighbouring ranks; an empty
table gives an empty result; all columns given pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import cut, digest, fresh, hex_fraction, text_or_empty

ROWS_PER_BUCKET = 100_000
LEAST_BUCKETS = 256


def _offsets(df: DataFrame, group: list[str], bucket: str, offset: str, size: str) -> DataFrame:
    """Rows in front of each bucket, and in all, per group."""
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias(size))
    running = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*group)
    return counts.select(*group, bucket, F.coalesce(F.sum(size).over(running), F.lit(0)).alias(offset), F.sum(size).over(every).alias(size))


def _ranked(df: DataFrame, group: list[str], bucket: str, order: list[Column], rank: str, total: str) -> DataFrame:
    """``rank`` from 1 and ``total`` per group, by ``order`` (which must refine ``bucket``)."""
    off = fresh(df, "offset")
    pre = _offsets(df, group, bucket, off, total)
    keys = [fresh(df, f"key_{i}") for i in range(len(group) + 1)]
    pre = pre.select(*[F.col(g).alias(k) for g, k in zip([*group, bucket], keys)], off, total)
    same = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip([*group, bucket], keys)]
    here = Window.partitionBy(*group, bucket).orderBy(*order)
    numbered = df.withColumn(rank, F.row_number().over(here))
    return numbered.join(pre, same).withColumn(rank, F.col(rank) + F.col(off)).drop(*keys, off)


def shard_documents(docs: DataFrame, n_shards: int = 8, seed: str = "shard", tie_break: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (any columns with doc_id and source) plus shard (int) and slot (long).

    ``tie_break`` names further columns that order rows of one id. Select narrow columns
    first if only the assignment is wanted: all columns given are carried.
    """
    if "shard" in {c.lower() for c in docs.columns} or "slot" in {c.lower() for c in docs.columns}:
        raise ValueError("the input already has a column shard or slot")
    dig, b1, b2, r, n, f, p, t = (fresh(docs, c) for c in ("dig", "bucket1", "bucket2", "rank", "in_source", "fraction", "place", "in_all"))
    keyed = cut(docs.withColumn(dig, digest(seed, F.col("doc_id"))))
    buckets = max(LEAST_BUCKETS, -(-keyed.count() // ROWS_PER_BUCKET))
    shuffled = [F.col(dig), F.col("doc_id").asc_nulls_last(), *[F.col(c) for c in tie_break]]
    one = _ranked(keyed.withColumn(b1, F.floor(hex_fraction(F.col(dig)) * buckets)), ["source"], b1, shuffled, r, n).drop(b1)
    one = one.withColumn(f, (F.col(r) * 2 - 1) / (F.col(n) * 2)).withColumn(b2, F.floor(F.col(f) * buckets))
    order = [F.col(f), F.col("source").asc_nulls_last(), *shuffled]
    two = _ranked(cut(one), [], b2, order, p, t)
    place = F.col(p) - 1
    # integer division on both sides: exact at any size
    shard = F.expr(f"(`{p}` - 1) * {n_shards} div `{t}`")
    first = F.expr(f"(((`{p}` - 1) * {n_shards} div `{t}`) * `{t}` + {n_shards - 1}) div {n_shards}")
    return two.withColumn("shard", shard.cast("int")).withColumn("slot", (place - first).cast("long")).select(*docs.columns, "shard", "slot")


def shard_report(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, source."""
    text = text_or_empty("text")
    narrow = docs.select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = shard_documents(narrow, n_shards, tie_break=("text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


REPORT_SQL = """
WITH crc_table AS (SELECT list(v ORDER BY n) AS tbl FROM (
  SELECT n, list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v
  FROM (SELECT CAST(range AS BIGINT) AS n FROM range(256)))),
b AS (SELECT doc_id, source, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
             string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g'), ' ') AS hx,
             md5(concat_ws(':', 'shard', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS dig FROM documents),
c AS (SELECT doc_id, source, size, dig, CAST(xor(list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(hx[1:len(hx) - 1], lambda h: CAST('0x' || h AS BIGINT))),
        lambda a, x: xor(a // 256, tbl[xor(a % 256, x) + 1])), 4294967295) AS BIGINT) AS text_crc32 FROM b, crc_table),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY dig, doc_id NULLS LAST, text_crc32, size) AS rn,
             COUNT(*) OVER (PARTITION BY source) AS n, COUNT(*) OVER () AS total FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY CAST(2 * rn - 1 AS DOUBLE) / CAST(2 * n AS DOUBLE), source NULLS LAST, dig, doc_id NULLS LAST, text_crc32, size) - 1 AS place FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 8 // total AS INTEGER) AS shard,
       CAST(place - ((place * 8 // total) * total + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
FROM p
"""
