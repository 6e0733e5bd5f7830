"""Line dedup: repeated runs of lines, found by prefix doubling over line-ID sequences.

A document is a sequence of lines (a blank line belongs to the line before it). Suffix
positions are ranked by distributed prefix doubling: the rank of a position at level k
names its class of equal 2^k-line prefixes, and the name is the class's first position in
the corpus (by doc_id, then line), so ranks are exact, need no hash, and carry the
earliest copy with them. Level k + 1 groups pairs (rank at p, rank at p + 2^k). Positions
that are alone in their class are unique from there on and drop out, so later levels see
repeated text only. All positions with one rank form an interval of the suffix array whose
longest common prefix is at least 2^k lines.

A run counts if it has ``MIN_WORDS`` words or more. For every position the shortest window
of that weight forwards, and the shortest backwards, is looked up as the pair of ranks
that cover it; a window whose class has an earlier first position is a later copy.
Every run of that weight with an earlier copy is the union of such windows, and their
unions are the maximal repeated runs, which are deleted. The first copy stays.

Cases: null texts stay null; an empty text has no words and stays; a document that is
wholly a later copy becomes an empty text (rows are never dropped); rows repeated with the
same doc_id and text are one document and get the same result; texts that repeat under
different doc_ids lose all but the smallest doc_id (null counts as smallest); within a
document later copies of its own runs go too; an empty table gives an empty result; extra
columns pass through unchanged.

No group is collected by content: classes are counted with map-side partial sums, and the
joins back are plain equi joins whose hot keys Spark can split. Only the lines of one
document meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import WORD, cut, fresh

MIN_WORDS = 50

# a line break in front of a line that is not blank
_BREAK = r"\n(?=[\x20\t\x0B\f\r]*+[^\x20\t\x0B\f\r\n])"


def lines_of(text: Column) -> Column:
    """The lines of a text, each with the blank lines behind it; joined by a line break they give the text."""
    return F.split(text, _BREAK, -1)


def _positions(docs: DataFrame) -> DataFrame:
    """(d, i, w, a, b): document, line number, words, and the line as two 64-bit hashes."""
    rows = docs.where(F.col("text").isNotNull()).select(
        F.struct("doc_id", F.xxhash64("text").alias("h")).alias("d"), F.posexplode(lines_of(F.col("text"))).alias("i", "line")
    )
    line = F.btrim(F.col("line"), F.lit(" \t\n\r\x0b\f"))
    return (
        rows.select("d", "i", line.alias("line"))
        .where(F.col("line") != "")
        .select("d", "i", F.regexp_count("line", F.lit(WORD)).alias("w"), F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))
    )


def _name_classes(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``name``, the first position (d, i) with the same keys; rows alone in their class get null."""
    pos = F.struct("d", "i")
    classes = rows.where(F.expr(" and ".join(f"{k} is not null" for k in keys))).groupBy(*keys).agg(F.min(pos).alias(name), F.max(pos).alias("last"))
    classes = cut(classes.where(F.col(name) < F.col("last")).select(*keys, name))
    return rows.join(classes, keys, "left")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Maximal repeated runs that have an earlier copy: (d, runs, copied_from).

    ``d`` is (doc_id, hash of the text); ``runs`` a sorted array of (s, e) line numbers, e
    exclusive; ``copied_from`` the doc_ids that hold the first copies.
    """
    lines = cut(_positions(docs))
    classes = lines.groupBy("a", "b").agg(F.min(F.struct("d", "i")).alias("r0"), F.max(F.struct("d", "i")).alias("last"))
    classes = cut(classes.where(F.col("r0") < F.col("last")).select("a", "b", "r0"))
    # stretches of repeated lines; a run lies within one (rows repeated as a whole count once)
    in_doc = Window.partitionBy("d").orderBy("i")
    repeated = lines.join(classes, ["a", "b"]).select("d", "i", "w", "r0", (F.col("i") - F.dense_rank().over(in_doc)).alias("g"))
    stretch = repeated.groupBy("d", "g").agg(F.array_sort(F.collect_set(F.struct("i", "w", "r0"))).alias("x"), F.sum("w").alias("words"))
    stretch = cut(stretch.where(F.col("words") >= min_words).select("d", "g", "x", _windows(F.col("x"), min_words).alias("windows")))
    longest = stretch.select(F.max(F.array_max(F.transform("windows", lambda v: v["n"])))).first()[0] or 1
    levels = longest.bit_length() - 1
    ranked = stretch.select("d", "g", F.explode("x").alias("x")).select("d", "g", F.col("x.i").alias("i"), F.col("x.r0").alias("r0"))
    in_stretch = Window.partitionBy("d", "g").orderBy("i")
    for k in range(levels):
        ahead = ranked.withColumn("ahead", F.lead(f"r{k}", 2**k).over(in_stretch))
        ranked = _name_classes(ahead, [f"r{k}", "ahead"], f"r{k + 1}").drop("ahead")
    ranks = [f"r{k}" for k in range(levels + 1)]
    if levels:
        ranked = ranked.groupBy("d", "g").agg(F.array_sort(F.collect_list(F.struct("i", *ranks))).alias("ranks")).join(stretch.select("d", "g", "windows"), ["d", "g"])
    else:
        ranked = stretch.select("d", "g", F.transform("x", lambda y: F.struct(y["i"].alias("i"), y["r0"].alias("r0"))).alias("ranks"), "windows")
    seen = ranked.select("d", F.explode(_covered(F.col("windows"), F.col("ranks"), levels)).alias("v")).select("d", "v.i", "v.n", "v.head", "v.tail")
    firsts = seen.where(F.col("head").isNotNull() & F.col("tail").isNotNull()).groupBy("n", "head", "tail").agg(F.min(F.struct("d", "i")).alias("first"), F.max(F.struct("d", "i")).alias("last"))
    firsts = cut(firsts.where(F.col("first") < F.col("last")).drop("last"))
    later = seen.join(firsts, ["n", "head", "tail"]).where(F.col("first") < F.struct("d", "i")).select("d", F.col("i").alias("s"), (F.col("i") + F.col("n")).alias("e"), F.col("first.d.doc_id").alias("from"))
    # windows that touch or overlap make one maximal run
    by_start = Window.partitionBy("d").orderBy("s", "e")
    gap = F.when(F.col("s") <= F.max("e").over(by_start.rowsBetween(Window.unboundedPreceding, -1)), 0).otherwise(1)
    runs = later.withColumn("gap", gap).withColumn("run", F.sum("gap").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("d", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.collect_set("from").alias("from"))
    return runs.groupBy("d").agg(
        F.array_sort(F.collect_list(F.struct("s", "e"))).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("from")))).alias("copied_from")
    )


def _windows(x: Column, min_words: int) -> Column:
    """Distinct shortest windows of ``min_words`` in a stretch, (p, n): forwards from and backwards to each line.

    Every line has a word at least, so a window has at most ``min_words`` lines.
    """
    zero = F.struct(F.lit(0).cast("long").alias("w"), F.lit(0).alias("n"))

    def weigh(acc: Column, y: Column) -> Column:
        more = acc["w"] < min_words
        return F.struct((acc["w"] + F.when(more, y["w"]).otherwise(0)).cast("long").alias("w"), (acc["n"] + F.when(more, 1).otherwise(0)).alias("n"))

    none = F.lit(None).cast("struct<p:int,n:int>")

    def forwards(_: Column, i: Column) -> Column:
        got = F.aggregate(F.slice(x, i + 1, F.lit(min_words)), zero, weigh)
        return F.when(got["w"] >= min_words, F.struct(i.alias("p"), got["n"].alias("n"))).otherwise(none)

    def backwards(_: Column, i: Column) -> Column:
        size = F.least(i + 1, F.lit(min_words))
        got = F.aggregate(F.reverse(F.slice(x, i + 2 - size, size)), zero, weigh)
        return F.when(got["w"] >= min_words, F.struct((i + 1 - got["n"]).alias("p"), got["n"].alias("n"))).otherwise(none)

    return F.array_distinct(F.filter(F.concat(F.transform(x, forwards), F.transform(x, backwards)), lambda v: v.isNotNull()))


def _covered(windows: Column, ranks: Column, levels: int) -> Column:
    """Each window as the ranks of its first and last 2^k lines, 2^k <= n < 2^(k+1)."""

    def cover(v: Column) -> Column:
        head = tail = F.lit(None).cast("struct<d:struct<doc_id:bigint,h:bigint>,i:int>")
        for k in range(levels, -1, -1):
            fits = (v["n"] >= 2**k) & (v["n"] < 2 ** (k + 1))
            head = F.when(fits, F.get(ranks, v["p"])[f"r{k}"]).otherwise(head)
            tail = F.when(fits, F.get(ranks, v["p"] + v["n"] - 2**k)[f"r{k}"]).otherwise(tail)
        return F.struct(F.get(ranks, v["p"])["i"].alias("i"), v["n"].alias("n"), head.alias("head"), tail.alias("tail"))

    return F.transform(windows, cover)


def _without(text: Column, runs: Column) -> Column:
    """The text without the lines of ``runs``."""
    lines = lines_of(text)
    bounds = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["e"]))
    ends = F.concat(F.transform(runs, lambda r: r["s"]), F.array(F.size(lines)))
    kept = F.transform(F.arrays_zip(bounds.alias("a"), ends.alias("b")), lambda z: F.slice(lines, z["a"] + 1, z["b"] - z["a"]))
    return F.array_join(F.flatten(kept), "\n")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, report: bool = False) -> DataFrame:
    """``docs`` with later copies of repeated runs deleted from ``text``; same rows and columns.

    With ``report``, adds runs (array of (s, e) line numbers) and copied_from (doc_ids).
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    runs = later_copies(base, min_words)
    key, found, source = (fresh(docs, c) for c in ("run_key", "runs", "copied_from"))
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h")))
    runs = runs.select(F.col("d").alias(key), F.col("runs").alias(found), F.col("copied_from").alias(source))
    joined = keyed.join(runs.hint("shuffle_hash"), key, "left")
    cleaned = joined.withColumn("text", F.when(F.col(found).isNotNull(), _without(F.col("text"), F.col(found))).otherwise(F.col("text")))
    if not report:
        return cleaned.select(*docs.columns)
    return cleaned.select(*docs.columns, found, source)


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, n_removed (lines), runs ("start-end" line numbers), copied_from (doc_ids of first copies), text without them."""
    out = dedup_lines(docs.select("doc_id", "text"), report=True)
    runs = F.coalesce("runs", F.array().cast("array<struct<s:int,e:int>>"))
    return out.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        F.aggregate(runs, F.lit(0), lambda n, r: n + r["e"] - r["s"]).cast("long").alias("n_removed"),
        F.array_join(F.transform(runs, lambda r: F.concat_ws("-", r["s"], r["e"])), ",").alias("runs"),
        F.coalesce(F.array_join(F.transform("copied_from", lambda d: d.cast("string")), ","), F.lit("")).alias("copied_from"),
        "text",
    )


REPORT_SQL = r"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, i, ls[i] AS line, regexp_matches(ls[i], '[^ \t\x0B\f\r]') AS said FROM raw, unnest(range(1, len(ls) + 1)) AS g(i)),
u AS (SELECT *, COALESCE(SUM(CASE WHEN said AND i > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i), 0) AS unit FROM l),
units AS (SELECT doc_id, CAST(unit AS INTEGER) AS unit, string_agg(line, chr(10) ORDER BY i) AS body FROM u GROUP BY 1, 2),
k AS (SELECT *, trim(body, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) AS key FROM units),
w AS (SELECT *, CAST(len(regexp_extract_all(key, '[^\x20\x09-\x0D]+')) AS BIGINT) AS words FROM k),
c AS (SELECT *, SUM(words) OVER (PARTITION BY doc_id ORDER BY unit) AS upto FROM w),
win AS (SELECT a.doc_id, a.unit AS s, b.unit + 1 AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.unit BETWEEN a.unit AND a.unit + 49
        WHERE a.key <> '' AND b.upto - a.upto + a.words >= 50
          AND (b.upto - b.words - a.upto + a.words < 50 OR b.upto - a.upto < 50)),
body AS (SELECT w.doc_id, w.s, w.e, string_agg(c.key, chr(1) ORDER BY c.unit) AS content
         FROM win w JOIN c ON c.doc_id = w.doc_id AND c.unit >= w.s AND c.unit < w.e GROUP BY ALL),
f AS (SELECT *, min({'d': doc_id, 's': s}) OVER (PARTITION BY content) AS origin FROM body),
later AS (SELECT doc_id, s, e, origin.d AS origin_doc FROM f WHERE origin < {'d': doc_id, 's': s}),
gap AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY doc_id ORDER BY s, e, origin_doc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM later),
num AS (SELECT *, SUM(opens) OVER (PARTITION BY doc_id ORDER BY s, e, origin_doc ROWS UNBOUNDED PRECEDING) AS run FROM gap),
runs AS (SELECT doc_id, run, min(s) AS s, max(e) AS e FROM num GROUP BY 1, 2),
per AS (SELECT doc_id, COUNT(*) AS n_runs, CAST(SUM(e - s) AS BIGINT) AS n_removed, string_agg(s || '-' || e, ',' ORDER BY s) AS runs FROM runs GROUP BY 1),
src AS (SELECT doc_id, string_agg(DISTINCT origin_doc, ',' ORDER BY origin_doc) AS copied_from FROM later GROUP BY 1),
kept AS (SELECT u.doc_id, string_agg(u.body, chr(10) ORDER BY u.unit) AS text FROM units u
         WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = u.doc_id AND u.unit >= r.s AND u.unit < r.e) GROUP BY 1)
SELECT d.doc_id, COALESCE(p.n_runs, 0) AS n_runs, COALESCE(p.n_removed, 0) AS n_removed, COALESCE(p.runs, '') AS runs,
       COALESCE(s.copied_from, '') AS copied_from, CASE WHEN d.text IS NULL THEN NULL ELSE COALESCE(k.text, '') END AS text
FROM documents d LEFT JOIN per p ON d.doc_id = p.doc_id LEFT JOIN src s ON d.doc_id = s.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
