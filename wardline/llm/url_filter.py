"""URL filters by a sorted digest array.

The filter's entries are rules (host, path prefix, verdict) and blocked words of host names.
Each entry is a string (``host + path``, or ``#word``) with a 64-bit xxhash key. The index
is one file: keys in ascending order, the places where the entries' strings end, their
verdicts, and the strings themselves. Spark hands the file to every executor; workers map it
into memory, so that all workers of a machine share its pages. A batch of urls is turned into
probe strings (every ending of the host at a dot, times the path prefixes of the lengths that
rules have; the words of the host), their keys are searched in one vectorised binary search,
and every hit is confirmed by comparing the stored string: two entries of one key stay apart.

Judgement: a rule fits its host and all subdomains if the path starts with the rule's path.
The longest fitting rule wins (by characters of host and path; between equally long ones the
longer host). Without a rule, a host that holds a blocked word is blocked, any other allowed.

The index is shipped while it takes at most ``MAX_INDEX_BYTES`` (counted first). Beyond that
the same probes are joined by Spark on (key, string); the result is the same.

Cases: a null url, or one without ``://``, has empty host and path, no rule, and is allowed;
an empty path fits only rules with an empty path; letters other than A-Z keep their case;
urls of any length are handled, probes are no longer than the longest entry; repeated rows
stay; an empty table gives an empty result; a rule listed twice counts once, with ``block``
before ``allow``; columns of the input that clash with the result's are refused by
``judge_urls`` and never read by ``url_report``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import fresh, tidy, text_or_empty
from wardline.session import checkpoint_dir

# ---- fixed values: the rules that the url query applies (host, path prefix, verdict) ----
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# ---- fixed values: words of host names that are blocked where no rule says otherwise ----
BLOCKED_WORDS = ("adult", "ads", "bets", "betting", "casino", "escort", "gambling", "lottery", "malware", "phishing", "pills", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx")
# -----------------------------------------------------------------------------------------
MAX_INDEX_BYTES = 256 << 20
SEED = 42  # the seed of Spark's xxhash64, so that both ways probe the same keys

_VERDICTS = ("block", "allow")


def host_of(url: str | Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    u = text_or_empty(url)
    return F.translate(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(text_or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Shape:
    """What probes need to know of the entries: longest host and word, labels, path lengths."""

    host: int
    labels: int
    word: int
    paths: tuple[int, ...]


def entries(rules: DataFrame, words: Iterable[str] = ()) -> DataFrame:
    """One row per entry: entry, host_length (-1 for words), path_length, verdict (0 block, 1 allow)."""
    spark = rules.sparkSession
    ruled = rules.select(
        F.concat(F.lower("host"), "path").alias("entry"),
        F.length("host").alias("host_length"),
        F.length("path").alias("path_length"),
        F.when(F.col("verdict") == "block", 0).otherwise(1).alias("verdict"),
    )
    listed = spark.createDataFrame([(f"#{w.lower()}", -1, 0, 0) for w in sorted(set(words))], ruled.schema)
    # an entry is known by its string and where its host ends
    return ruled.unionByName(listed).groupBy("entry", "host_length", "path_length").agg(F.min("verdict").alias("verdict"))


def shape_of(found: DataFrame) -> tuple[Shape, int]:
    """The shape of the entries, and the bytes that their index takes."""
    row = found.agg(
        F.max("host_length").alias("host"),
        F.max(F.when(F.col("host_length") >= 0, F.size(F.split(F.substring("entry", F.lit(1), F.col("host_length")), r"\.")))).alias("labels"),
        F.max(F.when(F.col("host_length") < 0, F.length("entry") - 1)).alias("word"),
        F.sort_array(F.collect_set(F.when(F.col("host_length") >= 0, F.col("path_length")))).alias("paths"),
        F.sum(F.octet_length("entry") + 8 + 8 + 4 + 1).alias("bytes"),
    ).first()
    return Shape(max(row["host"] or 0, 0), row["labels"] or 0, row["word"] or 0, tuple(row["paths"])), int(row["bytes"] or 0)


# ---------------------------------------------------------------- the mapped index


def write_index(found: DataFrame) -> str:
    """Write the sorted digest array to the shared folder and hand it to all executors; its file name."""
    spark = found.sparkSession
    rows = found.select("entry", "host_length", "verdict").toArrow()
    texts = [t.encode() for t in rows.column("entry").to_pylist()]
    keys = np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in texts), np.uint64, len(texts))
    hosts, verdicts = rows.column("host_length").to_numpy().astype(np.int32), rows.column("verdict").to_numpy().astype(np.uint8)
    order = sorted(range(len(texts)), key=lambda i: (int(keys[i]), texts[i], int(hosts[i])))
    ends = np.cumsum([len(texts[i]) for i in order], dtype=np.uint64)
    name = f"url-index-{uuid.uuid4().hex}"
    path = os.path.join(checkpoint_dir(spark), name)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, False)
    for part in (np.array([len(texts)], np.uint64), keys[order], ends, hosts[order], verdicts[order]):
        out.write(bytearray(part.tobytes()))
    out.write(bytearray(b"".join(texts[i] for i in order)))
    out.close()
    spark.sparkContext.addFile(place.makeQualified(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())).toString())
    return name


class DigestArray:
    """The index file, mapped into memory."""

    def __init__(self, path: str):
        n = int(np.fromfile(path, np.uint64, 1)[0]) if os.path.getsize(path) >= 8 else 0
        self.n, at = n, 8
        if not n:
            return
        self.keys = np.memmap(path, np.uint64, "r", at, (n,))
        self.ends = np.memmap(path, np.uint64, "r", at + 8 * n, (n,))
        self.hosts = np.memmap(path, np.int32, "r", at + 16 * n, (n,))
        self.verdicts = np.memmap(path, np.uint8, "r", at + 20 * n, (n,))
        self.texts = np.memmap(path, np.uint8, "r", at + 21 * n)

    def _text(self, i: int) -> bytes:
        return self.texts[int(self.ends[i - 1]) if i else 0 : int(self.ends[i])].tobytes()

    def find(self, probes: list[tuple[bytes, int]]) -> np.ndarray:
        """For each probe (string, host length) the number of its entry, or -1."""
        found = np.full(len(probes), -1, np.int64)
        if not self.n or not probes:
            return found
        wanted = np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t, _ in probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, wanted)
        open_ = np.flatnonzero((at < self.n) & (self.keys[np.minimum(at, self.n - 1)] == wanted))
        while len(open_):  # entries of one key lie side by side: the strings decide
            left = []
            for p in open_:
                i = int(at[p])
                if self._text(i) == probes[p][0] and self.hosts[i] == probes[p][1]:
                    found[p] = i
                elif i + 1 < self.n and self.keys[i + 1] == wanted[p]:
                    left.append(p)
            open_ = np.array(left, np.int64)
            at[open_] += 1
        return found


def probes_of(host: str, path: str, shape: Shape) -> tuple[list[tuple[str, int]], list[str]]:
    """Rule probes (string, host length), longest first, and the host's words."""
    labels = host.split(".") if host else []
    ends = [".".join(labels[i:]) for i in range(max(0, len(labels) - shape.labels), len(labels))]
    rules = [(h + path[:n], len(h)) for h in ends if len(h) <= shape.host for n in shape.paths if n <= len(path)]
    rules.sort(key=lambda p: (-len(p[0]), -p[1]))
    words = [w for w in dict.fromkeys(_words(host)) if len(w) <= shape.word]
    return rules, words


def _words(host: str) -> list[str]:
    return [w for w in host.replace(".", "-").replace("_", "-").split("-") if w]


_OPEN: dict[str, DigestArray] = {}


def _index(name: str) -> DigestArray:
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = DigestArray(SparkFiles.get(name))
    return _OPEN[name]


def _judge_batch(hosts: list[str], paths: list[str], shape: Shape, index: DigestArray) -> tuple[list, list, list]:
    """(rule, verdict, blocked word) of each url; equal (host, start of path) are probed once."""
    longest = max(shape.paths, default=0)
    heads = list(zip(hosts, [p[:longest] for p in paths]))
    probes: list[tuple[bytes, int]] = []
    spans = {}
    for head in dict.fromkeys(heads):
        rules, words = probes_of(*head, shape)
        begin = len(probes)
        probes += [(t.encode(), n) for t, n in rules] + [(f"#{w}".encode(), -1) for w in words]
        spans[head] = (begin, begin + len(rules), len(probes))
    hits = index.find(probes)
    judged = {}
    for head, (a, b, c) in spans.items():
        rule = next((p for p in range(a, b) if hits[p] >= 0), None)
        word = next((probes[p][0].decode()[1:] for p in range(b, c) if hits[p] >= 0), None)
        if rule is not None:
            judged[head] = (probes[rule][0].decode(), _VERDICTS[index.verdicts[hits[rule]]], word)
        else:
            judged[head] = (None, "allow" if word is None else "block", word)
    out = [judged[h] for h in heads]
    return [o[0] for o in out], [o[1] for o in out], [o[2] for o in out]


def _by_index(parsed: DataFrame, found: DataFrame, shape: Shape) -> DataFrame:
    name = write_index(found)
    schema = T.StructType([*parsed.schema.fields, *(T.StructField(c, T.StringType()) for c in ("rule", "verdict", "blocked_word"))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = _index(name)
        for batch in batches:
            got = _judge_batch(batch.column("host").to_pylist(), batch.column("path").to_pylist(), shape, index)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(g, pa.string()) for g in got)], names=[*batch.schema.names, "rule", "verdict", "blocked_word"])

    return parsed.mapInArrow(tidy(run), schema)


def _by_join(parsed: DataFrame, found: DataFrame, shape: Shape) -> DataFrame:
    """The same probes, dealt by key and joined; for indexes too large to ship."""
    head = fresh(parsed, "head")
    keyed = parsed.withColumn(head, F.substring("path", 1, max(shape.paths, default=0)))
    heads = keyed.select("host", F.col(head).alias("head")).distinct()
    schema = "host string, head string, entry string, host_length int"

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, start in zip(batch["host"], batch["head"]):
                rules, words = probes_of(host, start, shape)
                rows += [(host, start, t, n) for t, n in rules] + [(host, start, f"#{w}", -1) for w in words]
            yield pd.DataFrame(rows, columns=["host", "head", "entry", "host_length"])

    probes = heads.mapInPandas(tidy(spread), schema).withColumn("key", F.xxhash64("entry"))
    index = found.select(F.xxhash64("entry").alias("key"), "entry", "host_length", "verdict")
    hits = probes.join(index, ["key", "entry", "host_length"])
    ruled = F.col("host_length") >= 0
    best = F.max(F.when(ruled, F.struct(F.length("entry").alias("n"), "host_length", "entry", "verdict")))
    judged = hits.groupBy("host", "head").agg(best.alias("best"), F.collect_set(F.when(~ruled, F.substring("entry", 2, 1 << 30))).alias("words"))
    theirs = {c: fresh(keyed, f"judged_{c}") for c in ("host", "head", "best", "words")}
    judged = judged.select(*(F.col(c).alias(n) for c, n in theirs.items()))
    joined = keyed.join(judged, (F.col("host") == F.col(theirs["host"])) & (F.col(head) == F.col(theirs["head"])), "left")
    best, words = F.col(theirs["best"]), F.col(theirs["words"])
    first_word = F.get(F.filter(F.split("host", "[-._]"), lambda w: F.array_contains(words, w)), F.lit(0))
    verdict = F.when(best.isNotNull(), F.when(best["verdict"] == 0, "block").otherwise("allow")).when(F.size(words) > 0, "block").otherwise("allow")
    return joined.select(*parsed.columns, best["entry"].alias("rule"), verdict.alias("verdict"), first_word.alias("blocked_word"))


def judge_urls(pages: DataFrame, rules: DataFrame, words: Iterable[str] = BLOCKED_WORDS, url: str = "url", max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``pages`` plus host, path, rule (the winning entry or null), verdict, blocked_word.

    ``rules`` has columns host, path, verdict (block or allow).
    """
    clash = {"host", "path", "rule", "verdict", "blocked_word"} & {c.lower() for c in pages.columns}
    if clash:
        raise ValueError(f"the input already has {sorted(clash)}")
    parsed = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    found = entries(rules, words)
    shape, size = shape_of(found)
    return (_by_index if size <= max_index_bytes else _by_join)(parsed, found, shape)


def keep_allowed(pages: DataFrame, rules: DataFrame, words: Iterable[str] = BLOCKED_WORDS, url: str = "url") -> DataFrame:
    """The rows of ``pages`` whose url is allowed, with their own columns."""
    return judge_urls(pages, rules, words, url).where(F.col("verdict") == "allow").select(*pages.columns)


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def url_report(pages: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, blocked_word."""
    return judge_urls(pages.select("page_id", "url"), rules_table(pages.sparkSession)).drop("url")


def _sql_literal(texts: Iterable[str]) -> str:
    return ", ".join("'" + t.replace("'", "''") + "'" for t in texts)


REPORT_SQL = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {", ".join(f"({_sql_literal(r)})" for r in RULES)}),
u AS (SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fit AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath) * 1000 + length(rhost)) AS rule,
               arg_max(rverdict, length(rhost || rpath) * 1000 + length(rhost)) AS rverdict
        FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid),
w AS (SELECT rid, list_filter(string_split_regex(host, '[-._]'), lambda x: list_contains([{_sql_literal(BLOCKED_WORDS)}], x))[1] AS blocked_word FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN rverdict WHEN blocked_word IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, blocked_word
FROM u LEFT JOIN fit USING (rid) JOIN w USING (rid)
"""
