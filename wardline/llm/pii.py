"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

1. Seeds: the base kinds (email, ip, card, phone) are found in every whole text, leftmost
   and non-overlapping per kind, and validated.
2. Lexical patterns: the word, and the two words, in front of an identifier-like string. A
   pattern counts once it has preceded ``MIN_SEEDS`` different identifiers: seeds, or strings
   accepted in an earlier round, so that what is discovered induces patterns of its own.
3. All occurrences in the corpus of the patterns that can ever count are counted, whatever
   follows, so a pattern's confidence is the share of its occurrences that an identifier follows.
4. Pattern-instance graph: instances are the identifier-like strings (seeds and
   candidates) that follow a pattern. Rounds alternate: a pattern's confidence is the
   summed score of its instances over its occurrences; a candidate's score is the
   noisy-or of its patterns' confidences; seeds keep score 1. Scores only rise from round to
   round; the last round is the one in which none rises by more than ``SETTLED``.
5. Candidates that end at ``ACCEPT`` or more are unseen identifiers: every occurrence of
   one becomes a span of kind ``context``, unless it overlaps a base span.

Offsets are code points, end exclusive. The base patterns are written so that they run in
linear time (possessive repeats, and a run is entered only at its start or where the
previous match ended); they match exactly what the plain patterns match.

Cases: null texts count as empty; texts without a match give zero counts and empty
strings; rows repeated with the same id and text get the same spans; an empty table
gives an empty result; extra columns are not read. Frequent patterns and values are
summed map-side, so no group is collected; the spans of one document are gathered per
document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import cut, text_or_empty
from wardline.sinks.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 3
SETTLED = 0.001
ACCEPT = 0.8
#: a pattern table up to so many rows (a hash and a count each) is broadcast, a larger one is shuffled
BROADCAST_PATTERNS = 200_000
NEAR_CHARS = 120  # where the two words in front of an instance are looked for first

# ---- fixed values: the base kinds, in linear-time form ----
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
# an identifier-like run that is no base kind: has a digit or @
_RUN = r"(?<![A-Za-z0-9_.%+@-])[A-Za-z_.%+-]*+[0-9@][A-Za-z0-9_.%+@-]*+"
_INSTANCE = "|".join((_EMAIL, _PHONE, r"(?<![A-Za-z0-9_.%+@-])" + _IP + r"(?![A-Za-z0-9_%+@-])", r"(?<![A-Za-z0-9_.%+@-])" + _CARD + r"(?![A-Za-z0-9_%+@-])", _RUN))
# -----------------------------------------------------------


def _located(text: Column, pattern: str) -> Column:
    """array<struct<s, e, v, before>> of all matches; ``before`` is the text since the last one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    item = "struct<s:int,e:int,v:string,before:string>"
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{item}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["p"])
        end = start + F.length(x["m"])
        one = F.struct(start.alias("s"), end.alias("e"), x["m"].alias("v"), x["p"].alias("before")).cast(item)
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(one)).alias("out"))

    def place(m: Column) -> Column:
        pairs = F.arrays_zip(F.slice(pieces, 1, F.size(m)).alias("p"), m.alias("m"))
        return F.aggregate(pairs, zero, step, lambda acc: acc["out"])

    none = F.array().cast(f"array<{item}>")
    return F.when(F.size(found) > 0, place(found)).otherwise(none)


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    places = F.sequence(F.lit(1), F.length(d))

    def add(total: Column, i: Column) -> Column:
        one = F.substring(d, i, F.lit(1)).cast("int")
        double = F.when(one > 4, one * 2 - 9).otherwise(one * 2)
        return total + F.when((F.length(d) - i) % 2 == 1, double).otherwise(one)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        part = lambda x: F.length(F.ltrim(x, F.lit("0"))) <= 3
        small = lambda x: part(x) & (F.coalesce(F.substring(F.ltrim(x, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(v, r"\."), small)
    if kind == "card":
        d = _digits(v)
        return F.length(d).between(14, 19) & F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(v)).between(10, 15)
    return F.lit(True)


#: what a text must hold to hold a kind: spares the pattern most texts
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e>> of the valid base spans, by start, then kind as listed."""

    def of(k: int, kind: str) -> Column:
        found = F.filter(_located(text, PATTERNS[kind]), lambda x: _valid(kind, x["v"]))
        spans = F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
        if _NEEDS[kind]:
            spans = F.when(F.contains(text, F.lit(_NEEDS[kind])), spans).otherwise(F.array().cast("array<struct<s:int,k:int,e:int>>"))
        return spans

    return F.array_sort(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)]))


def _kind_of(v: Column) -> Column:
    """The base kind that a whole string is, or null."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        whole = v.rlike("^(?:" + PATTERNS[kind] + ")$")
        out = F.when(whole & F.when(whole, _valid(kind, v)).otherwise(F.lit(False)), F.lit(kind)).otherwise(out)
    return out


def _chunks(text: Column) -> Column:
    """Words in lower case, cut at white space and behind = and : ("id=42" is "id=", "42")."""
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+|(?<=[=:])"), lambda x: x != "")


def _pattern(level: int, *words: Column) -> Column:
    return F.xxhash64(F.lit(level), *words)


def instances(docs: DataFrame) -> DataFrame:
    """Identifier-like strings with their two preceding words: (doc_id, h, s, e, v, kind, patterns)."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.posexplode(_located(F.col("text"), _INSTANCE)).alias("i", "x"))
    before = F.col("x.before")
    near = _chunks(F.substring(before, -NEAR_CHARS, NEAR_CHARS))
    # three words near by: the last two are whole. Otherwise the text is read back to the instance
    # before, whose rest the first word may be; a word that runs into the instance is no pattern
    words = _chunks(before)
    torn = (F.col("i") > 0) & ~before.rlike(r"^[\x20\x09-\x0D]")
    words = F.when(torn, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(words)
    words = F.when((F.length(before) > NEAR_CHARS) & (F.size(near) >= 3), near).otherwise(words)
    words = F.when(before.rlike(r"[\x20\x09-\x0D=:]$"), words).otherwise(F.array().cast("array<string>"))
    one = F.element_at(F.col("w"), -1)
    two = F.element_at(F.col("w"), -2)
    out = rows.select("doc_id", "h", F.col("x.s").alias("s"), F.col("x.e").alias("e"), F.col("x.v").alias("v"), words.alias("w"))
    pats = F.filter(
        F.array(F.when(F.size("w") >= 1, _pattern(1, one)), F.when(F.size("w") >= 2, _pattern(2, two, one))),
        lambda p: p.isNotNull(),
    )
    return out.select("doc_id", "h", "s", "e", "v", _kind_of(F.col("v")).alias("kind"), pats.alias("patterns"))


def _identifier_like(v: Column) -> Column:
    """A candidate: six characters or more with three digits or more, or an inner @."""
    return (F.length(v) >= 6) & ((F.length(_digits(v)) >= 3) | v.rlike(r"[^@]@[^@]"))


def pattern_occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(p, occurs): how often each pattern stands in the corpus, whatever follows it; words of seeds included."""
    words = _chunks(F.col("text"))
    nth = lambda w, i: F.get(w, i)
    keys = F.flatten(
        F.transform(F.col("w"), lambda x, i: F.array(_pattern(1, x), F.when(i > 0, _pattern(2, nth(F.col("w"), i - 1), x))))
    )
    said = docs.select(words.alias("w")).select(F.explode(keys).alias("p"))
    if patterns.count() <= BROADCAST_PATTERNS:
        return said.join(F.broadcast(patterns), "p").groupBy("p").agg(F.count(F.lit(1)).alias("occurs"))
    # summed before anything is shuffled by pattern, so that a frequent word is one row a task
    return said.groupBy("p").agg(F.count(F.lit(1)).alias("occurs")).join(patterns, "p")


def score_graph(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(v) of candidates whose final score reaches ``ACCEPT``."""
    links = found.where(F.col("kind").isNotNull() | _identifier_like(F.col("v"))).select("v", "kind", F.explode("patterns").alias("p"))
    links = cut(links.groupBy("p", "v").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("kind").isNotNull()).alias("seed")))
    # whatever is accepted later, no other pattern can come to precede MIN_SEEDS identifiers
    able = links.groupBy("p").agg(F.count(F.lit(1)).alias("strings"), F.sum("n").alias("linked")).where(F.col("strings") >= MIN_SEEDS)
    able = cut(able.select("p", "linked"))
    occurs = pattern_occurrences(docs, able.select("p"))
    totals = able.join(occurs, "p", "left").select("p", F.greatest("linked", F.coalesce("occurs", F.lit(0))).alias("total"))
    edges = cut(links.join(totals, "p"))
    scratch = Scratch(docs.sparkSession, "pii-scores")
    values = scratch.keep(edges.where(~F.col("seed")).select("v").distinct().withColumns({"value": F.lit(0.0), "rise": F.lit(0.0)}), "values")
    rise = 1.0
    while rise > SETTLED:
        score = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("value", F.lit(0.0)))
        scored = edges.join(values, "v", "left").select("p", "n", "total", score.alias("score"))
        conf = scored.groupBy("p").agg((F.sum(F.col("n") * F.col("score")) / F.first("total")).alias("conf"), F.count_if(F.col("score") >= ACCEPT).alias("known"))
        conf = conf.where(F.col("known") >= MIN_SEEDS)
        # noisy-or; a confidence of 1 is kept just below it so that the product stays defined
        miss = F.log(1.0 - F.least(F.col("conf"), F.lit(1.0 - 1e-9)))
        value = edges.where(~F.col("seed")).join(conf, "p").groupBy("v").agg(F.round(1.0 - F.exp(F.sum(miss)), 9).alias("now"))
        after = values.join(value, "v", "left").select("v", F.coalesce("now", F.lit(0.0)).alias("value"), (F.coalesce("now", F.lit(0.0)) - F.col("value")).alias("rise"))
        values = scratch.keep(after, "values")
        rise = values.agg(F.max("rise")).first()[0] or 0.0
    return values.where(F.col("value") >= ACCEPT).select("v")


def extract(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base (spans of base kinds), found (spans of discovered identifiers)."""
    docs = docs.select("doc_id", text_or_empty("text").alias("text"))
    every = cut(instances(docs))
    accepted = score_graph(docs, every)
    hits = every.where(F.col("kind").isNull()).join(accepted, "v").groupBy("doc_id", "h").agg(F.collect_set(F.struct("s", "e")).alias("hits"))
    hits = hits.select(F.col("doc_id").alias("d"), F.col("h").alias("t"), "hits")
    base = docs.select("doc_id", F.xxhash64("text").alias("h"), base_spans(F.col("text")).alias("base"))
    joined = base.join(hits, base["doc_id"].eqNullSafe(hits["d"]) & (base["h"] == hits["t"]), "left")
    clear = F.filter(
        F.coalesce("hits", F.array().cast("array<struct<s:int,e:int>>")),
        lambda x: ~F.exists(F.col("base"), lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])),
    )
    found = F.transform(clear, lambda x: F.struct(x["s"].alias("s"), F.lit(len(KINDS)).alias("k"), x["e"].alias("e")))
    return joined.select("doc_id", "base", F.array_sort(found).alias("found"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "context")])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, base_sha256, spans (base and discovered), n_context."""

    def count(k: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{kind}")

    counts = [count(k, kind) for k, kind in enumerate(KINDS)]
    return extract(docs).select(
        "doc_id",
        *counts,
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "found"))).alias("spans"),
        F.size("found").cast("long").alias("n_context"),
    )
