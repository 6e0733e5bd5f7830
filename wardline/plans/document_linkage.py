"""Identity linkage on ``documents``: which rows are copies or edited copies of one text.

Population: one record per document, with fields cut from its whole text (first and last
words, the words from its longest words on, a mail address) beside its language and
source. Blocking keys hold rare words, so their number grows with the data. Truth for the
evaluation comes from the texts as wholes: records whose three longest words are the same
(that signature is no compared field, and edits seldom touch it).

Scores come from a model with fixed parameters, which SQL can repeat, and from a fitted
one (EM), whose parameters depend on no one's choice.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators import linkage as L
from wardline.operators.forest import partitions_along, spanning_forest
from wardline.operators.graph import connected_components
from wardline.plans.catalog import query
from wardline.session import checkpoint_dir
from wardline.sinks import files
from wardline.sinks.scratch import Scratch
from wardline.sources.tables import Tables

RULES = [["anchor"], ["second_anchor"], ["opening", "longest"], ["closing", "second"]]
TRUTH_KEYS = ["signature"]
DETERMINISTIC_KEYS = ["anchor", "closing"]
ASSUMED_RECALL = 0.6
THRESHOLD = 0.5
#: values of a weighed column up to which their frequencies are broadcast
FEW_VALUES = 100_000
METRIC_THRESHOLDS = (0.5, 0.9, 0.99)
GRID = [round(0.5 + 0.01 * i, 2) for i in range(50)]
# EM sessions: (blocking rule, comparisons that the block leaves without evidence)
SESSIONS = [(0, ()), (2, ("opening",)), (3, ("closing",))]
FIELDS = ["opening", "closing", "anchor", "second_anchor", "longest", "second", "n_words", "lang", "source", "mail_local", "mail_domain", "signature"]


def comparisons(use_tf: bool = True, with_closing: bool = True, length_window: int = 10, neutral_mail: bool = False) -> list:
    out = [L.TextComparison("opening", "opening")]
    if with_closing:
        out.append(L.TextComparison("closing", "closing"))
    return out + [
        L.Comparison("n_words", "n_words", ((2, "exact", L.exact), (1, f"diff<={length_window}", L.abs_diff_at_most(length_window)))),
        L.Comparison("lang", "lang", ((1, "exact", L.exact),)),
        L.Comparison("source", "source", ((1, "exact", L.exact),), tf=use_tf),
        L.PairComparison("mail", ("mail_local", "mail_domain"), neutral=neutral_mail),
    ]


# ---- fixed values: a model that needs no fitting -------------------------------
FIXED_PRIOR = 0.001
FIXED_M = {
    "opening": {3: 0.80, 2: 0.10, 1: 0.05, 0: 0.05},
    "closing": {3: 0.80, 2: 0.10, 1: 0.05, 0: 0.05},
    "n_words": {2: 0.50, 1: 0.40, 0: 0.10},
    "lang": {1: 0.99, 0: 0.01},
    "source": {1: 0.10, 0: 0.90},
    "mail": {1: 0.05, 2: 0.94, 0: 0.01},
}
FIXED_U = {
    "opening": {3: 0.01, 2: 0.01, 1: 0.02, 0: 0.96},
    "closing": {3: 0.01, 2: 0.01, 1: 0.02, 0: 0.96},
    "n_words": {2: 0.01, 1: 0.05, 0: 0.94},
    "lang": {1: 0.45, 0: 0.55},
    "source": {1: 0.05, 0: 0.95},
    "mail": {1: 0.001, 2: 0.95, 0: 0.049},
}
# --------------------------------------------------------------------------------


def fixed_model(comps: list) -> L.Model:
    """The fixed parameters of the given comparisons."""
    keep = lambda p: {c.name: {lv: p[c.name][lv] for lv in c.gamma_values if lv != -1} for c in comps}
    return L.Model(FIXED_PRIOR, keep(FIXED_M), keep(FIXED_U))


def population(t: Tables) -> DataFrame:
    """LK-1: records; blanks become NULL so that empty values never block together."""
    words = F.filter(F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " "), " "), lambda x: x != "")
    w = t.documents.filter(F.col("text").isNotNull()).select("doc_id", "lang", "source", "text", words.alias("words"))
    # every different word is padded once; only texts with an @ are searched for an address, once for both its parts
    ranked = F.sort_array(F.transform(F.array_distinct("words"), lambda x: F.concat(F.lpad(F.length(x).cast("string"), 5, "0"), x)), False)
    w = w.withColumn("top", F.slice(ranked, 1, 3))
    w = w.withColumn("longest", F.substring(F.get("top", 0), 6, 99_999)).withColumn("second", F.substring(F.get("top", 1), 6, 99_999))
    cut = lambda start, n: F.nullif(F.array_join(F.slice("words", start, n), " "), F.lit(""))
    at = lambda word: F.array_position("words", F.col(word)).cast("int")
    after = lambda word: F.when(F.col(word).isNotNull(), cut(F.greatest(at(word), F.lit(1)), F.lit(5)))
    w = w.withColumn("mail", F.when(F.contains("text", F.lit("@")), F.regexp_extract("text", r"([a-z0-9.]+)@([a-z0-9.]+)", 0)))
    mail = lambda side: F.nullif(F.substring_index("mail", "@", side), F.lit(""))
    return w.select(
        F.col("doc_id").alias("id"),
        cut(F.lit(1), F.lit(8)).alias("opening"),
        cut(F.greatest(F.size("words") - 7, F.lit(1)), F.lit(8)).alias("closing"),
        after("longest").alias("anchor"),
        after("second").alias("second_anchor"),
        "longest",
        "second",
        F.size("words").alias("n_words"),
        F.nullif("lang", F.lit("")).alias("lang"),
        F.nullif("source", F.lit("")).alias("source"),
        mail(1).alias("mail_local"),
        mail(-1).alias("mail_domain"),
        F.nullif(F.array_join("top", " "), F.lit("")).alias("signature"),
    )


POP_SQL = r"""
w0 AS (SELECT doc_id, lang, source, text,
              list_filter(string_split(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g'), ' '), lambda x: x <> '') AS words
       FROM documents WHERE text IS NOT NULL),
w1 AS (SELECT *, list_reverse_sort(list_distinct(list_transform(words, lambda x: lpad(CAST(length(x) AS VARCHAR), 5, '0') || x)))[1:3] AS top FROM w0),
w2 AS (SELECT *, substr(top[1], 6) AS longest, substr(top[2], 6) AS second FROM w1),
pop AS (
  SELECT doc_id AS id, NULLIF(array_to_string(words[1:8], ' '), '') AS opening,
         NULLIF(array_to_string(words[greatest(len(words) - 7, 1):], ' '), '') AS closing,
         CASE WHEN longest IS NOT NULL THEN array_to_string(words[list_position(words, longest):list_position(words, longest) + 4], ' ') END AS anchor,
         CASE WHEN second IS NOT NULL THEN array_to_string(words[list_position(words, second):list_position(words, second) + 4], ' ') END AS second_anchor,
         longest, second, CAST(len(words) AS INTEGER) AS n_words, NULLIF(lang, '') AS lang, NULLIF(source, '') AS source,
         NULLIF(regexp_extract(text, '([a-z0-9.]+)@([a-z0-9.]+)', 1), '') AS mail_local,
         NULLIF(regexp_extract(text, '([a-z0-9.]+)@([a-z0-9.]+)', 2), '') AS mail_domain,
         NULLIF(array_to_string(top, ' '), '') AS signature
  FROM w2)"""


def _pairs_sql() -> str:
    rules = " UNION ALL ".join(
        f"SELECT a.id AS id1, b.id AS id2, {k} AS rule FROM pop a JOIN pop b ON {' AND '.join(f'a.{c} = b.{c}' for c in keys)} AND a.id < b.id" for k, keys in enumerate(RULES)
    )
    return f"pairs AS (SELECT id1, id2, min(rule) AS rule FROM ({rules}) GROUP BY id1, id2)"


def _similarity_sql(x: str, y: str) -> str:
    """The textbook's Jaro-Winkler similarity. DuckDB's own counts transpositions in another way
    where letters repeat; its score is taken where it is far below all thresholds."""
    reach = f"greatest(greatest(length({x}), length({y})) // 2 - 1, 0)"
    free = f"list_min(list_filter(range(greatest(1, e.i - {reach}), least(length({y}), e.i + {reach}) + 1), lambda j: substr({y}, j, 1) = substr({x}, e.i, 1) AND NOT list_contains(s.used, j)))"
    none = "CAST([] AS BIGINT[])"
    # places in y of the matched characters, in the order of x
    used = f"""list_reduce(list_transform(range(0, length({x}) + 1), lambda i: struct_pack(i := i, used := {none})),
      lambda s, e: struct_pack(i := e.i, used := CASE WHEN {free} IS NULL THEN s.used ELSE list_append(s.used, {free}) END)).used"""
    half = f"len(list_filter(range(1, len(u) + 1), lambda k: substr({y}, u[k], 1) <> substr({y}, list_sort(u)[k], 1))) / 2"
    jaro = f"CASE WHEN len(u) = 0 THEN 0.0 ELSE (len(u)::DOUBLE / length({x}) + len(u)::DOUBLE / length({y}) + (len(u) - {half})::DOUBLE / len(u)) / 3.0 END"
    prefix = "CASE " + " ".join(f"WHEN substr({x}, 1, {n}) = substr({y}, 1, {n}) THEN {n}" for n in (4, 3, 2, 1)) + " ELSE 0 END"
    exact = f"list_transform(list_transform([{used}], lambda u: {jaro}), lambda v: CASE WHEN v > 0.7 THEN v + {prefix} * 0.1 * (1 - v) ELSE v END)[1]"
    return f"CASE WHEN jaro_winkler_similarity({x}, {y}) < 0.8 THEN jaro_winkler_similarity({x}, {y}) ELSE {exact} END"


def _text_gamma(c: str) -> str:
    sim = f"({_similarity_sql(f'a.{c}', f'b.{c}')})"
    return f"CASE WHEN a.{c} IS NULL OR b.{c} IS NULL THEN -1 WHEN a.{c} = b.{c} THEN 3 WHEN {sim} >= 0.92 THEN 2 WHEN {sim} >= 0.85 THEN 1 ELSE 0 END AS gamma_{c}"


def _same_gamma(c: str) -> str:
    return f"CASE WHEN a.{c} IS NULL OR b.{c} IS NULL THEN -1 WHEN a.{c} = b.{c} THEN 1 ELSE 0 END AS gamma_{c}"


def _gamma_sql(length_window: int = 10, name: str = "gam", pairs: str = "pairs") -> str:
    return f"""{name} AS (
  SELECT p.id1, p.id2, p.rule, {_text_gamma('opening')}, {_text_gamma('closing')},
         CASE WHEN a.n_words = b.n_words THEN 2 WHEN abs(a.n_words - b.n_words) <= {length_window} THEN 1 ELSE 0 END AS gamma_n_words,
         {_same_gamma('lang')}, {_same_gamma('source')},
         CASE WHEN a.mail_local IS NULL OR a.mail_domain IS NULL OR b.mail_local IS NULL OR b.mail_domain IS NULL THEN 2
              WHEN a.mail_local = b.mail_local AND a.mail_domain = b.mail_domain THEN 1 ELSE 0 END AS gamma_mail,
         a.source AS source_l, a.signature IS NOT DISTINCT FROM b.signature AS is_true
  FROM {pairs} p JOIN pop a ON p.id1 = a.id JOIN pop b ON p.id2 = b.id)"""


def _weight_sql(comps: list) -> str:
    """The fixed model's weight over the gamma columns."""
    terms = [repr(math.log2(FIXED_PRIOR / (1 - FIXED_PRIOR)))]
    for c in comps:
        levels = " ".join(f"WHEN {lv} THEN {math.log2(FIXED_M[c.name][lv] / FIXED_U[c.name][lv])!r}" for lv in c.gamma_values if lv != -1)
        terms.append(f"CASE gamma_{c.name} {levels} ELSE 0 END")
        if c.tf:
            terms.append(f"CASE WHEN gamma_{c.name} = {c.top} AND tf IS NOT NULL THEN log2({FIXED_U[c.name][c.top]!r} / tf) ELSE 0 END")
    return "round(" + " + ".join(terms) + ", 9)"


def _scored_sql(comps: list) -> str:
    return f"""tf AS (SELECT source AS tf_source, COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER () AS tf FROM pop WHERE source IS NOT NULL GROUP BY source),
wgt AS (SELECT g.*, {_weight_sql(comps)} AS match_weight FROM gam g LEFT JOIN tf ON g.source_l = tf.tf_source),
scored AS (SELECT *, round(1 / (1 + pow(2, -match_weight)), 9) AS probability FROM wgt)"""


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(p.strip() for p in parts) + "\n"


GAMMAS = [f"gamma_{c.name}" for c in comparisons()]
BASE = [POP_SQL, _pairs_sql(), _gamma_sql()]
SCORED = [*BASE, _scored_sql(comparisons())]


def _same(rule: int) -> Column:
    """Both sides agree on all keys of a rule."""
    return F.coalesce(reduce(lambda a, b: a & b, [F.col(f"{k}_l") == F.col(f"{k}_r") for k in RULES[rule]]), F.lit(False))


@dataclass
class Run:
    """The population's profiles and their candidate pairs under some comparisons.

    Queries that return pairs list them once (``pairs``). Queries that return counts,
    parameters or curves use ``patterns``: pairs summed where they are formed, by gamma
    pattern, rules of the sessions, truth, and the value whose frequency weighs.
    """

    t: Tables
    comps: list = field(default_factory=comparisons)

    def __post_init__(self):
        checkpoint_dir(self.t.spark)
        self.pop = population(self.t).checkpoint()
        self.prof, self.members = L.profiles(self.pop, "id", FIELDS)
        self.prof = self.prof.checkpoint()
        self._pairs = self._patterns = self._u = None

    def variant(self, comps: list) -> Run:
        """The same population under other comparisons."""
        other = object.__new__(Run)
        other.__dict__ = {**self.__dict__, "comps": comps, "_pairs": None, "_patterns": None, "_u": None}
        return other

    def variants(self, named: dict[str, list]) -> dict[str, Run]:
        """The same population under several lists of comparisons, pairs formed once.

        Every different comparison is made once, on one pass over the candidate pairs and one
        over the random pairs of u; a variant's patterns are sums of those over its own columns.
        """
        different: list = []
        for comps in named.values():
            different += [c for c in comps if c not in different]
        one = self.variant([replace(c, name=f"{c.name}_{k}") for k, c in enumerate(different)])
        random = L.pattern_counts(L.gammas(L.random_pairs(self.pop, "id", L.compared_columns(different)), one.comps), one.comps)
        out = {}
        for name, comps in named.items():
            at = [different.index(c) for c in comps]
            run = self.variant(comps)
            gamma = {f"gamma_{c.name}": F.col(f"gamma_{one.comps[k].name}") for k, c in zip(at, comps)}
            weighs = {f"weighs_{c.name}": F.col(f"weighs_{one.comps[k].name}") for k, c in zip(at, comps) if c.tf}
            flags = {c: F.col(c) for c in (*(f"same_{k}" for k, _ in SESSIONS), "is_true")}
            by = [v.alias(k) for k, v in (gamma | flags | weighs).items()]
            run._patterns = one.patterns.groupBy(*by).agg(F.sum("w").alias("w")).checkpoint()
            run._u = L.levels_share([(*(row[k] for k in at), row[-1]) for row in random], comps)
            out[name] = run
        return out

    def _formed(self) -> DataFrame:
        truth = reduce(lambda a, b: a & b, [F.col(f"{k}_l").eqNullSafe(F.col(f"{k}_r")) for k in TRUTH_KEYS])
        made = L.gammas(L.sided_pairs(self.prof, RULES, FIELDS), self.comps)
        flags = {f"same_{k}": _same(k) for k, _ in SESSIONS} | {"is_true": truth}
        weighing = [F.when(F.col(f"gamma_{c.name}") == c.top, F.col(f"{c.column}_l")).alias(f"weighs_{c.name}") for c in self.comps if c.tf]
        return made.select("pid_l", "pid_r", "w", "rule", *[f"gamma_{c.name}" for c in self.comps], *[v.alias(k) for k, v in flags.items()], *weighing)

    @property
    def pairs(self) -> DataFrame:
        """Profile pairs with their gammas, listed."""
        if self._pairs is None:
            self._pairs = self._formed().checkpoint()
        return self._pairs

    @property
    def patterns(self) -> DataFrame:
        """Candidate pairs as counts ``w`` per pattern."""
        if self._patterns is None:
            made = self._formed() if self._pairs is None else self._pairs
            by = [c for c in made.columns if c not in ("pid_l", "pid_r", "rule", "w")]
            self._patterns = made.groupBy(*by).agg(F.sum("w").alias("w")).checkpoint()
        return self._patterns

    def prior(self) -> float:
        """LK-7: pairs of a deterministic rule / its assumed recall / all pairs."""
        det = L.block_sizes(self.pop, [DETERMINISTIC_KEYS], "id").select("n_pairs", "all_pairs").first()
        prior = (det["n_pairs"] or 0) / ASSUMED_RECALL / det["all_pairs"]
        if not 0 < prior < 1:
            raise ValueError(f"the deterministic rule gives no prior: {det['n_pairs']} of {det['all_pairs']} pairs")
        return prior

    def fit(self) -> L.Model:
        u = self._u or L.estimate_u(self.pop, "id", self.comps)
        prior, n = self.prior(), self.pop.count()
        names = [c.name for c in self.comps]
        estimates: dict[str, list[dict[int, float]]] = {x: [] for x in names}
        info = []
        for rule, blocked in SESSIONS:
            patterns = L.pattern_counts(self.patterns.filter(F.col(f"same_{rule}")), self.comps)
            train = [x for x in names if x not in blocked]
            # the session sees its own pairs only: the expected matches against those
            expected, seen = prior * n * (n - 1) / 2, sum(p[-1] for p in patterns)
            m, rounds = L.em(patterns, self.comps, u, expected / (expected + seen), train)
            for x in train:
                estimates[x].append(m[x])
            info.append({"rule": rule, "trained": train, "iterations": rounds})
        start = L.start_values(self.comps)
        m = {x: {lv: sum(e[lv] for e in found) / len(found) for lv in found[0]} if found else start[x] for x, found in estimates.items()}
        model = L.Model(prior, m, u, info)
        L.refuse_degenerate(model, self.comps)
        return model

    def scored(self, model: L.Model, of: DataFrame | None = None) -> DataFrame:
        """``of`` (the listed pairs, or the patterns) with match_weight and probability."""
        out, tf_cols = self.pairs if of is None else of, {}
        for c in self.comps:
            if c.tf:  # the table is data: rebuilt from the population whenever a model is used
                value = f"weighs_{c.name}"
                tf = L.term_frequencies(self.prof, c.column).select(F.col(c.column).alias(value), F.col(f"tf_{c.column}").alias(f"_tf_{c.name}")).checkpoint()
                # few values would deal all pairs to as few tasks
                out = out.join(F.broadcast(tf) if tf.count() <= FEW_VALUES else tf, value, "left")
                tf_cols[c.name] = f"_tf_{c.name}"
        weight = F.round(L.weight_expr(model, self.comps, tf_cols), 9)
        return out.withColumn("match_weight", weight).withColumn("probability", F.round(L.probability(F.col("match_weight")), 9))

    def record_pairs(self, pairs: DataFrame) -> DataFrame:
        """Profile pairs as record pairs (id1 < id2)."""
        return L.record_pairs(pairs, self.members)

    def truth_pairs(self) -> int:
        return L.block_sizes(self.pop, [TRUTH_KEYS], "id").select("n_pairs").first()["n_pairs"] or 0

    def truth(self) -> DataFrame:
        """LK-16: (id, true_cluster): the smallest id with the signature; without one, alone."""
        known = self.pop.filter(F.col("signature").isNotNull())
        least = known.groupBy("signature").agg(F.min("id").alias("true_cluster"))
        return self.pop.select("id", "signature").join(least, "signature", "left").select("id", F.coalesce("true_cluster", "id").alias("true_cluster"))

    def clusters(self, scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
        """LK-12: (id, cluster_id, cluster_size) at a threshold; singletons kept.

        Profiles are linked; the records of one profile are linked if their own pair is,
        or if the profile is linked with another one.
        """
        linked = scored.filter(F.col("probability") >= threshold).select("pid_l", "pid_r")
        between = linked.filter(F.col("pid_l") != F.col("pid_r"))
        ends = linked.select(F.col("pid_l").alias("pid")).unionByName(linked.select(F.col("pid_r").alias("pid"))).distinct().withColumn("joined", F.lit(True))
        comp = connected_components(self.prof.select(F.col("pid").alias("node")), between, "node", "pid_l", "pid_r").withColumnRenamed("node", "pid")
        m = self.members.join(comp, "pid").join(ends, "pid", "left")
        out = m.select("id", F.when(F.col("joined"), F.col("component")).otherwise(F.col("id")).alias("cluster_id"))
        sizes = out.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"))
        return out.join(sizes, "cluster_id").select("id", "cluster_id", "cluster_size")

    def metrics_along(self, scored: DataFrame, grid: list[float]) -> DataFrame:
        """LK-13/15: metrics of the partition at every threshold of the grid against the true one.

        Global scope is all records; the restricted scope is the records that have a true
        partner. A true cluster is found if one cluster holds exactly its records. All partitions
        come from one spanning forest. Clusters of one record are counted, not listed.
        """
        grid = sorted(grid)
        known = self.pop.filter(F.col("signature").isNotNull()).groupBy("signature").agg(F.count(F.lit(1)).alias("true_size"))
        prof = self.prof.select("pid", "n", "signature").join(known, "signature", "left").withColumn("true_size", F.coalesce("true_size", F.lit(1))).checkpoint()
        nulls = F.col("signature").isNull()
        multi = F.col("true_size") > 1
        true = known.agg(F.count(F.lit(1)).alias("s"), F.count_if(multi).alias("m"))
        total = prof.agg(F.sum("n").alias("n"), F.sum(F.when(nulls, F.col("n")).otherwise(0)).alias("z"), F.sum(F.when(multi, 0).otherwise(F.col("n"))).alias("ones"))
        total = [F.coalesce(x, F.lit(0)) for x in (total.select("n").scalar(), (total.select("z").scalar() + true.select("s").scalar()), total.select("ones").scalar(), true.select("m").scalar())]
        near = scored.filter(F.col("probability") >= grid[0])
        forest = spanning_forest(near, "pid_l", "pid_r", "probability")
        alone = near.filter(F.col("pid_l") == F.col("pid_r")).select(F.col("pid_l").alias("node"), F.col("probability").alias("weight"))
        listed = partitions_along(forest, alone, grid, "pid_l", "pid_r", "probability").withColumnRenamed("node", "pid").join(prof, "pid")
        # a cluster holds records of one true cluster only if its signatures are one and none is missing
        pure = (F.min("signature") == F.max("signature")) & ~F.bool_or(nulls)
        clusters = listed.groupBy("step", "component").agg(F.sum("n").alias("size"), F.coalesce(pure, F.lit(False)).alias("pure"), F.max("true_size").alias("true_size"), F.sum(F.when(multi, 0).otherwise(F.col("n"))).alias("ones"))
        found = F.col("pure") & (F.col("size") == F.col("true_size"))
        per = clusters.groupBy("step").agg(
            F.sum("size").alias("records"), F.count(F.lit(1)).alias("clusters"), F.count_if(F.col("size") > 1).alias("multi"), F.count_if(found).alias("found"),
            F.sum("ones").alias("ones"), F.sum(F.when(F.col("pure"), 0).otherwise(F.col("size"))).alias("mixed"), F.max("size").alias("largest"),
        )
        steps = self.t.spark.createDataFrame([(i, float(t)) for i, t in enumerate(grid)], "step int, threshold double")
        at = lambda c, least=0: F.coalesce(F.col(c), F.lit(least))
        n, n_true, ones, n_multi = total
        return steps.join(F.broadcast(per), "step", "left").select(
            "threshold",
            n.cast("long").alias("n_records"),
            (n - at("records") + at("clusters")).cast("long").alias("n_clusters"),
            at("multi").cast("long").alias("n_multi_clusters"),
            n_true.cast("long").alias("n_true_clusters"),
            (at("found") + ones - at("ones")).cast("long").alias("n_found"),
            n_multi.cast("long").alias("n_true_restricted"),
            at("found").cast("long").alias("n_found_restricted"),
            at("mixed").cast("long").alias("n_over_merged_records"),
            at("largest", 1).cast("long").alias("max_cluster_size"),
        )


_SHARED: dict | None = None


@contextmanager
def shared_runs():
    """Queries built inside share one population and its scored pairs."""
    global _SHARED
    before, _SHARED = _SHARED, {}
    try:
        yield
    finally:
        _SHARED = before


def fixed_run(spark, sf_dir, patterns: bool = False) -> tuple[Run, DataFrame]:
    """Pairs, or patterns only, scored by the fixed model."""
    held = {} if _SHARED is None else _SHARED.setdefault(sf_dir, {})
    run = held["run"] = held.get("run") or Run(Tables(spark, sf_dir))
    if patterns not in held:
        held[patterns] = run.scored(fixed_model(run.comps), run.patterns if patterns else None).checkpoint()
    return run, held[patterns]


def _clusters_sql(thresholds) -> str:
    """Components of the scored pairs at each threshold (walked from every record)."""
    values = ", ".join(f"({t})" for t in thresholds)
    return f"""ths(threshold) AS (VALUES {values}),
e AS (SELECT threshold, id1 AS s, id2 AS d FROM scored, ths WHERE probability >= threshold
      UNION SELECT threshold, id2, id1 FROM scored, ths WHERE probability >= threshold),
walk(threshold, node, label) AS (SELECT threshold, id, id FROM pop, ths
  UNION SELECT w.threshold, e.d, w.label FROM walk w JOIN e ON w.node = e.s AND w.threshold = e.threshold),
cl AS (SELECT threshold, node AS id, min(label) AS cluster_id FROM walk GROUP BY threshold, node),
clu AS (SELECT *, COUNT(*) OVER (PARTITION BY threshold, cluster_id) AS cluster_size FROM cl),
tru AS (SELECT id, CASE WHEN signature IS NULL THEN id ELSE min(id) OVER (PARTITION BY signature) END AS true_cluster FROM pop)"""


METRICS_SQL = """ts AS (SELECT *, COUNT(*) OVER (PARTITION BY true_cluster) AS true_size FROM tru),
cells AS (SELECT c.threshold, c.cluster_id, t.true_cluster, c.cluster_size, t.true_size, COUNT(*) AS n
          FROM clu c JOIN ts t ON c.id = t.id GROUP BY ALL)
SELECT CAST(threshold AS DOUBLE) AS threshold, CAST(SUM(n) AS BIGINT) AS n_records, COUNT(DISTINCT cluster_id) AS n_clusters,
       COUNT(DISTINCT CASE WHEN cluster_size > 1 THEN cluster_id END) AS n_multi_clusters,
       COUNT(DISTINCT true_cluster) AS n_true_clusters,
       COUNT(*) FILTER (WHERE n = cluster_size AND n = true_size) AS n_found,
       COUNT(DISTINCT CASE WHEN true_size > 1 THEN true_cluster END) AS n_true_restricted,
       COUNT(*) FILTER (WHERE n = cluster_size AND n = true_size AND true_size > 1) AS n_found_restricted,
       CAST(SUM(CASE WHEN n < cluster_size THEN n ELSE 0 END) AS BIGINT) AS n_over_merged_records,
       max(cluster_size) AS max_cluster_size
FROM cells GROUP BY threshold"""


@query("lkd1_population", sql=_with(POP_SQL) + "SELECT * FROM pop", ops=("LK-1", "FN-1"))
def lkd1_population(spark, sf_dir):
    """Document records: compared and blocking fields, blanks as NULL."""
    return population(Tables(spark, sf_dir))


@query(
    "lkd2_candidate_pairs",
    sql=_with(*BASE) + f"SELECT id1, id2, rule, {', '.join(GAMMAS)} FROM gam",
    ops=("LK-2", "LK-3", "LK-4", "LK-5", "LK-6", "FN-19"),
    bench=True,
)
def lkd2_candidate_pairs(spark, sf_dir):
    """Candidate pairs by four selective rules, first rule kept, with all comparison levels."""
    run = Run(Tables(spark, sf_dir))
    return run.record_pairs(run.pairs).select("id1", "id2", "rule", *GAMMAS)


@query(
    "lkd11_scored_pairs_fixed",
    sql=_with(*SCORED) + f"SELECT id1, id2, rule, {', '.join(GAMMAS)}, match_weight, probability, is_true FROM scored",
    ops=("LK-10", "LK-11", "FN-22", "IN-37"),
    layer="linkage",
)
def lkd11_scored_pairs_fixed(spark, sf_dir):
    """Weights (with term frequencies) and probabilities under the fixed model."""
    run, scored = fixed_run(spark, sf_dir)
    return run.record_pairs(scored).select("id1", "id2", "rule", *GAMMAS, "match_weight", "probability", "is_true")


@query(
    "lkd12_clusters_fixed",
    sql=_with(*SCORED, _clusters_sql([THRESHOLD]), recursive=True) + "SELECT id, cluster_id, cluster_size FROM clu",
    ops=("LK-12", "LK-15"),
    layer="linkage",
)
def lkd12_clusters_fixed(spark, sf_dir):
    """Clusters at the applied threshold."""
    run, scored = fixed_run(spark, sf_dir)
    return run.clusters(scored)


SWEEP_SQL = f"""SELECT CAST(t AS DOUBLE) AS threshold, tp, fp, tr - tp AS fn, round(tp::DOUBLE / NULLIF(tp + fp, 0), 6) AS precision,
  round(tp::DOUBLE / NULLIF(tr, 0), 6) AS recall, round(2.0 * tp / NULLIF(tp + fp + tr, 0), 6) AS f_score
FROM (SELECT t, COUNT(*) FILTER (WHERE probability >= t AND is_true) AS tp, COUNT(*) FILTER (WHERE probability >= t AND NOT is_true) AS fp,
             (SELECT CAST(SUM(n * (n - 1) / 2) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM pop WHERE signature IS NOT NULL GROUP BY signature)) AS tr
      FROM (SELECT unnest([{', '.join(map(str, GRID))}]) AS t) g LEFT JOIN scored ON TRUE GROUP BY t)"""


@query(
    "lkd13_threshold_sweep_fixed",
    sql=_with(*SCORED) + SWEEP_SQL,
    ops=("LK-13", "LK-14", "IN-37", "IN-39"),
    layer="linkage",
)
def lkd13_threshold_sweep_fixed(spark, sf_dir):
    """True and false pairs, precision, recall and F at the thresholds 0.50 to 0.99."""
    run, scored = fixed_run(spark, sf_dir, patterns=True)
    return L.threshold_sweep(scored, "is_true", F.lit(run.truth_pairs()), GRID)


@query(
    "lkd14_weight_grids_fixed",
    sql=_with(*SCORED)
    + """, low AS (SELECT * FROM scored WHERE match_weight < 0), high AS (SELECT * FROM scored WHERE match_weight >= 0),
ends AS (SELECT (SELECT max(match_weight) FROM low) AS a, (SELECT min(match_weight) FROM high) AS b)
SELECT 'between_modes' AS grid, round(a + (b - a) * k / 10.0, 6) AS weight FROM ends, (SELECT unnest(range(0, 11)) AS k)
UNION ALL
SELECT 'low_mode', round(q, 6) FROM (SELECT unnest(quantile_cont(match_weight, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS q FROM low)""",
    ops=("LK-14",),
)
def lkd14_weight_grids_fixed(spark, sf_dir):
    """Threshold grids in weight space: ten steps between the modes (below and above even
    odds), and the deciles of the low mode."""
    run, scored = fixed_run(spark, sf_dir, patterns=True)
    weights = scored.groupBy("match_weight").agg(F.sum("w").alias("w"))  # one row per different weight
    low, high = weights.filter("match_weight < 0"), weights.filter("match_weight >= 0")
    ends = spark.range(11).select(F.col("id").alias("k"), low.select(F.max("match_weight")).scalar().alias("a"), high.select(F.min("match_weight")).scalar().alias("b"))
    between = ends.select(F.lit("between_modes").alias("grid"), F.round(F.col("a") + (F.col("b") - F.col("a")) * F.col("k") / 10.0, 6).alias("weight"))
    deciles = low.agg(F.percentile("match_weight", F.array(*[F.lit(k / 10) for k in range(1, 10)]), F.col("w")).alias("q"))
    return between.unionByName(deciles.select(F.explode("q").alias("weight")).select(F.lit("low_mode").alias("grid"), F.round("weight", 6).alias("weight")))


@query(
    "lkd15_cluster_metrics_fixed",
    sql=_with(*SCORED, _clusters_sql(METRIC_THRESHOLDS), recursive=True).rstrip() + ",\n" + METRICS_SQL,
    ops=("LK-13", "LK-15", "LK-16", "IN-54"),
)
def lkd15_cluster_metrics_fixed(spark, sf_dir):
    """Cluster metrics at each of three thresholds, global and restricted scope."""
    run, scored = fixed_run(spark, sf_dir)
    return run.metrics_along(scored, list(METRIC_THRESHOLDS))


@query(
    "lkd13_cluster_metrics_all_thresholds",
    sql=_with(*SCORED, _clusters_sql(GRID), recursive=True).rstrip() + ",\n" + METRICS_SQL,
    ops=("LK-13", "LK-15", "LK-16", "IN-39", "IN-54"),
)
def lkd13_cluster_metrics_all_thresholds(spark, sf_dir):
    """Cluster metrics at every threshold of the grid 0.50 to 0.99, from one spanning forest."""
    run, scored = fixed_run(spark, sf_dir)
    return run.metrics_along(scored, GRID)


@query(
    "in35_cluster_sizes",
    sql=_with(*SCORED, _clusters_sql([THRESHOLD]), recursive=True)
    + """SELECT cluster_size, COUNT(DISTINCT cluster_id) AS n_clusters,
round(COUNT(DISTINCT cluster_id)::DOUBLE / SUM(COUNT(DISTINCT cluster_id)) OVER (), 6) AS share FROM clu GROUP BY cluster_size""",
    ops=("IN-35",),
)
def in35_cluster_sizes(spark, sf_dir):
    """Distribution of cluster sizes: clusters, not records."""
    run, scored = fixed_run(spark, sf_dir)
    clusters = run.clusters(scored).select("cluster_id", "cluster_size").distinct()
    total = clusters.select(F.count(F.lit(1))).scalar()
    per = clusters.groupBy("cluster_size").agg(F.count(F.lit(1)).alias("n_clusters"))
    return per.select("cluster_size", "n_clusters", F.round(F.col("n_clusters") / total, 6).alias("share"))


@query(
    "in38_linkage_vs_exact",
    sql=_with(*SCORED)
    + f""", prob AS (SELECT id1, id2 FROM scored WHERE probability >= {THRESHOLD}),
exa AS (SELECT a.id AS id1, b.id AS id2 FROM pop a JOIN pop b ON a.anchor = b.anchor AND a.opening = b.opening AND a.id < b.id
        UNION SELECT a.id, b.id FROM pop a JOIN pop b ON a.anchor = b.anchor AND a.closing = b.closing AND a.id < b.id),
j AS (SELECT p.id1 IS NOT NULL AS by_model, e.id1 IS NOT NULL AS by_rule, a.signature IS NOT DISTINCT FROM b.signature AS is_true
      FROM prob p FULL OUTER JOIN exa e ON p.id1 = e.id1 AND p.id2 = e.id2
      JOIN pop a ON a.id = coalesce(p.id1, e.id1) JOIN pop b ON b.id = coalesce(p.id2, e.id2))
SELECT CASE WHEN by_model AND by_rule THEN 'both' WHEN by_model THEN 'model_only' ELSE 'exact_only' END AS found_by,
       COUNT(*) AS n_pairs, COUNT(*) FILTER (WHERE is_true) AS n_true FROM j GROUP BY 1""",
    ops=("IN-38", "LK-17", "AG-8"),
)
def in38_linkage_vs_exact(spark, sf_dir):
    """Pairs found by the model and by exact collision on two keys: both, one or the other,
    by a full outer join of the two pair lists, and how many of each are true."""
    run, scored = fixed_run(spark, sf_dir)
    model = run.record_pairs(scored.filter(F.col("probability") >= THRESHOLD)).select("id1", "id2").withColumn("by_model", F.lit(True))
    exact = run.record_pairs(L.block_pairs(run.prof, [["anchor", "opening"], ["anchor", "closing"]]).checkpoint()).select("id1", "id2").withColumn("by_rule", F.lit(True))
    both = model.join(exact, ["id1", "id2"], "full_outer")
    side = lambda n: run.pop.select(F.col("id").alias(f"id{n}"), F.col("signature").alias(f"s{n}"))
    both = both.join(side(1), "id1").join(side(2), "id2").withColumn("is_true", F.col("s1").eqNullSafe(F.col("s2")))
    by = F.when(F.col("by_model") & F.col("by_rule"), "both").when(F.col("by_model"), "model_only").otherwise("exact_only")
    return both.groupBy(by.alias("found_by")).agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if("is_true").alias("n_true"))


NO_CLOSING = comparisons(with_closing=False)


@query(
    "lkd20_lost_true_pairs",
    sql=_with(*BASE, _scored_sql(comparisons()), _scored_sql(NO_CLOSING).replace("tf AS (", "tf2 AS (").replace("LEFT JOIN tf ON g.source_l = tf.tf_source", "LEFT JOIN tf2 ON g.source_l = tf2.tf_source").replace("wgt", "wgt2").replace("scored AS", "scored2 AS"))
    + f"""SELECT a.id1, a.id2, {', '.join('a.' + g for g in GAMMAS)}, a.match_weight AS weight_full, b.match_weight AS weight_variant
FROM scored a JOIN scored2 b ON a.id1 = b.id1 AND a.id2 = b.id2
WHERE a.is_true AND a.probability >= {THRESHOLD} AND b.probability < {THRESHOLD} ORDER BY a.id1, a.id2 LIMIT 10""",
    ops=("LK-20", "LK-18"),
)
def lkd20_lost_true_pairs(spark, sf_dir):
    """Ten true pairs that the variant without the closing words loses, with their levels."""
    run, full = fixed_run(spark, sf_dir)
    weight = F.round(L.weight_expr(fixed_model(NO_CLOSING), NO_CLOSING, {c.name: f"_tf_{c.name}" for c in NO_CLOSING if c.tf}), 9)
    both = full.withColumn("weight_variant", weight).withColumn("p_variant", F.round(L.probability(F.col("weight_variant")), 9))
    lost = both.filter(F.col("is_true") & (F.col("probability") >= THRESHOLD) & (F.col("p_variant") < THRESHOLD))
    return run.record_pairs(lost).select("id1", "id2", *GAMMAS, F.col("match_weight").alias("weight_full"), "weight_variant").orderBy("id1", "id2").limit(10)


# ---------------------------------------------------------------- the fitted model in SQL


def _fit_sql(comps: list, tag: str, length_window: int = 10) -> list[str]:
    """CTEs that repeat ``Run.fit``: u of all pairs, EM per session as an iterated one-row query, and
    ``m{tag}`` (comparison, gamma, m, u, prior) as the mean of the sessions that train a comparison.

    m and u are lists over the levels of all comparisons; a pattern is its places in them.
    """
    levels = [(c.name, lv) for c in comps for lv in c.gamma_values if lv != -1]
    place = {x: i + 1 for i, x in enumerate(levels)}
    group = [[i for i, (n, _) in enumerate(levels, 1) if n == name] for name, _ in levels]
    start = [L.start_values(comps)[n][lv] for n, lv in levels]
    # gammas of all pairs of records (up to L.RANDOM_PAIRS of them: all, on the tables that SQL is run on)
    out = [
        f"every{tag} AS (SELECT a.id AS id1, b.id AS id2, 0 AS rule FROM pop a JOIN pop b ON a.id < b.id)",
        _gamma_sql(length_window, f"rnd{tag}", f"every{tag}"),
        f"seen{tag} AS (" + " UNION ALL ".join(f"SELECT {place[n, lv]} AS j, 0.5 + count(*) FILTER (WHERE gamma_{n} = {lv}) AS c, '{n}' AS comparison, {lv} AS gamma FROM rnd{tag}" for n, lv in levels) + ")",
        f"u{tag} AS (SELECT list(c / t ORDER BY j) AS u FROM (SELECT j, c, sum(c) OVER (PARTITION BY comparison) AS t FROM seen{tag}))",
        f"""pri{tag} AS (SELECT d / {ASSUMED_RECALL} / (n * (n - 1) / 2.0) AS prior, n FROM (SELECT count(*) AS n FROM pop),
  (SELECT sum(b * (b - 1) / 2) AS d FROM (SELECT count(*) AS b FROM pop WHERE {' AND '.join(k + ' IS NOT NULL' for k in DETERMINISTIC_KEYS)} GROUP BY {', '.join(DETERMINISTIC_KEYS)})))""",
    ]
    for k, (rule, blocked) in enumerate(SESSIONS):
        train = [c.name for c in comps if c.name not in blocked]
        ix = ", ".join("CASE gamma_" + n + " " + " ".join(f"WHEN {lv} THEN {place[x, lv]}" for x, lv in levels if x == n) + " END" for n in train)
        same = " AND ".join(f"a.{key} = b.{key}" for key in RULES[rule])
        mine = [j for j, (n, _) in enumerate(levels, 1) if n in train]
        out += [
            f"""pat{tag}{k} AS (SELECT list(struct_pack(ix := ix, cnt := cnt) ORDER BY ix) AS ps, sum(cnt) AS total FROM (
  SELECT list_filter([{ix}], lambda x: x IS NOT NULL) AS ix, CAST(count(*) AS DOUBLE) AS cnt
  FROM gam{tag} g JOIN pop a ON g.id1 = a.id JOIN pop b ON g.id2 = b.id WHERE {same} GROUP BY 1))""",
            f"""em{tag}{k}(it, lam, m, delta) AS (
  SELECT 0, prior * n * (n - 1) / 2 / (prior * n * (n - 1) / 2 + total), CAST({start} AS DOUBLE[]), CAST(1e9 AS DOUBLE) FROM pri{tag}, pat{tag}{k}
  UNION ALL
  SELECT it + 1, (list_sum(wp) + 0.01) / (total + 0.02), new, list_max(list_transform(range(1, {len(levels) + 1}), lambda j: abs(new[j] - m[j]))) FROM (
    SELECT it, m, wp, total, list_transform(range(1, {len(levels) + 1}), lambda j: CASE WHEN list_contains({mine}, j)
             THEN acc[j] / list_sum(list_transform({group}[j], lambda i: acc[i])) ELSE m[j] END) AS new FROM (
      SELECT *, list_transform(range(1, {len(levels) + 1}), lambda j: 0.01 + list_sum(list_transform(range(1, len(ps) + 1),
               lambda q: CASE WHEN list_contains(ps[q].ix, j) THEN wp[q] ELSE 0.0 END))) AS acc FROM (
        SELECT it, lam, m, ps, total, list_transform(ps, lambda p: p.cnt * list_reduce(list_prepend(lam, list_transform(p.ix, lambda i: m[i])), lambda x, y: x * y)
                 / (list_reduce(list_prepend(lam, list_transform(p.ix, lambda i: m[i])), lambda x, y: x * y)
                    + list_reduce(list_prepend(1 - lam, list_transform(p.ix, lambda i: u[i])), lambda x, y: x * y))) AS wp
        FROM em{tag}{k}, pat{tag}{k}, u{tag} WHERE it < 25 AND delta >= 1e-4))))""",
            f"fin{tag}{k} AS (SELECT m FROM em{tag}{k} ORDER BY it DESC LIMIT 1)",
        ]
    rows = []
    for n, lv in levels:
        by = [k for k, (_, blocked) in enumerate(SESSIONS) if n not in blocked]
        rows.append(f"SELECT '{n}' AS comparison, {lv} AS gamma, ({' + '.join(f'(SELECT m[{place[n, lv]}] FROM fin{tag}{k})' for k in by)}) / {len(by)} AS m, (SELECT u[{place[n, lv]}] FROM u{tag}) AS u")
    out.append(f"m{tag} AS (" + " UNION ALL ".join(rows) + ")")
    return out


def _fitted_scored_sql(comps: list, tag: str) -> str:
    """``scored{tag}``: the pairs under the fitted model, as ``_scored_sql`` has them under the fixed one."""
    at = lambda c, lv: f"(SELECT log2(m / u) FROM m{tag} WHERE comparison = '{c.name}' AND gamma = {lv})"
    terms = [f"(SELECT log2(prior / (1 - prior)) FROM pri{tag})"]
    for c in comps:
        terms.append(f"CASE gamma_{c.name} " + " ".join(f"WHEN {lv} THEN {at(c, lv)}" for lv in c.gamma_values if lv != -1) + " ELSE 0 END")
        if c.tf:
            terms.append(f"CASE WHEN gamma_{c.name} = {c.top} AND tf IS NOT NULL THEN log2((SELECT u FROM m{tag} WHERE comparison = '{c.name}' AND gamma = {c.top}) / tf) ELSE 0 END")
    return f"""scored{tag} AS (SELECT *, round(1 / (1 + pow(2, -match_weight)), 9) AS probability
  FROM (SELECT g.*, round({' + '.join(terms)}, 9) AS match_weight FROM gam{tag} g LEFT JOIN tf ON g.source_l = tf.tf_source))"""


TF_SQL = "tf AS (SELECT source AS tf_source, COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER () AS tf FROM pop WHERE source IS NOT NULL GROUP BY source)"
FIT = [*BASE, TF_SQL, *_fit_sql(comparisons(), "")]
FITTED = [*FIT, _fitted_scored_sql(comparisons(), "")]


@query(
    "lk9_model_parameters",
    sql=_with(*FIT, recursive=True) + "SELECT comparison, gamma, m, u, TRUE AS trained, (SELECT prior FROM pri) AS prior FROM m",
    ops=("LK-8", "LK-9", "LK-19", "LK-22"),
)
def lk9_model_parameters(spark, sf_dir):
    """m and u per level of the fitted model, as reloaded from its file."""
    run = Run(Tables(spark, sf_dir))
    path = f"{files.fresh_dir(spark, 'model')}/model.json"
    files.write_new(spark, path, run.fit().to_json())
    model = L.Model.from_json(files.read_text(spark, path))
    lost = L.untrained(run.comps, model.sessions)
    rows = [(c.name, int(lv), float(model.m[c.name][lv]), float(model.u[c.name][lv]), c.name not in lost, float(model.prior)) for c in run.comps for lv in c.gamma_values if lv != -1]
    return spark.createDataFrame(rows, "comparison string, gamma int, m double, u double, trained boolean, prior double")


@query("lk18_ablation", sql=None, ops=("LK-18", "LK-13"))
def lk18_ablation(spark, sf_dir):
    """Four variants fitted on the same candidate pairs: metrics at the applied threshold and
    the gap between the mean weights of true and other pairs."""
    run = Run(Tables(spark, sf_dir))
    variants = {"full": run.comps, "no_term_frequency": comparisons(use_tf=False), "no_closing": NO_CLOSING, "length_window_25": comparisons(length_window=25)}
    n_truth = run.truth_pairs()
    parts = []
    for name, one in run.variants(variants).items():
        scored = one.scored(one.fit(), one.patterns)
        hit = F.col("probability") >= THRESHOLD
        weigh = lambda cond: F.sum(F.when(cond, F.col("w") * F.col("match_weight"))) / F.sum(F.when(cond, F.col("w")))
        parts.append(
            scored.agg(
                F.sum("w").cast("long").alias("n_candidate_pairs"),
                F.sum(F.when(hit, F.col("w")).otherwise(0)).cast("long").alias("n_predicted"),
                F.sum(F.when(hit & F.col("is_true"), F.col("w")).otherwise(0)).cast("long").alias("n_true_positive"),
                F.round(weigh(F.col("is_true")) - weigh(~F.col("is_true")), 6).alias("weight_gap"),
            ).withColumn("variant", F.lit(name))
        )
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("n_truth", F.lit(n_truth)).withColumn("recall", F.round(F.try_divide(F.col("n_true_positive"), F.col("n_truth")), 6))


def fitted_run(spark, sf_dir, patterns: bool = False) -> tuple[Run, DataFrame]:
    """Pairs, or patterns only, scored by the fitted model."""
    run = Run(Tables(spark, sf_dir))
    listed = None if patterns else run.pairs  # listed before the fit: its patterns then come from the list
    return run, run.scored(run.fit(), run.patterns if listed is None else listed).checkpoint()


@query(
    "lk11_scored_pairs",
    sql=_with(*FITTED, recursive=True) + f"SELECT id1, id2, rule, {', '.join(GAMMAS)}, match_weight, probability, is_true FROM scored",
    ops=("LK-10", "LK-11", "FN-22"),
    bench=True,
)
def lk11_scored_pairs(spark, sf_dir):
    """Weights and probabilities under the fitted model."""
    run, scored = fitted_run(spark, sf_dir)
    return run.record_pairs(scored).select("id1", "id2", "rule", *GAMMAS, "match_weight", "probability", "is_true")


@query(
    "lk12_clusters",
    sql=_with(*FITTED, _clusters_sql([THRESHOLD]), recursive=True) + f"SELECT id, cluster_id, cluster_size, CAST({THRESHOLD} AS DOUBLE) AS threshold FROM clu",
    ops=("LK-12", "LK-15"),
)
def lk12_clusters(spark, sf_dir):
    """Clusters under the fitted model at the applied threshold."""
    run, scored = fitted_run(spark, sf_dir)
    return run.clusters(scored).withColumn("threshold", F.lit(THRESHOLD))


@query("lk13_threshold_sweep", sql=_with(*FITTED, recursive=True) + SWEEP_SQL, ops=("LK-13", "LK-14", "IN-39", "IN-37"))
def lk13_threshold_sweep(spark, sf_dir):
    """Pair metrics of the fitted model per threshold."""
    run, scored = fitted_run(spark, sf_dir, patterns=True)
    return L.threshold_sweep(scored, "is_true", F.lit(run.truth_pairs()), GRID)


@query(
    "lk15_cluster_metrics",
    sql=_with(*FITTED, _clusters_sql([THRESHOLD]), recursive=True).rstrip() + ",\n" + METRICS_SQL,
    ops=("LK-15", "LK-16", "IN-54"),
)
def lk15_cluster_metrics(spark, sf_dir):
    """Cluster metrics of the fitted model at the applied threshold."""
    run, scored = fitted_run(spark, sf_dir)
    return run.metrics_along(scored, [THRESHOLD])


@query("snk15_linkage_tables", sql=None, ops=("SNK-15", "LK-22"))
def snk15_linkage_tables(spark, sf_dir):
    """Pair, cluster and evaluation tables replaced as wholes on each run: written twice, the
    second run must leave exactly its own rows."""
    run, scored = fitted_run(spark, sf_dir)
    root = files.fresh_dir(spark, "linkage")
    held = Scratch(spark, "linkage-rows")  # each table is made once, then written and counted from what is kept
    made = {
        "pairs": run.record_pairs(scored).select("id1", "id2", "rule", *GAMMAS, "match_weight", "probability"),
        "clusters": run.clusters(scored),
        "evaluation": L.threshold_sweep(scored, "is_true", F.lit(run.truth_pairs()), GRID),
    }
    tables = {name: held.keep(df, name) for name, df in made.items()}
    for _ in range(2):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{root}/{name}")
    parts = [
        spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.lit(df.count()).cast("long").alias("n_rows_of_run"))
        for name, df in tables.items()
    ]
    held.clear()
    return reduce(lambda a, b: a.unionByName(b), parts)
