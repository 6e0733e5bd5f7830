import random
import unicodedata

from pyspark.sql import functions as F

from wardline.functions import similarity
from wardline.functions.similarity import damerau_levenshtein, damerau_levenshtein_pairs, edits_unsettled, edits_within, jaro_winkler, jaro_winkler_col, jaro_winkler_pairs, jaro_winkler_reaching, v1, v2


def plain_jaro_winkler(s, t):
    """The textbook's loops over single characters."""
    if s == t:
        return 1.0
    if not s or not t:
        return 0.0
    reach = max(max(len(s), len(t)) // 2 - 1, 0)
    used, mine = set(), []
    for i, c in enumerate(s):
        for j in range(max(0, i - reach), min(len(t), i + reach + 1)):
            if j not in used and t[j] == c:
                used.add(j)
                mine.append(c)
                break
    if not mine:
        return 0.0
    m, half = len(mine), sum(c != t[j] for c, j in zip(mine, sorted(used))) / 2
    jaro = (m / len(s) + m / len(t) + (m - half) / m) / 3.0
    prefix = next((k for k, (c, e) in enumerate(zip(s[:4], t[:4])) if c != e), min(4, len(s), len(t)))
    return jaro + prefix * 0.1 * (1.0 - jaro) if jaro > 0.7 else jaro


def plain_damerau(a, b):
    """The textbook's recursion over every earlier transposition."""
    best = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            options = [i if not j else best[i, j - 1] + 1, j if not i else best[i - 1, j] + 1]
            if i and j:
                options.append(best[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            for p in range(1, i):
                for q in range(1, j):
                    if a[p - 1] == b[j - 1] and a[i - 1] == b[q - 1]:
                        options.append(best[p - 1, q - 1] + (i - p - 1) + 1 + (j - q - 1))
            best[i, j] = min(options)
    return best[len(a), len(b)]


def random_pairs(n, longest, seed):
    dice = random.Random(seed)
    for _ in range(n):
        s = "".join(dice.choice("abcdé😀") for _ in range(dice.randint(0, longest)))
        t = list(s)
        for _ in range(dice.randint(0, 4)):
            at = dice.randint(0, len(t))
            t[at : at + dice.randint(0, 2)] = [dice.choice("abcdé😀") for _ in range(dice.randint(0, 2))]
        yield s, "".join(t) if dice.random() < 0.8 else "".join(dice.choice("abc") for _ in range(dice.randint(0, longest)))


def test_columns_of_pairs_equal_the_textbook(monkeypatch):
    pairs = [*random_pairs(3000, 12, 1), *random_pairs(200, 90, 2), ("", ""), ("a", ""), ("", "b"), ("x" * 3000, "x" * 2999 + "y")]
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    want = [plain_jaro_winkler(*p) for p in pairs]
    assert jaro_winkler_pairs(a, b).tolist() == want
    monkeypatch.setattr(similarity, "CELLS", 500)  # many small groups
    assert jaro_winkler_pairs(a[:600], b[:600]).tolist() == want[:600]


def test_columns_of_distances_equal_the_textbook(monkeypatch):
    pairs = [*random_pairs(800, 9, 3), ("", ""), ("a", ""), ("", "bc")]
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    want = [plain_damerau(*p) for p in pairs]
    assert damerau_levenshtein_pairs(a, b).tolist() == want
    monkeypatch.setattr(similarity, "CELLS", 500)
    assert damerau_levenshtein_pairs(a, b).tolist() == want


def test_similarities_that_cannot_reach_a_level_are_not_measured(spark, monkeypatch):
    pairs = [*random_pairs(3000, 12, 4), *random_pairs(200, 90, 5), ("", ""), ("a", ""), ("abcd", "abcdx"), ("martha", "marhta")]
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    want = jaro_winkler_pairs(a, b)
    for least in (0.85, 0.6):
        got = jaro_winkler_reaching(a, b, least)
        assert [x if x >= least else None for x in got] == [x if x >= least else None for x in want]
    measured = []
    monkeypatch.setattr(similarity, "jaro_winkler_pairs", lambda x, y: measured.extend(zip(x, y)) or jaro_winkler_pairs(x, y))
    jaro_winkler_reaching(["red ring", "red ring", "red ring"], ["hot bolt", "red rign", "red ring"], 0.85)
    assert measured == [("red ring", "red rign"), ("red ring", "red ring")]
    rows = spark.createDataFrame([("red ring", "red rign"), ("red ring", "hot bolt"), (None, "x")], "a string, b string")
    got = [r[0] for r in rows.select(jaro_winkler_col(F.col("a"), F.col("b"), 0.85)).collect()]
    assert got[0] == jaro_winkler("red ring", "red rign") and got[1] < 0.85 and got[2] is None


def test_few_edits_are_told_without_measuring(spark):
    pairs = [*random_pairs(800, 9, 6), ("", ""), ("a", ""), ("ca", "abc"), ("912.30", "912.03"), ("ab", "ba"), (None, "a"), ("a", None)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    a, b = F.col("a"), F.col("b")
    for most in (0, 1, 2, 3):
        got = rows.select("i", edits_within(a, b, most).alias("x"), edits_unsettled(a, b, most).alias("open"), edits_within(a, b, most, settled=True).alias("s")).orderBy("i").collect()
        want = [None if None in p else damerau_levenshtein(*p) <= most for p in pairs]
        assert [r["x"] for r in got] == want
        assert all(r["open"] or r["s"] == w for r, w in zip(got, want))  # what is not open needs no measure
    prices = spark.createDataFrame([("912.30", f"9{i:02}.{j}0") for i in range(100) for j in range(10)], "a string, b string")
    assert prices.filter(edits_unsettled(a, b, 1)).count() < 10  # of 1,000; all of them were measured before


def test_missing_sides_and_empty_batches(spark):
    rows = spark.createDataFrame([("a", None), (None, None), ("ab", "ab"), ("ab", "ba")], "a string, b string")
    got = [r[0] for r in rows.repartition(4).select("a", "b", jaro_winkler_col(F.col("a"), F.col("b")).alias("s")).orderBy("a", "b").select("s").collect()]
    assert got == [None, None, 1.0, 0.0]


def run(spark, fn, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").select("i", fn("x").alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_normalisation_v1(spark):
    values = ["  Élodie-Marie  O'Brien ", "ÇA,  va;bien", "", None, "   ", "e\u0301te\u0301\u00a0un"]
    assert run(spark, v1, values) == ["elodie marie o brien", "ca va bien", "", None, "   ", "ete un"]


def test_accents_follow_unicode(spark):
    letters = [chr(c) for c in range(0xC0, 0x250)]
    for letter, got in zip(letters, run(spark, v1, letters)):
        base = "".join(c for c in unicodedata.normalize("NFKD", letter.lower()) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            assert got == base


def test_normalisation_v2_sorts_tokens_and_is_idempotent(spark):
    assert run(spark, v2, ["Marie Élodie"]) == ["elodie marie"]
    once = run(spark, v2, ["Zoé  Anne-Lise"])
    assert run(spark, v2, once) == once


def test_jaro_winkler_known_values():
    assert round(jaro_winkler("martha", "marhta"), 4) == 0.9611
    assert round(jaro_winkler("dwayne", "duane"), 2) == 0.84
    assert jaro_winkler("abc", "abc") == 1.0 and jaro_winkler("", "abc") == 0.0


def test_damerau_levenshtein():
    assert damerau_levenshtein("1980-05-17", "1980-05-71") == 1  # one transposition
    assert damerau_levenshtein("ca", "abc") == 2
    assert damerau_levenshtein("kitten", "sitting") == 3
