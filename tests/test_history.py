import datetime as dt
import random

from pyspark.sql import functions as F

from wardline.operators.history import as_of_with_fallback, build_versions, change_log, scd_violations, version_in_force

D = dt.date


def _versions(spark):
    rows = [("k1", D(2024, 1, 10), "A", 1), ("k1", D(2024, 3, 5), "B", 2), ("k1", D(2024, 3, 5), "C", 3), ("k2", D(2023, 12, 1), "Z", 4)]
    df = spark.createDataFrame(rows, "key string, day date, attr string, seq int")
    return build_versions(df, "key", "day", ["attr"], "seq")


def test_versions_half_open_and_last_of_day(spark):
    v = {(r["key"], r["valid_from"]): (r["valid_to"], r["attr"], r["is_current"]) for r in _versions(spark).collect()}
    assert v[("k1", D(2024, 1, 10))] == (D(2024, 3, 5), "A", False)
    assert v[("k1", D(2024, 3, 5))] == (None, "C", True)  # largest tie wins on the day


def test_version_in_force_boundaries(spark):
    facts = spark.createDataFrame(
        [("k1", D(2024, 1, 9)), ("k1", D(2024, 1, 10)), ("k1", D(2024, 3, 4)), ("k1", D(2024, 3, 5)), ("k1", D(2030, 1, 1)), ("k9", D(2024, 1, 1))],
        "key string, ev date",
    )
    got = {(r["ev"], r["key"]): r["v_attr"] for r in version_in_force(facts, _versions(spark), "key", "ev", ["attr"]).collect()}
    assert got[(D(2024, 1, 9), "k1")] is None  # before the first version: NULL
    assert got[(D(2024, 1, 10), "k1")] == "A"  # lower bound inclusive
    assert got[(D(2024, 3, 4), "k1")] == "A"
    assert got[(D(2024, 3, 5), "k1")] == "C"  # upper bound exclusive
    assert got[(D(2030, 1, 1), "k1")] == "C"  # open version
    assert got[(D(2024, 1, 1), "k9")] is None


def test_as_of_falls_back_to_first_version(spark):
    facts = spark.createDataFrame([("k1", D(2024, 1, 9)), ("k1", D(2024, 2, 1))], "key string, ev date")
    got = {r["ev"]: (r["v_attr"], r["used_fallback"]) for r in as_of_with_fallback(facts, _versions(spark), "key", "ev", ["attr"]).collect()}
    assert got[D(2024, 1, 9)] == ("A", True) and got[D(2024, 2, 1)] == ("A", False)


def test_change_log_and_invariants(spark):
    v = _versions(spark)
    log = change_log(v, "key", ["attr"], [("attr_only", ["attr"])]).collect()
    assert len(log) == 1 and log[0]["change_type"] == "attr_only"
    assert [(c["column"], c["before"], c["after"]) for c in log[0]["changes"]] == [("attr", "A", "C")]
    bad = scd_violations(v, "key").filter((F.col("n_overlaps") > 0) | (F.col("n_gaps") > 0) | (F.col("n_current") != 1))
    assert bad.count() == 0


def test_hot_key_is_dealt_to_several_tasks(spark):
    """One key with a third of the facts, facts without key or day, a gap between versions."""
    dice = random.Random(9)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    versions = [("hot", day(10 * i), day(10 * i + 10) if i < 59 else None, i) for i in range(60)]
    versions += [(f"k{i}", day(50), day(100), 1) for i in range(20)] + [(f"k{i}", day(120), None, 2) for i in range(20)]
    facts = [(i, "hot" if i % 3 == 0 else dice.choice([None, "none", *[f"k{j}" for j in range(20)]]), day(dice.randint(-5, 650)) if dice.random() < 0.95 else None) for i in range(1500)]
    v = spark.createDataFrame(versions, "key string, valid_from date, valid_to date, attr int")
    f = spark.createDataFrame(facts, "id int, key string, ev date")
    by_key = {}
    for k, a, b, x in versions:
        by_key.setdefault(k, []).append((a, b, x))
    want = {i: next((x for a, b, x in by_key.get(k, []) if e and a <= e and (b is None or e < b)), None) for i, k, e in facts}
    for hot in (50, 100_000):
        assert {r["id"]: r["v_attr"] for r in version_in_force(f, v, "key", "ev", ["attr"], hot_facts=hot).collect()} == want
        got = {r["id"]: (r["v_attr"], r["used_fallback"]) for r in as_of_with_fallback(f, v, "key", "ev", ["attr"], hot_facts=hot).collect()}
        for i, k, e in facts:
            before = [x for a, _, x in by_key.get(k, []) if e and a <= e]
            assert got[i] == ((before[-1], False) if before else (by_key[k][0][2] if k in by_key else None, True))
    plan = version_in_force(f, v, "key", "ev", ["attr"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_vfrom" not in plan and plan.count("Join LeftOuter") == 2  # only the hot keys are joined, no fact with its versions
