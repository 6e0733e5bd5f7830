"""Row checks, uniqueness, gate and split on hand-made rows (one partition file)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardline.operators import quality as Q
from wardline.registry import Col, TableSpec

SPEC = TableSpec(
    name="visits",
    columns=(
        Col("n_visit", "code"),
        Col("n_line", "integer"),
        Col("birth", "date", low_bound=dt.date(1890, 1, 1), not_after="date_extraction"),
        Col("arrived", "timestamp", low_bound=dt.date(2000, 1, 1)),
        Col("amount", "decimal"),
        Col("flag", "boolean"),
        Col("date_extraction", "date"),
    ),
    key=("n_visit", "n_line"),
)
DAY = dt.date(2024, 3, 1)
GOOD = {"n_visit": "V1", "n_line": "1", "birth": "05/17/1980", "arrived": "02/28/2024 03:15:00 PM",
        "amount": "12.50", "flag": "1", "date_extraction": "03/01/2024"}


def rows(spark, *overrides):
    data = []
    for i, o in enumerate(overrides):
        r = dict(GOOD, n_visit=f"V{i}")
        r.update(o)
        data.append(tuple(r[c] for c in SPEC.names) + (DAY,))
    return spark.createDataFrame(data, SPEC.text_schema().add("path_date", "date"))


def reasons(spark, *overrides):
    out = Q.check_rows(rows(spark, *overrides), SPEC).select("n_visit", Q.REASONS).collect()
    return {r["n_visit"]: sorted(r[Q.REASONS]) for r in out}


def test_bad_date_and_timestamp_and_their_valid_twins(spark):
    got = reasons(spark, {"birth": "02/30/1980"}, {"arrived": "02/28/2024 15:15:00"}, {})
    assert got["V0"] == ["type_date:birth:02/30/1980"]
    assert got["V1"] == ["type_timestamp:arrived:02/28/2024 15:15:00"]
    assert got["V2"] == []


def test_bounds_and_birth_after_extraction(spark):
    got = reasons(spark, {"birth": "01/01/1889"}, {"birth": "01/01/1898"}, {"birth": "03/02/2024"}, {"arrived": "12/31/1999 11:00:00 PM"})
    assert got["V0"] == ["low_bound:birth:01/01/1889"]
    assert got["V1"] == []
    assert got["V2"] == ["after_extraction:birth:03/02/2024"]
    assert got["V3"] == ["low_bound:arrived:12/31/1999 11:00:00 PM"]


def test_zero_values_and_blanks_pass(spark):
    got = reasons(spark, {"amount": "0"}, {"amount": "0.00"}, {"amount": "", "birth": "", "flag": ""})
    assert got == {"V0": [], "V1": [], "V2": []}


def test_boolean_domain_and_number_forms(spark):
    got = reasons(spark, {"flag": "2"}, {"amount": "1,5"}, {"n_line": "1.0"})
    assert got["V0"] == ["boolean_domain:flag:2"]
    assert got["V1"] == ["type_decimal:amount:1,5"]
    assert got["V2"] == ["type_integer:n_line:1.0"]


def test_two_defects_both_kept(spark):
    got = reasons(spark, {"birth": "13/01/1980", "flag": "x"})
    assert got["V0"] == ["boolean_domain:flag:x", "type_date:birth:13/01/1980"]


def test_partition_mismatch(spark):
    got = reasons(spark, {"date_extraction": "03/02/2024"})
    assert got["V0"] == ["partition_mismatch:date_extraction:03/02/2024"]


def test_repeated_key_only_second_rejected_and_empty_key(spark):
    df = rows(spark, {}, {}, {}, {}).withColumn("n_visit", F.lit("K"))
    df = df.unionByName(rows(spark, {"n_line": "2"}).withColumn("n_visit", F.lit("K")))
    df = df.unionByName(rows(spark, {"n_line": ""}))
    out = Q.check_rows(df, SPEC).collect()
    dup = [r for r in out if any(x.startswith("duplicate:") for x in r[Q.REASONS])]
    assert len(dup) == 3  # four identical K|1 rows: one kept
    assert all(r[Q.REASONS] == ["duplicate:n_visit,n_line:K|1"] for r in dup)
    assert sum(1 for r in out if r["n_visit"] == "K" and r["n_line"] == "2" and not r[Q.REASONS]) == 1
    assert [r[Q.REASONS] for r in out if r["n_line"] == ""] == [["empty_key:n_visit,n_line"]]


def test_first_occurrence_is_smallest_row(spark):
    df = rows(spark, {"amount": "9.00"}, {"amount": "1.00"}).withColumn("n_visit", F.lit("K"))
    out = {r["amount"]: r[Q.REASONS] for r in Q.check_rows(df, SPEC).collect()}
    assert out["1.00"] == [] and out["9.00"] == ["duplicate:n_visit,n_line:K|1"]


@pytest.mark.parametrize(
    "n_rows,n_bad,state",
    [(21, 1, "loaded"), (2, 1, "loaded"), (3, 2, "blocked"), (100, 2, "loaded"), (40, 3, "blocked")],
)
def test_gate(spark, n_rows, n_bad, state):
    over = [{"flag": "9"}] * n_bad + [{}] * (n_rows - n_bad)
    checked = Q.check_rows(rows(spark, *over), SPEC)
    gate = Q.file_gate(checked, ["path_date"]).first()
    assert gate["state"] == state and gate["n_read"] == n_rows and gate["n_rejected"] == n_bad
    accepted, rejected = Q.split_loaded(checked, Q.file_gate(checked, ["path_date"]), ["path_date"])
    if state == "loaded":
        assert accepted.count() == n_rows - n_bad and rejected.count() == n_bad
    else:
        assert accepted.count() == 0 and rejected.count() == 0


def test_reasons_parse_back(spark):
    checked = Q.check_rows(rows(spark, {"arrived": "01/01/1999 10:00:00 AM", "flag": "z"}), SPEC)
    q = Q.quarantine_rows(checked.filter(F.size(Q.REASONS) > 0))
    parsed = sorted(tuple(r) for r in Q.explode_reasons(q).collect())
    assert parsed == [("boolean_domain", "flag", "z"), ("low_bound", "arrived", "01/01/1999 10:00:00 AM")]


def test_many_identical_copies_are_chunked(spark):
    from wardline.operators.quality import uniqueness_flags

    df = rows(spark, {}).withColumn("n_visit", F.lit("K"))
    many = df
    for _ in range(5):
        many = many.unionByName(many)  # 32 identical rows
    many = many.unionByName(rows(spark, {"n_line": "2"}).withColumn("n_visit", F.lit("K")))
    flags = uniqueness_flags(many, SPEC.key, ["path_date"], chunk=5).groupBy("n_line", "_dup").count().collect()
    got = {(r["n_line"], r["_dup"]): r["count"] for r in flags}
    assert got == {("1", False): 1, ("1", True): 31, ("2", False): 1}


def test_only_rows_of_repeated_keys_move(spark):
    from wardline.operators.quality import uniqueness_flags

    df = rows(spark, *[{"n_visit": f"W{i}"} for i in range(50)], {"n_visit": "W7", "amount": "1.00"}, {"n_visit": ""}, {"n_visit": ""})
    flags = uniqueness_flags(df, SPEC.key, ["path_date"])
    plan = flags._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if "LeftAnti" in line)
    assert "BroadcastHashJoin" in lines[at]  # rows of other keys are not shuffled
    got = {(r["n_visit"], r["amount"]): (bool(r["_empty"]), r["_dup"]) for r in flags.collect()}
    assert flags.count() == 53 and got["W7", "1.00"] == (False, False) and got["W7", "12.50"] == (False, True)
    assert got["", "12.50"] == (True, False) and got["W8", "12.50"] == (False, False)


def test_outcome_keeps_rejected_rows_whole(spark):
    checked = Q.check_rows(rows(spark, {}, {"amount": "x"}), SPEC)
    kept = {r["amount"]: r for r in Q.outcome(checked).collect()}
    assert set(kept) == {None, "x"} and kept["x"]["n_visit"] == "V1" and kept[None][Q.REASONS] == []
    assert set(kept["x"].asDict()) == set(checked.columns)
