"""Landing files -> source/quarantine: header refusal, idempotence, replacement."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from wardline.operators import quality as Q
from wardline.registry import Col, TableSpec
from wardline.sinks import files
from wardline.sinks.landing_io import fingerprint, load, read_source, write_landing

SPEC = TableSpec(
    name="t",
    columns=(Col("k", "code"), Col("amount", "decimal"), Col("date_extraction", "date")),
    key=("k",),
    multi_line=True,
)
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, amount string, date_extraction string, path_date date")


def good(day, n=30, prefix="a"):
    return [(f"{prefix}{i}", f"{i}.00", day.strftime("%m/%d/%Y"), day) for i in range(n)]


def state(spark, target):
    src = read_source(spark, target, SPEC)
    return fingerprint(src, SPEC.names, ["path_date"]).orderBy("path_date").collect()


def test_load_is_idempotent_and_replaces_exactly(spark):
    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    write_landing(frame(spark, good(D1) + good(D2)), root, SPEC)
    load(spark, root, target, SPEC)
    first = state(spark, target)
    load(spark, root, target, SPEC)
    assert state(spark, target) == first  # same files twice: same state
    write_landing(frame(spark, good(D2, 10, "b")), root, SPEC)  # corrected file for D2 only
    load(spark, root, target, SPEC, [D2])
    src = read_source(spark, target, SPEC)
    assert src.filter(F.col("path_date") == D2).select("k").rdd.map(lambda r: r[0]).collect().__len__() == 10
    assert src.filter(F.col("path_date") == D1).count() == 30


def test_blocked_file_keeps_previous_content_and_empty_side_is_cleared(spark):
    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    write_landing(frame(spark, good(D1)), root, SPEC)
    load(spark, root, target, SPEC)
    bad = [(f"a{i}", "x", D1.strftime("%m/%d/%Y"), D1) for i in range(30)]
    write_landing(frame(spark, bad), root, SPEC)
    rep = load(spark, root, target, SPEC).first()
    assert rep["state"] == "blocked"
    assert read_source(spark, target, SPEC).count() == 30  # previous content survives
    one_bad = good(D1, 29) + [("z", "x", D1.strftime("%m/%d/%Y"), D1)]
    write_landing(frame(spark, one_bad), root, SPEC)
    load(spark, root, target, SPEC)
    assert read_source(spark, target, SPEC, "quarantine").count() == 1
    write_landing(frame(spark, good(D1)), root, SPEC)  # clean again: quarantine side must empty
    load(spark, root, target, SPEC)
    assert read_source(spark, target, SPEC, "quarantine").count() == 0


def test_header_permuted_or_truncated_is_refused(spark):
    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    write_landing(frame(spark, good(D1)), root, SPEC)
    bad_dir = f"{root}/t/extraction={D2.isoformat()}"
    os.makedirs(bad_dir, exist_ok=True)
    with open(f"{bad_dir}/part-bad.csv", "w") as fh:
        fh.write("amount,k,date_extraction\n1.00,q,01/02/2024\n")
    rep = {r["path_date"]: r["state"] for r in load(spark, root, target, SPEC).collect()}
    assert rep == {D1: "loaded", D2: "invalid_header"}
    assert read_source(spark, target, SPEC).filter(F.col("path_date") == D2).count() == 0


def land_file(root, day, name, text):
    folder = f"{root}/t/extraction={day.isoformat()}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as fh:
        fh.write(text)


def test_one_bad_file_refuses_its_whole_date(spark):
    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    write_landing(frame(spark, good(D1)), root, SPEC)
    load(spark, root, target, SPEC)
    write_landing(frame(spark, good(D1, 12, "new") + good(D2)), root, SPEC)
    land_file(root, D1, "part-bad.csv", "k,amount\nq,1.00\n")
    rep = {r["path_date"]: (r["state"], r["n_read"]) for r in load(spark, root, target, SPEC).collect()}
    assert rep == {D1: ("invalid_header", 0), D2: ("loaded", 30)}
    assert read_source(spark, target, SPEC).filter(F.col("path_date") == D1).count() == 30  # as before


def test_empty_and_header_only_files(spark):
    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    write_landing(frame(spark, good(D1) + good(D2)), root, SPEC)
    load(spark, root, target, SPEC)
    empty = files.fresh_dir(spark, "t-land")
    land_file(empty, D1, "part-0.csv", "k,amount,date_extraction\n")  # landed again without rows
    land_file(empty, D2, "part-0.csv", "")  # not even a header
    rep = {r["path_date"]: (r["state"], r["n_read"]) for r in load(spark, empty, target, SPEC).collect()}
    assert rep == {D1: ("loaded", 0), D2: ("invalid_header", 0)}
    left = {r["path_date"]: r["count"] for r in read_source(spark, target, SPEC).groupBy("path_date").count().collect()}
    assert left == {D2: 30}


def test_period_limits_a_load(spark):
    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    write_landing(frame(spark, good(D1) + good(D2)), root, SPEC)
    rep = load(spark, root, target, SPEC, date_from=D2, date_to=D2).collect()
    assert [r["path_date"] for r in rep] == [D2]


def test_a_load_without_commit_changes_nothing(spark, monkeypatch):
    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    write_landing(frame(spark, good(D1)), root, SPEC)
    load(spark, root, target, SPEC)
    before = state(spark, target)
    write_landing(frame(spark, good(D1, 25, "b")), root, SPEC)

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(files, "write_new", dies)
    with pytest.raises(RuntimeError):
        load(spark, root, target, SPEC)
    monkeypatch.undo()
    assert state(spark, target) == before
    load(spark, root, target, SPEC)
    assert read_source(spark, target, SPEC).count() == 25


def test_fingerprint_sees_values_move_between_columns(spark):
    a = spark.createDataFrame([("x", None, 1)], "p string, q string, g int")
    b = spark.createDataFrame([(None, "x", 1)], "p string, q string, g int")
    assert fingerprint(a, ["p", "q"], ["g"]).first() != fingerprint(b, ["p", "q"], ["g"]).first()


def test_values_that_typing_would_change_are_rejected(spark):
    rows = [("a", "12345678901234567.89"), ("b", "1.239"), ("c", "1.5"), ("d", "-0.10"), ("e", "1e400")]
    df = spark.createDataFrame([(*r, "01/01/2024", D1) for r in rows], "k string, amount string, date_extraction string, path_date date")
    got = {r["k"]: bool(r["reasons"]) for r in Q.with_row_reasons(df, SPEC).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False, "e": True}


def test_rfc_quotes_and_line_breaks_survive(spark):
    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    rows = good(D1, 25) + [('q"1', "1.00", D1.strftime("%m/%d/%Y"), D1), ("line\nbreak", "2.00", D1.strftime("%m/%d/%Y"), D1)]
    write_landing(frame(spark, rows), root, SPEC)
    rep = load(spark, root, target, SPEC).first()
    assert rep["state"] == "loaded" and rep["n_read"] == 27 and rep["n_rejected"] == 0
    keys = {r["k"] for r in read_source(spark, target, SPEC).collect()}
    assert 'q"1' in keys and "line\nbreak" in keys


def test_a_load_leaves_no_scratch(spark):
    from wardline.session import checkpoint_dir

    root, target = files.fresh_dir(spark, "t-land"), files.fresh_dir(spark, "t-target")
    write_landing(frame(spark, good(D1) + good(D2)), root, SPEC)
    base = checkpoint_dir(spark)
    held = lambda: {os.path.join(d, f) for d, _, names in os.walk(base) if not d.startswith(target) for f in names}
    before = held()
    load(spark, root, target, SPEC)
    assert held() == before


def test_anchored_series_share_their_facts(spark, monkeypatch):
    """The versions are looked up once for both marts; alone, each mart has facts of its own."""
    from wardline.plans import quality_plans
    from wardline.plans.catalog import load_all

    registry, asked = load_all(), []
    looked_up = quality_plans.version_in_force
    monkeypatch.setattr(quality_plans, "version_in_force", lambda *a, **k: asked.append(1) or looked_up(*a, **k))
    rows = registry["dq33_series_anchors"].build(spark, "/root/testdata/sf0.001").collect()
    assert len(asked) == 1
    assert len(rows) == 2 and all(r["anchor_ok"] and r["same_digest"] for r in rows)
    for name in ("mrt2_lead_time_by_priority", "mrt3_absence_by_priority"):
        registry[name].build(spark, "/root/testdata/sf0.001")
    assert len(asked) == 3
