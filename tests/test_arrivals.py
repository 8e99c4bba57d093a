"""Cycles driven by announced snapshots."""

import json
import os

from snapfold.streaming.arrivals import run_arrivals

from tests.test_cycle import ANN, BOB, CAT, changed, write


def announce(folder, name, path, as_of, age):
    target = folder / name
    target.write_text(json.dumps({"path": path, "as_of": as_of}))
    os.utime(target, (1_700_000_000 - age, 1_700_000_000 - age))


def test_snapshots_are_taken_in_order_and_once(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    first = write(tmp_path / "1.csv", ANN, BOB)
    second = write(tmp_path / "2.csv", changed(ANN, department="HR"), CAT)
    announce(landing, "z.json", first, "2025-01-01", age=100)
    announce(landing, "a.json", second, "2025-01-02", age=50)
    where = str(landing), str(tmp_path / "checkpoint")
    reports = run_arrivals(lake, *where)
    assert [(r.initial, r.inserted, r.updated, r.deleted) for r in reports] == [
        (True, 0, 0, 0),
        (False, 1, 1, 1),
    ]
    assert run_arrivals(lake, *where) == []
    third = write(tmp_path / "3.csv", CAT)
    announce(landing, "b.json", third, "2025-01-03", age=0)
    (report,) = run_arrivals(lake, *where)
    assert (report.deleted, report.unchanged) == (1, 1)
    assert [r.employee_id for r in lake.table("silver.employees").collect()] == [3]


def test_a_late_snapshot_is_refused(lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    where = str(landing), str(tmp_path / "checkpoint")
    announce(landing, "a.json", write(tmp_path / "1.csv", ANN, BOB), "2025-01-02", age=100)
    run_arrivals(lake, *where)
    announce(landing, "b.json", write(tmp_path / "2.csv", CAT), "2025-01-01", age=50)
    assert run_arrivals(lake, *where) == []
    assert sorted(r.employee_id for r in lake.table("silver.employees").collect()) == [1, 2]
    announce(landing, "c.json", str(tmp_path / "2.csv"), "2025-01-02", age=0)
    assert [r.deleted for r in run_arrivals(lake, *where)] == [2]
