"""Whole cycles from snapshot files to the aggregate tables."""

import csv
import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from snapfold import schemas
from snapfold.operators import cdc
from snapfold.operators.keys import KeyViolation
from snapfold.plans import cycle
from snapfold.plans.cycle import run_cycle
from snapfold.sources.lake import WIDE_LAYOUTS, Lake

from tests.golden import AS_OF, KPI, PEOPLE, TRENDS

COLUMNS = list(schemas.SNAPSHOT_COLUMNS)
ANN = ["1", " ann ", "o'neil", "Ops", "annexample.com", "(1) 2", "Active", "$100", "2020-01-01", "", "x\ny"]
BOB = ["2", "bob", "ray", "Ops", "b@x.org", "3", "Terminated", "200", "2020-01-01", "2021-01-01", "z"]
CAT = ["3", "cat", "lee", "HR", "user_no_domain", "", "Active", "300", "2022-05-05", "2021-01-01", "unknown"]
DAN = ["4", "dan", "poe", "HR", "d@x.org", "4", "Terminated", "400", "2019-01-01", "2019-06-01", "q"]


def write(path, *records):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(COLUMNS)
        writer.writerows(records)
    return str(path)


def changed(record, **values):
    return [values.get(c, v) for c, v in zip(COLUMNS, record, strict=True)]


def test_golden_cycle(spark, lake, tmp_path):
    path = write(tmp_path / "1.csv", *PEOPLE)
    assert run_cycle(lake, path, AS_OF) == cycle.CycleReport(True, 8, 0, 0, 0, 0, 3, 3)
    assert [tuple(r) for r in lake.table("gold.department_kpi").collect()] == KPI
    assert [tuple(r) for r in lake.table("gold.hiring_trends").collect()] == TRENDS
    state = lake.table("silver.employees").collect()
    assert run_cycle(lake, path, "2025-01-11") == cycle.CycleReport(False, 8, 0, 0, 0, 8, 3, 3)
    assert sorted(lake.table("silver.employees").collect()) == sorted(state)
    assert {r.last_updated for r in lake.table("gold.department_kpi").collect()} == {
        dt.date(2025, 1, 11)
    }


def test_two_days(spark, lake, tmp_path):
    run_cycle(lake, write(tmp_path / "1.csv", ANN, BOB, CAT), "2025-01-01")
    assert {tuple(r) for r in lake.table("silver.employees").collect()} == {
        (1, "Ann", "O'Neil", "Ops", "ann@example.com", "12", "Active", 100,
         dt.date(2020, 1, 1), None, False, "x y", dt.date(2025, 1, 1)),
        (2, "Bob", "Ray", "Ops", "b@x.org", "3", "Terminated", 200,
         dt.date(2020, 1, 1), dt.date(2021, 1, 1), False, "z", dt.date(2025, 1, 1)),
        (3, "Cat", "Lee", "HR", None, None, "Active", 300,
         None, None, True, None, dt.date(2025, 1, 1)),
    }
    second = write(
        tmp_path / "2.csv",
        changed(ANN, status="Terminated", salary="150", termination_date="2024-12-12"),
        changed(CAT, email="cat@x.org"),
        DAN,
    )
    report = run_cycle(lake, second, "2025-01-02")
    assert report == cycle.CycleReport(False, 3, 1, 1, 1, 1, 2, 3)
    assert {tuple(r) for r in lake.table("silver.employees").collect()} == {
        (1, "Ann", "O'Neil", "Ops", "ann@example.com", "12", "Terminated", 100,
         dt.date(2020, 1, 1), dt.date(2025, 1, 2), False, "x y", dt.date(2025, 1, 2)),
        (3, "Cat", "Lee", "HR", None, None, "Active", 300,
         None, None, True, None, dt.date(2025, 1, 1)),
        (4, "Dan", "Poe", "HR", "d@x.org", "4", "Terminated", 400,
         dt.date(2025, 1, 2), None, False, "q", dt.date(2025, 1, 2)),
    }
    kpi = {r.department: r for r in lake.table("gold.department_kpi").collect()}
    assert kpi["HR"].total_employees == 1 and kpi["HR"].avg_salary == Decimal("400.00")
    # The same snapshot again: the raise is still not taken over, so it is found again.
    again = run_cycle(lake, second, "2025-01-03")
    assert (again.inserted, again.updated, again.deleted, again.unchanged) == (0, 1, 0, 2)


def test_salary_can_be_taken_over(spark, lake, tmp_path):
    rules = cdc.EMPLOYEES.also_applying("salary")
    run_cycle(lake, write(tmp_path / "1.csv", ANN), "2025-01-01", rules)
    raised = write(tmp_path / "2.csv", changed(ANN, salary="150"))
    assert run_cycle(lake, raised, "2025-01-02", rules).updated == 1
    assert run_cycle(lake, raised, "2025-01-03", rules).unchanged == 1
    assert lake.table("silver.employees").first().salary == 150


def test_bronze_and_its_staging_view(spark, lake, tmp_path):
    run_cycle(lake, write(tmp_path / "1.csv", ANN, BOB), "2025-01-01")
    bronze = lake.table("bronze.employees")
    assert bronze.columns == [*COLUMNS, "ingestion_timestamp"]
    assert dict(bronze.dtypes)["employee_id"] == "int"
    assert bronze.where("ingestion_timestamp IS NULL").count() == 0
    staging = spark.table(lake.catalog_name("bronze.tmp_employees"))
    assert staging.columns == COLUMNS
    first = staging.where("employee_id = 1").first()
    assert first.salary == "$100" and first.address == "x\ny" and first.termination_date is None


def test_staging_is_cleared_and_the_view_shows_what_is_left(spark, lake, tmp_path):
    run_cycle(lake, write(tmp_path / "1.csv", ANN), "2025-01-01", keep=1)
    second = write(tmp_path / "2.csv", changed(ANN, salary="150"), BOB)
    run_cycle(lake, second, "2025-01-02", keep=1)
    assert spark.table(lake.catalog_name(cycle.STAGING_VIEW)).count() == 0
    # The raise is not taken over; old versions are gone, the view is on the published ones.
    changes = spark.table(lake.catalog_name(cycle.CHANGES_VIEW)).collect()
    assert {r.employee_id: r.cdc_action for r in changes} == {1: "UPDATE", 2: "NO_CHANGE"}


def test_another_session_reads_the_stored_view_before_and_after(spark, lake, tmp_path):
    run_cycle(lake, write(tmp_path / "1.csv", ANN, BOB, CAT), "2025-01-01")
    other = spark.newSession()
    view = lake.catalog_name(cycle.CHANGES_VIEW)

    def seen():
        return {r.employee_id: r.cdc_action for r in other.table(view).collect()}

    assert seen() == {1: "NO_CHANGE", 2: "NO_CHANGE", 3: "NO_CHANGE"}
    cycle.load_bronze(lake, write(tmp_path / "2.csv", changed(ANN, salary="150"), changed(CAT, status="Leave"), DAN))
    incoming = cycle.stage_incoming(lake, "2025-01-02")
    assert seen() == {1: "UPDATE", 2: "DELETE", 3: "UPDATE", 4: "INSERT"}
    want = sorted(map(tuple, cdc.classify(incoming, lake.table(cycle.SILVER)).collect()), key=repr)
    assert sorted(map(tuple, other.table(view).collect()), key=repr) == want
    cycle.update_silver(lake, incoming, as_of="2025-01-02")
    # Live: the raise is left over, as ever.
    assert seen() == {1: "UPDATE", 3: "NO_CHANGE", 4: "NO_CHANGE"}
    assert lake.expire() > 0
    assert seen() == {1: "UPDATE", 3: "NO_CHANGE", 4: "NO_CHANGE"}
    assert other.table(lake.catalog_name(cycle.SILVER)).count() == 3


def test_incoming_rows_are_exchanged_once(spark, lake, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    run_cycle(lake, write(tmp_path / "1.csv", ANN, BOB, CAT), "2025-01-01")
    plans = []
    insert = DataFrameWriter.insertInto
    monkeypatch.setattr(
        DataFrameWriter, "insertInto",
        lambda self, *a: plans.append(self._df._jdf.queryExecution().executedPlan().toString()) or insert(self, *a),
    )
    cycle.load_bronze(lake, write(tmp_path / "2.csv", ANN, DAN))
    plans.clear()
    incoming = cycle.stage_incoming(lake, "2025-01-02")
    cycle.update_silver(lake, incoming, as_of="2025-01-02")
    staged, settled = plans
    assert staged.count("Exchange") == 1 and "Window" in staged
    assert "SortMergeJoin" in settled and "Exchange" not in settled and "Sort [" not in settled


def test_an_empty_snapshot_deletes_everything(lake, tmp_path):
    run_cycle(lake, write(tmp_path / "1.csv", ANN, BOB), "2025-01-01")
    report = run_cycle(lake, write(tmp_path / "2.csv"), "2025-01-02")
    assert (report.rows, report.deleted) == (0, 2)


def test_wide_tables_take_what_int_does_not(spark, lake, tmp_path):
    rich = [changed(ANN, employee_id=str(5_000_000_000 + i), salary="90000000") for i in range(30)]
    path = write(tmp_path / "1.csv", *rich)
    wide = Lake(spark, str(tmp_path / "wide"), prefix="wide_", layouts=WIDE_LAYOUTS)
    run_cycle(wide, path, "2025-01-01")
    assert run_cycle(wide, path, "2025-01-02").unchanged == 30
    row = wide.table("gold.department_kpi").first()
    assert (row.total_employees, row.total_salary_cost) == (30, 2_700_000_000)
    assert wide.table("silver.employees").agg({"employee_id": "max"}).first()[0] == 5_000_000_029
    with pytest.raises(PySparkException):
        run_cycle(lake, path, "2025-01-01")
    # Keys that fit, a total that doesn't.
    small = [changed(r, employee_id=str(i)) for i, r in enumerate(rich)]
    with pytest.raises(PySparkException):
        run_cycle(lake, write(tmp_path / "2.csv", *small), "2025-01-01")
    assert not lake.exists("gold.department_kpi")


def test_rules_with_another_key_check_that_key(lake, tmp_path):
    rules = replace(cdc.EMPLOYEES, key=("email",))
    path = write(tmp_path / "1.csv", ANN, changed(BOB, email=ANN[4]))
    with pytest.raises(KeyViolation, match="email"):
        run_cycle(lake, path, "2025-01-01", rules)


QUOTED = [changed(ANN, employee_id=str(i), address=f'No. {i},\nsome "street"') for i in range(1, 41)]


@pytest.mark.parametrize("split", [40, 700, 10**8])
@pytest.mark.parametrize("lost", ["first address", "last address", "name", "last line"])
def test_a_lost_quote_aborts_and_deletes_nothing(spark, lake, tmp_path, lost, split):
    good = write(tmp_path / "1.csv", *QUOTED)
    run_cycle(lake, good, "2025-01-01")
    text = open(good).read()
    last = text.rindex('"\n')
    broken = {
        "first address": lambda: text.replace('"\n2,', "\n2,", 1),
        "last address": lambda: text[:last] + text[last + 1 :],
        "name": lambda: text.replace("\n7, ann ", '\n7," ann ', 1),
        "last line": lambda: text + '41,"x',
    }[lost]()
    assert broken.count('"') % 2 == 1
    (tmp_path / "2.csv").write_text(broken)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, f"{split}b")
    try:
        with pytest.raises((PySparkException, Py4JJavaError), match="quote"):
            run_cycle(lake, str(tmp_path / "2.csv"), "2025-01-02")
    finally:
        spark.conf.set(name, before)
    for table in ("bronze.employees", "silver.employees"):
        assert lake.table(table).count() == 40
    assert lake.history().where("table_name = 'bronze.employees'").count() == 1


@pytest.mark.parametrize(
    "bad, error",
    [
        ([ANN, ANN], KeyViolation),
        ([ANN, changed(BOB, employee_id="")], KeyViolation),
        ([changed(ANN, employee_id="one")], PySparkException),
        ([changed(ANN, first_name="x" * 101)], PySparkException),
        ([changed(ANN, salary="3000000000")], PySparkException),
    ],
    ids=["repeated key", "no key", "key not a number", "too long", "too large"],
)
def test_failure_leaves_the_published_state(spark, lake, tmp_path, bad, error):
    run_cycle(lake, write(tmp_path / "1.csv", BOB, CAT), "2025-01-01")
    silver = sorted(lake.table("silver.employees").collect())
    kpi = lake.table("gold.department_kpi").collect()
    with pytest.raises(error):
        run_cycle(lake, write(tmp_path / "2.csv", *bad), "2025-01-02")
    reopened = Lake(spark, lake.root, prefix=lake.prefix)
    assert sorted(reopened.table("silver.employees").collect()) == silver
    assert reopened.table("gold.department_kpi").collect() == kpi
    good = run_cycle(reopened, write(tmp_path / "3.csv", BOB), "2025-01-03")
    assert (good.deleted, good.unchanged) == (1, 1)


def test_missing_snapshot(spark, lake, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_cycle(lake, str(tmp_path / "none.csv"), "2025-01-01")
    assert not lake.exists("bronze.employees")


def test_steps_by_themselves(spark, lake, tmp_path):
    assert cycle.load_bronze(lake, write(tmp_path / "1.csv", ANN, BOB)) == 2
    cycle.refresh_silver(lake, cycle.stage_incoming(lake, "2025-01-01"))
    cycle.load_bronze(lake, write(tmp_path / "2.csv", ANN, CAT))
    incoming = cycle.stage_incoming(lake, "2025-01-02")
    assert spark.table(lake.catalog_name(cycle.STAGING_VIEW)).count() == 2
    changes = {r.employee_id: r.cdc_action for r in cycle.show_changes(lake).collect()}
    assert changes == {1: "NO_CHANGE", 2: "DELETE", 3: "INSERT"}
    counts = cycle.update_silver(lake, incoming, as_of="2025-01-02")
    assert counts == {"INSERT": 1, "UPDATE": 0, "DELETE": 1, "NO_CHANGE": 1}
    assert cycle.load_gold(lake, "2025-01-02") == (1, 2)  # the flagged row is no KPI
    # A refresh takes the rows as they are, without regard to the state.
    cycle.refresh_silver(lake, incoming)
    dates = {r.employee_id: r.joining_date for r in lake.table("silver.employees").collect()}
    assert dates == {1: dt.date(2020, 1, 1), 3: None}


def test_old_versions_are_deleted_on_demand(lake, tmp_path):
    import glob

    path = write(tmp_path / "1.csv", ANN, BOB)
    for day in ("2025-01-01", "2025-01-02", "2025-01-03"):
        run_cycle(lake, path, day, keep=1)
    for table in lake.layouts:
        assert len(glob.glob(f"{lake.root}/{table.replace('.', '/')}/v*")) == 1
    assert lake.table("silver.employees").count() == 2


def test_another_number_of_buckets(spark, tmp_path):
    import glob

    people = [changed(ANN, employee_id=str(i)) for i in range(200)]
    path = write(tmp_path / "1.csv", *people)
    root = str(tmp_path / "lake")
    for day, buckets in (("2025-01-01", 4), ("2025-01-02", 7), ("2025-01-03", 14)):
        lake = Lake(spark, root, prefix="rebucket_", buckets=buckets)
        report = run_cycle(lake, path, day, keep=1)
        assert report.unchanged == (0 if day == "2025-01-01" else 200)
        assert len(glob.glob(f"{root}/silver/employees/v*/*.parquet")) == buckets
        assert lake.table("silver.employees").count() == 200


def test_command_line(spark, tmp_path, capsys):
    from snapfold.__main__ import main

    path = write(tmp_path / "1.csv", ANN, BOB)
    root = str(tmp_path / "lake")
    for day in ("2025-01-01", "2025-01-02"):
        main([path, root, "--as-of", day, "--prefix", "cli_", "--buckets", "3"])
    reports = capsys.readouterr().out.splitlines()
    assert len(reports) == 2 and "initial=True" in reports[0] and "unchanged=2" in reports[1]
    assert spark.table("cli_silver.employees").count() == 2
