"""Aggregate tables: golden values, rounding, ties, NULLs, ordering."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from snapfold.functions.numeric import rounded_mean
from snapfold.operators import gold
from snapfold.operators.conform import conform_employees, normalise_nulls
from snapfold.schemas import SNAPSHOT_COLUMNS

from tests.golden import AS_OF, KPI, PEOPLE, TRENDS

SCHEMA = (
    "department string, status string, salary int, joining_date date, "
    "termination_date date, status_flag boolean"
)


@pytest.fixture(scope="module")
def people(spark):
    raw = spark.createDataFrame(PEOPLE, ", ".join(f"{c} string" for c in SNAPSHOT_COLUMNS))
    return conform_employees(normalise_nulls(raw), AS_OF)


def test_golden_tables(people):
    kpi = gold.department_kpi(people, AS_OF, gold.EMPLOYEES)
    trends = gold.hiring_trends(people, AS_OF, gold.EMPLOYEES)
    assert [tuple(r) for r in kpi.collect()] == KPI
    assert [tuple(r) for r in trends.collect()] == TRENDS
    assert dict(kpi.dtypes) == {
        "department": "string",
        "total_employees": "int",
        "active_employees": "int",
        "avg_salary": "decimal(10,2)",
        "total_salary_cost": "int",
        "avg_tenure_days": "int",
        "last_updated": "date",
    }
    assert dict(trends.dtypes) == {
        "hiring_year": "int",
        "total_hires": "int",
        "avg_starting_salary": "decimal(10,2)",
        "most_hired_dept": "string",
        "last_updated": "date",
    }


def test_shared_tally_gives_the_same_tables(people):
    kpi, trends = gold.gold_tables(gold.shared_tally(people, AS_OF), AS_OF, gold.KpiColumns())
    assert [tuple(r) for r in kpi.collect()] == KPI
    assert [tuple(r) for r in trends.collect()] == TRENDS
    # Unless the tables say otherwise, counts and totals are wide.
    assert dict(kpi.dtypes)["total_employees"] == dict(trends.dtypes)["total_hires"] == "bigint"
    assert dict(kpi.dtypes)["total_salary_cost"] == "bigint"


D = dt.date
TODAY = "2026-01-13"


def test_null_groups_flags_and_amounts(spark):
    rows = [
        (None, "Active", 10, D(2020, 1, 1), None, False),
        ("a", "Active", None, D(2020, 1, 1), None, False),
        ("b", "Leave", None, None, None, False),
        ("c", "Active", 5, D(2026, 1, 3), None, None),
        ("d", "Active", 5, D(2026, 1, 3), None, True),
        ("e", "Terminated", 7, D(2026, 1, 1), D(2026, 1, 2), False),
        ("e", "Terminated", 8, D(2026, 1, 1), None, False),
    ]
    kpi = gold.department_kpi(spark.createDataFrame(rows, SCHEMA), TODAY).collect()
    got = {r.department: tuple(r)[1:-1] for r in kpi}
    long_since = (D.fromisoformat(TODAY) - D(2020, 1, 1)).days
    assert got == {
        None: (1, 1, Decimal("10.00"), 10, long_since),
        "a": (1, 1, None, None, long_since),
        "b": (1, 0, None, 0, None),
        "e": (2, 0, Decimal("7.50"), 0, 7),  # (1 + 12) / 2 = 6.5 -> 7
    }
    # NULL totals come first, then the highest.
    assert [r.total_salary_cost for r in kpi] == [None, 10, 0, 0]


def test_mode_ties_and_missing_groups(spark):
    rows = [
        ("b", "x", 1, D(2020, 1, 1), None, False),
        ("a", "x", 1, D(2020, 2, 1), None, False),
        (None, "x", 1, D(2020, 2, 1), None, False),
        (None, "x", 1, D(2020, 2, 1), None, False),
        (None, "x", 1, D(2021, 2, 1), None, False),
        ("z", "x", 2, None, None, True),
    ]
    trends = gold.hiring_trends(spark.createDataFrame(rows, SCHEMA), TODAY).collect()
    assert [(r.hiring_year, r.total_hires, r.most_hired_dept) for r in trends] == [
        (2021, 1, None),
        (2020, 4, "a"),
        (-1, 1, "z"),
    ]


def test_cost_total_is_bounded_by_its_type(spark):
    rows = [("a", "Active", 2_000_000_000, D(2020, 1, 1), None, False)] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(PySparkException):
        gold.department_kpi(df, TODAY, gold.EMPLOYEES).collect()
    row = gold.department_kpi(df.limit(1).union(df.limit(1)), TODAY, gold.KpiColumns())
    assert row.select("total_salary_cost").first()[0] == 4_000_000_000


@settings(
    max_examples=5,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**7)), min_size=50, max_size=100
    )
)
def test_mean_rounds_once_half_away_from_zero(spark, pairs):
    df = spark.createDataFrame(
        [(i, t, n) for i, (t, n) in enumerate(pairs)], "i int, t bigint, n bigint"
    )
    total = F.col("t").cast("decimal(20,0)")
    got = df.select("i", rounded_mean(total, F.col("n"), 2).alias("m")).orderBy("i").collect()
    import decimal

    with decimal.localcontext(prec=60):
        want = [
            (Decimal(t) / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for t, n in pairs
        ]
    assert [r.m for r in got] == want


def test_mean_of_nothing_is_null(spark):
    df = spark.range(1).select(rounded_mean(F.lit(None).cast("bigint"), F.lit(0)).alias("m"))
    assert df.first().m is None
