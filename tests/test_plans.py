"""What the physical plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from snapfold.operators import cdc, gold
from snapfold.operators.conform import conform_employees
from snapfold.operators.keys import key_violations
from snapfold.plans import inputs
from snapfold.sources.snapshot import BLOCK_SPLITS, join_fragments, read_snapshot, start_states

from tests.test_lake import STATE
from tests.test_snapshot import nasty_records, write


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def state(spark, lake, sf_dir):
    rows = inputs.order_state(spark, sf_dir, inputs.EARLIER)
    lake.publish({STATE: lake.by_key(STATE, rows)})
    return lake.table(STATE)


def test_kpi_reads_few_columns_and_pushes_the_flag_down(spark, state):
    plan = formatted(spark, gold.department_kpi(state, inputs.EARLIER))
    (columns,) = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert {c.split(":")[0] for c in columns.split(",")} == {
        "department",
        "status",
        "salary",
        "joining_date",
        "termination_date",
        "status_flag",
    }
    assert "Not(EqualTo(status_flag,true))" in plan, re.findall(r"PushedFilters.*", plan)


def test_trends_read_three_columns(spark, state):
    plan = formatted(spark, gold.hiring_trends(state, inputs.EARLIER))
    (columns,) = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert {c.split(":")[0] for c in columns.split(",")} == {"department", "salary", "joining_date"}


def test_groups_are_reduced_before_the_shuffle(state):
    for df in (
        gold.shared_tally(state, inputs.EARLIER),
        key_violations(state, "employee_id"),
        cdc.action_counts(state.withColumn(cdc.ACTION, F.col("status"))),
    ):
        lines = [line for line in physical(df).split("\n") if "Aggregate" in line or "Exchange" in line]
        assert [re.search(r"HashAggregate|Exchange", line).group() for line in lines] in (
            ["HashAggregate", "Exchange", "HashAggregate"],
            # On the bucketing key even the shuffle is not needed.
            ["HashAggregate", "HashAggregate"],
        )
        assert "partial_" in physical(df)


def test_state_is_neither_shuffled_nor_sorted_for_the_join(spark, state, sf_dir):
    incoming = inputs.order_state(spark, sf_dir, inputs.LATER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame(incoming.limit(50).collect(), incoming.schema)
        plan = physical(cdc.apply_changes(rows, state, as_of=inputs.LATER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin") :]
    assert "FullOuter" in join
    assert join.count("Exchange") == 1 and join.count("Sort [") == 1
    assert join.index("Exchange") < join.index("FileScan")


def test_cleaning_is_one_code_generated_stage_without_python(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    inputs.raw_roster(spark, sf_dir).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cleaned = conform_employees(spark.read.parquet(path), inputs.GOLD_AS_OF)
        plan = spark._jvm.PythonSQLUtils.explainString(cleaned._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Found 1 WholeStageCodegen subtrees" in plan
    (size,) = map(int, re.findall(r"maxMethodCodeSize:(\d+)", plan))
    # HotSpot does not compile larger methods.
    assert size < 8000
    assert "Python" not in plan and "Exchange" not in plan


def test_text_is_scanned_once_and_whole_records_are_not_shuffled(spark, tmp_path, monkeypatch):
    import csv

    path = write(tmp_path / "a.csv", nasty_records(50, 6), quoting=csv.QUOTE_ALL)
    plans = []
    assemble = DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, *a: plans.append(physical(df)) or assemble(df, *a))
    plan = physical(read_snapshot(spark, path))
    # One pass of Python over the lines, below which nothing is joined or shuffled.
    assert len(plans) == 1 and plans[0].count("FileScan text") == 1 and "Exchange" not in plans[0]
    # The result reads what that pass wrote: whole records without an exchange, fragments apart.
    assert "FileScan text" not in plan and "MapInArrow" not in plan
    whole = plan[plan.index("Union") :]
    assert "Exchange" not in whole[: whole.index("FileScan parquet")]


def test_no_task_sees_all_splits_of_a_file(spark):
    import random

    draw = random.Random(4)
    quotes = [draw.choice([0, 1, 2, 7]) for _ in range(10_000)]
    quotes[-1] += sum(quotes) % 2
    rows = [("a", 100 * i, q, 3, 0) for i, q in enumerate(quotes)] + [("b", 0, 2, 1, 1)]
    splits = spark.createDataFrame(rows, "file string, start long, quotes long, made int, sent int")
    states = start_states(splits, 100 * BLOCK_SPLITS)
    odd, want = 0, []
    for q in quotes:
        want.append(odd % 2 == 1)
        odd += q
    assert [r.inside for r in states.where("file = 'a'").orderBy("start").collect()] == want
    plan = physical(states)
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert len(windows) >= 3
    # What runs over a whole file sees its blocks only, below which the splits are added up.
    for line in plan.split("\n"):
        if "Exchange" in line and "hashpartitioning(file" in line and "block" not in line:
            below = plan[plan.index(line) :]
            assert below.index("HashAggregate") < below.index("Scan")


def test_fragments_find_their_records_over_blocks(spark):
    rows = []
    # A record begins in every seventh split; those between lie inside it.
    for i in range(7, 700):
        rows.append(("a", 10 * i, True, False, f"<{i}"))
        if i % 7 == 0:
            rows.append(("a", 10 * i, False, False, f">{i}"))
    rows = [r for r in rows if r[1] > 70 or not r[2]]
    fragments = spark.createDataFrame(rows, "file string, start long, head boolean, is_header boolean, fragment string")
    found = sorted(r.text for r in join_fragments(fragments, 30).collect())
    want = sorted("\n".join([f">{i}", *(f"<{j}" for j in range(i + 1, min(i + 8, 700)))]) for i in range(7, 700, 7))
    assert found == want
