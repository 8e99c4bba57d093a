"""Gold kept up to date from changes, against gold computed from the whole state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapfold import schemas
from snapfold.operators import cdc, gold, running

STATE = schemas.ddl(schemas.SILVER_EMPLOYEES).replace("VARCHAR(100)", "STRING").replace("VARCHAR(200)", "STRING").replace("VARCHAR(20)", "STRING").replace("VARCHAR(15)", "STRING")


def people(draw, n):
    """A snapshot with nulls in every column that counts."""
    def day():
        return draw.choice([None, dt.date(2020 + draw.randint(0, 4), draw.randint(1, 12), draw.randint(1, 28))])

    return [
        (i, draw.choice(["a", "b", None]), "x", draw.choice(["Ops", "HR", None, ""]), None, None,
         draw.choice(["Active", "Terminated", "Leave", None]), draw.choice([None, 0, 100, 250]), day(), day(),
         draw.choice([True, False, False, None]), None, dt.date(2025, 1, 1))
        for i in draw.sample(range(60), n)
    ]


def shown(tables):
    return [sorted(map(tuple, t.collect()), key=repr) for t in tables]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_changes_equal_the_full_recomputation(spark, tmp_path, seed):
    draw = random.Random(seed)
    state = spark.createDataFrame(people(draw, 40), STATE)
    stored = running.ledger(state)
    rules = draw.choice([cdc.EMPLOYEES, cdc.EMPLOYEES.also_applying("salary")])
    for step, n in enumerate([35, 0, 30, 50]):
        as_of = f"2025-02-0{step + 1}"
        incoming = spark.createDataFrame(people(draw, n), STATE)
        moved = running.ledger(running.movements(incoming, state, rules, as_of))
        folder = str(tmp_path / f"{step}")
        running.advance(stored, moved).write.parquet(folder + "l")
        cdc.apply_changes(incoming, state, rules, as_of).write.parquet(folder + "s")
        stored, state = spark.read.parquet(folder + "l"), spark.read.parquet(folder + "s")
        assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, running.ledger(state).collect()), key=repr)
        for day in (as_of, "2026-07-01"):
            full = gold.department_kpi(state, day), gold.hiring_trends(state, day)
            assert shown(running.gold_tables(stored, day)) == shown(full)


def test_ledgers_of_parts_add_up(spark):
    state = spark.createDataFrame(people(random.Random(5), 50), STATE)
    parts = [running.ledger(state.where(F.col("employee_id") % 3 == i)) for i in range(3)]
    whole = running.ledger(state)
    assert sorted(map(tuple, running.total(parts).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_only_changed_rows_count(spark):
    state = spark.createDataFrame(people(random.Random(6), 50), STATE)
    assert running.movements(state, state, as_of="2025-02-01").count() == 0
