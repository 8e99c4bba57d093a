"""The two aggregate tables, built from additive parts.

``tally`` reduces the rows to counts and sums per group with map-side partials,
so a group that holds a third of all rows costs one row per task.  Both tables
are then read off the (few) tally rows, and can share one scan of the state.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from snapfold.functions.numeric import rounded_mean
from snapfold.operators.conform import as_of_column


@dataclass(frozen=True)
class KpiColumns:
    """Which columns to group and measure; the types bound head counts and the cost total."""

    group: str = "department"
    status: str = "status"
    amount: str = "salary"
    started: str = "joining_date"
    ended: str = "termination_date"
    flag: str = "status_flag"
    active: str = "Active"
    left: str = "Terminated"
    count_type: str = "bigint"
    total_type: str = "bigint"


# The employee tables declare INT; larger values abort.
EMPLOYEES = KpiColumns(count_type="int", total_type="int")

YEAR = "hiring_year"


def is_active(c: KpiColumns = EMPLOYEES) -> Column:
    return F.col(c.status) == c.active


def unflagged(df: DataFrame, c: KpiColumns = EMPLOYEES) -> DataFrame:
    """Rows whose flag is FALSE; a NULL flag does not pass."""
    return df.where(~F.col(c.flag))


def hiring_year(c: KpiColumns = EMPLOYEES) -> Column:
    return F.coalesce(F.year(F.col(c.started)), F.lit(-1))


def tenure_days(as_of: dt.date | str | None, c: KpiColumns = EMPLOYEES) -> Column:
    """Days from start to end for those who left with a date, else to the as-of date."""
    gone = (F.col(c.status) == c.left) & F.col(c.ended).isNotNull()
    until = F.when(gone, F.col(c.ended)).otherwise(as_of_column(as_of))
    return F.datediff(until, F.col(c.started))


def active_cost(c: KpiColumns = EMPLOYEES) -> Column:
    return F.when(is_active(c), F.col(c.amount)).otherwise(0)


def _measures(as_of: dt.date | str | None, c: KpiColumns) -> dict[str, Column]:
    days = tenure_days(as_of, c)
    return {
        "n": F.count(F.lit(1)),
        "n_active": F.count_if(is_active(c)),
        "paid": F.sum(F.col(c.amount).cast("decimal(20,0)")),
        "n_paid": F.count(F.col(c.amount)),
        "cost": F.sum(active_cost(c)),
        "days": F.sum(days.cast("bigint")),
        "n_days": F.count(days),
    }


def tally(
    df: DataFrame,
    groups: dict[str, Column],
    as_of: dt.date | str | None = None,
    c: KpiColumns = EMPLOYEES,
) -> DataFrame:
    """Counts and sums per group; sums of tallies are tallies."""
    grouped = df.groupBy(*[column.alias(name) for name, column in groups.items()])
    return grouped.agg(*[m.alias(name) for name, m in _measures(as_of, c).items()])


def kpi_from_tally(
    tallies: DataFrame, as_of: dt.date | str | None = None, c: KpiColumns = EMPLOYEES
) -> DataFrame:
    s = {name: F.sum(name) for name in ("n", "n_active", "paid", "n_paid", "cost", "days", "n_days")}
    return (
        tallies.groupBy(c.group)
        .agg(
            s["n"].cast(c.count_type).alias("total_employees"),
            s["n_active"].cast(c.count_type).alias("active_employees"),
            rounded_mean(s["paid"], s["n_paid"], 2).cast("decimal(10,2)").alias("avg_salary"),
            s["cost"].cast(c.total_type).alias("total_salary_cost"),
            rounded_mean(s["days"], s["n_days"]).cast("int").alias("avg_tenure_days"),
        )
        .withColumn("last_updated", as_of_column(as_of))
        .orderBy(F.desc_nulls_first("total_salary_cost"))
    )


def trends_from_tally(
    tallies: DataFrame, as_of: dt.date | str | None = None, c: KpiColumns = EMPLOYEES
) -> DataFrame:
    """Tallies per year and group -> one row per year with its most frequent group.

    Ties go to the group that sorts first; rows without a group do not compete.
    """
    per_group = tallies.groupBy(YEAR, c.group).agg(
        F.sum("n").alias("n"), F.sum("paid").alias("paid"), F.sum("n_paid").alias("n_paid")
    )
    rank = F.when(F.col(c.group).isNotNull(), F.struct(-F.col("n"), F.col(c.group)))
    return (
        per_group.groupBy(YEAR)
        .agg(
            F.sum("n").cast(c.count_type).alias("total_hires"),
            rounded_mean(F.sum("paid"), F.sum("n_paid"), 2)
            .cast("decimal(10,2)")
            .alias("avg_starting_salary"),
            F.min(rank)[c.group].alias("most_hired_dept"),
        )
        .withColumn("last_updated", as_of_column(as_of))
        .orderBy(F.desc(YEAR))
    )


def department_kpi(
    df: DataFrame, as_of: dt.date | str | None = None, c: KpiColumns = EMPLOYEES
) -> DataFrame:
    """Head counts, mean pay, active cost and mean tenure per group, unflagged rows only."""
    return kpi_from_tally(tally(unflagged(df, c), {c.group: F.col(c.group)}, as_of, c), as_of, c)


def hiring_trends(
    df: DataFrame, as_of: dt.date | str | None = None, c: KpiColumns = EMPLOYEES
) -> DataFrame:
    """Intake, mean pay and most frequent group per start year (-1: no start date)."""
    groups = {YEAR: hiring_year(c), c.group: F.col(c.group)}
    return trends_from_tally(tally(df, groups, as_of, c), as_of, c)


def shared_tally(
    df: DataFrame, as_of: dt.date | str | None = None, c: KpiColumns = EMPLOYEES
) -> DataFrame:
    """Tallies fine enough for both tables, from one scan."""
    groups = {YEAR: hiring_year(c), c.group: F.col(c.group), c.flag: F.col(c.flag)}
    return tally(df, groups, as_of, c)


def gold_tables(
    tallies: DataFrame, as_of: dt.date | str | None = None, c: KpiColumns = EMPLOYEES
) -> tuple[DataFrame, DataFrame]:
    """(department_kpi, hiring_trends) from shared tallies."""
    return (
        kpi_from_tally(unflagged(tallies, c), as_of, c),
        trends_from_tally(tallies, as_of, c),
    )
