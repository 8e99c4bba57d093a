"""Gold tables kept up to date from changes alone.

``ledger`` reduces rows to signed, additive tallies per (year, group, flag).  A change takes the
contribution of the old row back (``SIGN`` -1) and adds that of the new one (+1), so stored ledgers are
brought up to date by adding the ledger of the changes: neither the state nor its unchanged rows are read.
Both tables, with the mode and the exact means, are read off a ledger as of any day.

What depends on the day is kept apart: of rows whose time goes on, the sum of their start days is stored,
and turned into days when the tables are made.  A sum over nothing is told from a sum of zero by its count.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapfold.operators import cdc, gold
from snapfold.operators.conform import as_of_column

SIGN = "__sign"
SUMS = ("n", "n_active", "paid", "n_paid", "cost", "n_cost", "ended_days", "n_ended", "started", "n_going")
DAY_ZERO = "1970-01-01"


def _contributions(c: gold.KpiColumns) -> dict[str, Column]:
    """What one row adds to each sum; never NULL."""
    amount, started, ended = F.col(c.amount), F.col(c.started), F.col(c.ended)
    gone = F.coalesce((F.col(c.status) == c.left) & ended.isNotNull(), F.lit(False)) & started.isNotNull()
    going = started.isNotNull() & ~gone
    cost = gold.active_cost(c)

    def one(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("long")

    def value(x: Column, condition: Column | None = None) -> Column:
        kept = x if condition is None else F.when(condition, x)
        return F.coalesce(kept.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))

    return {
        "n": F.lit(1).cast("long"),
        "n_active": one(gold.is_active(c)),
        "paid": value(amount),
        "n_paid": one(amount.isNotNull()),
        "cost": value(cost),
        "n_cost": one(cost.isNotNull()),
        "ended_days": value(F.datediff(ended, started), gone),
        "n_ended": one(gone),
        "started": value(F.datediff(started, F.lit(DAY_ZERO).cast("date")), going),
        "n_going": one(going),
    }


def ledger(rows: DataFrame, c: gold.KpiColumns = gold.EMPLOYEES) -> DataFrame:
    """Signed sums per (year, group, flag); rows without a column SIGN count once."""
    sign = F.col(SIGN) if SIGN in rows.columns else F.lit(1)
    keyed = rows.select(
        gold.hiring_year(c).alias(gold.YEAR), F.col(c.group), F.col(c.flag),
        *[(x * sign).alias(name) for name, x in _contributions(c).items()],
    )
    return _added(keyed, c)


def _added(entries: DataFrame, c: gold.KpiColumns) -> DataFrame:
    types = dict(entries.dtypes)
    wide = {name: "long" if types[name] == "bigint" else "decimal(38,0)" for name in SUMS}
    return entries.groupBy(gold.YEAR, c.group, c.flag).agg(*[F.sum(name).cast(wide[name]).alias(name) for name in SUMS])


def advance(stored: DataFrame, moved: DataFrame, c: gold.KpiColumns = gold.EMPLOYEES) -> DataFrame:
    """The stored ledger brought up to date; groups that no row is left in go."""
    return _added(stored.select(*moved.columns).unionByName(moved), c).where("n <> 0")


def movements(
    incoming: DataFrame,
    current: DataFrame,
    rules: cdc.ChangeRules = cdc.EMPLOYEES,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """The columns of ``current`` and SIGN: of every changed key the old row, taken back, and the new one."""
    today = as_of_column(as_of)
    paired = cdc._paired(incoming, current, rules).withColumn(cdc.ACTION, cdc._action(rules))
    action = F.col(cdc.ACTION)

    def row(values: list[Column], sign: int) -> Column:
        typed = zip(values, current.schema, strict=True)
        fields = [x.cast(f.dataType).alias(f.name) for x, f in typed]
        return F.struct(*fields, F.lit(sign).alias(SIGN))

    old = row([F.col(f"old__{c}") for c in current.columns], -1)
    new = row([cdc._settled(c, action, rules, today) for c in current.columns], 1)
    moved = (
        F.when(action == cdc.INSERT, F.array(new))
        .when(action == cdc.DELETE, F.array(old))
        .when(action == cdc.UPDATE, F.array(old, new))
    )
    return paired.where(action != cdc.NO_CHANGE).select(F.inline(moved))


def tallies(stored: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """A ledger as the tallies that ``gold.gold_tables`` reads, on a day."""
    today = F.datediff(as_of_column(as_of), F.lit(DAY_ZERO).cast("date"))
    keys = [c for c in stored.columns if c not in SUMS]
    return stored.select(
        *keys,
        "n",
        "n_active",
        F.when(F.col("n_paid") > 0, F.col("paid")).cast("decimal(30,0)").alias("paid"),
        "n_paid",
        F.when(F.col("n_cost") > 0, F.col("cost")).cast("decimal(30,0)").alias("cost"),
        (F.col("ended_days") + F.col("n_going") * today - F.col("started")).cast("bigint").alias("days"),
        (F.col("n_ended") + F.col("n_going")).alias("n_days"),
    )


def gold_tables(stored: DataFrame, as_of: dt.date | str | None = None, c: gold.KpiColumns = gold.EMPLOYEES):
    """(department_kpi, hiring_trends) on a day, from a ledger."""
    return gold.gold_tables(tallies(stored, as_of), as_of, c)


def total(ledgers: list[DataFrame], c: gold.KpiColumns = gold.EMPLOYEES) -> DataFrame:
    """One ledger from several, as of parts of a state."""
    return _added(reduce(DataFrame.unionByName, ledgers), c).where("n <> 0")
