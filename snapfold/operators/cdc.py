"""Change data capture between a full snapshot and the last published state.

Everything is read off one full outer join on the key.  With the current state
bucketed by the key, only the incoming rows are shuffled, once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapfold.functions.fingerprint import differs
from snapfold.operators.conform import as_of_column

INSERT, UPDATE, DELETE, NO_CHANGE = "INSERT", "UPDATE", "DELETE", "NO_CHANGE"
ACTION = "cdc_action"


@dataclass(frozen=True)
class ChangeRules:
    """Which columns identify, reveal and take over a change.

    The defaults are fixed values: the columns of the employee tables.

    ``compare``  a difference here (NULL-safe) makes an UPDATE; others go unnoticed.
    ``apply``    taken from the incoming row on UPDATE; all others keep their value.
    ``started``  set to the as-of date on INSERT, whatever the snapshot says.
    ``ended``    as-of date when the status turns to ``left``, NULL when it is
                 ``active``, else kept; NULL on INSERT.
    ``stamped``  set to the as-of date on INSERT and UPDATE.
    """

    key: tuple[str, ...] = ("employee_id",)
    compare: tuple[str, ...] = ("first_name", "last_name", "salary", "department", "status")
    apply: tuple[str, ...] = (
        "first_name",
        "last_name",
        "department",
        "email",
        "phone",
        "address",
        "status_flag",
        "status",
    )
    status: str = "status"
    started: str = "joining_date"
    ended: str = "termination_date"
    stamped: str = "updated_at"
    active: str = "Active"
    left: str = "Terminated"

    def also_applying(self, *columns: str) -> ChangeRules:
        """The same rules with more columns taken over on UPDATE."""
        return replace(self, apply=(*self.apply, *columns))


EMPLOYEES = ChangeRules()


def _new(name: str) -> Column:
    return F.col(f"new__{name}")


def _old(name: str) -> Column:
    return F.col(f"old__{name}")


def _paired(incoming: DataFrame, current: DataFrame, rules: ChangeRules) -> DataFrame:
    """Incoming and current rows side by side, each row of either exactly once."""
    new = incoming.select(*[F.col(c).alias(f"new__{c}") for c in incoming.columns])
    old = current.select(*[F.col(c).alias(f"old__{c}") for c in current.columns])
    same_key = reduce(lambda a, b: a & b, [_new(k) == _old(k) for k in rules.key])
    return new.join(old, same_key, "full_outer")


def _action(rules: ChangeRules) -> Column:
    changed = differs([_new(c) for c in rules.compare], [_old(c) for c in rules.compare])
    return (
        F.when(_old(rules.key[0]).isNull(), INSERT)
        .when(_new(rules.key[0]).isNull(), DELETE)
        .when(changed, UPDATE)
        .otherwise(NO_CHANGE)
    )


def classify(
    incoming: DataFrame, current: DataFrame, rules: ChangeRules = EMPLOYEES
) -> DataFrame:
    """Key, action and the incoming values (NULL on DELETE) of every key on either side."""
    values = [c for c in incoming.columns if c not in (*rules.key, rules.stamped)]
    return _paired(incoming, current, rules).select(
        *[F.coalesce(_new(k), _old(k)).alias(k) for k in rules.key],
        _action(rules).alias(ACTION),
        *[_new(c).alias(c) for c in values],
    )


def only(changes: DataFrame, action: str) -> DataFrame:
    """The changes of one kind."""
    return changes.where(F.col(ACTION) == action)


def action_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy(ACTION).agg(F.count(F.lit(1)).alias("n_rows"))


def count_actions() -> list[Column]:
    """Counters of the actions, for ``DataFrame.observe`` on a pass made anyway."""
    return [F.count_if(F.col(ACTION) == a).alias(a) for a in (INSERT, UPDATE, DELETE, NO_CHANGE)]


def _settled(name: str, action: Column, rules: ChangeRules, today: Column) -> Column:
    """The value of one column after the change."""
    inserted, updated = action == INSERT, action == UPDATE
    if name in rules.key:
        return F.coalesce(_new(name), _old(name))
    if name == rules.stamped:
        return F.when(inserted | updated, today).otherwise(_old(name))
    if name == rules.started:
        on_insert = today
    elif name == rules.ended:
        on_insert = F.lit(None).cast("date")
    else:
        on_insert = _new(name)
    settled = F.when(inserted, on_insert)
    if name in rules.apply:
        settled = settled.when(updated, _new(name))
    elif name == rules.ended:
        status = rules.status
        leaves = (_new(status) == rules.left) & (_old(status) != rules.left)
        settled = settled.when(updated & leaves, today).when(
            updated & (_new(status) == rules.active), F.lit(None).cast("date")
        )
    return settled.otherwise(_old(name))


def settle(
    incoming: DataFrame,
    current: DataFrame,
    rules: ChangeRules = EMPLOYEES,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """The action and the resulting row of every key on either side, in one pass.

    DELETE rows are still there, with their old values.
    """
    today = as_of_column(as_of)
    paired = _paired(incoming, current, rules).withColumn(ACTION, _action(rules))
    return paired.select(
        ACTION,
        *[_settled(c, F.col(ACTION), rules, today).alias(c) for c in current.columns],
    )


def drop_deleted(settled: DataFrame) -> DataFrame:
    """The next state from settled rows."""
    return settled.where(F.col(ACTION) != DELETE).drop(ACTION)


def apply_changes(
    incoming: DataFrame,
    current: DataFrame,
    rules: ChangeRules = EMPLOYEES,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """The next state: inserts, updates and deletes applied in a single pass."""
    return drop_deleted(settle(incoming, current, rules, as_of))


def updated_rows(settled: DataFrame) -> DataFrame:
    """The rows that have an UPDATE, as they are after it, from settled rows."""
    return only(settled, UPDATE).drop(ACTION)


def surviving_rows(
    incoming: DataFrame, current: DataFrame, rules: ChangeRules = EMPLOYEES
) -> DataFrame:
    """The current rows whose key is not to be deleted, as they are, in one pass."""
    paired = _paired(incoming, current, rules)
    both = reduce(
        lambda a, b: a & b, [_old(k).isNotNull() & _new(k).isNotNull() for k in rules.key]
    )
    return paired.where(both).select(*[_old(c).alias(c) for c in current.columns])


def left_over(
    incoming: DataFrame,
    current: DataFrame,
    rules: ChangeRules = EMPLOYEES,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Key and action of what detection finds after the changes were applied, in the same pass."""
    today = as_of_column(as_of)
    paired = _paired(incoming, current, rules).withColumn(ACTION, _action(rules))
    after = [_settled(c, F.col(ACTION), rules, today) for c in rules.compare]
    still = differs([_new(c) for c in rules.compare], after)
    return paired.where(F.col(ACTION) != DELETE).select(
        *[F.coalesce(_new(k), _old(k)).alias(k) for k in rules.key],
        F.when(still, UPDATE).otherwise(NO_CHANGE).alias(ACTION),
    )


def apply_deletes(
    current: DataFrame, changes: DataFrame, rules: ChangeRules = EMPLOYEES
) -> DataFrame:
    """The current rows whose key is not to be deleted."""
    return current.join(only(changes, DELETE).select(*rules.key), list(rules.key), "left_anti")


def apply_updates(
    current: DataFrame,
    changes: DataFrame,
    rules: ChangeRules = EMPLOYEES,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """The current rows that have an UPDATE, as they are after it."""
    today = as_of_column(as_of)
    new = only(changes, UPDATE).select(
        *[F.col(c).alias(f"new__{c}") for c in (*rules.key, *_value_columns(changes, rules))]
    )
    old = current.select(*[F.col(c).alias(f"old__{c}") for c in current.columns])
    same_key = reduce(lambda a, b: a & b, [_new(k) == _old(k) for k in rules.key])
    return old.join(new, same_key, "inner").select(
        *[_settled(c, F.lit(UPDATE), rules, today).alias(c) for c in current.columns]
    )


def _value_columns(changes: DataFrame, rules: ChangeRules) -> list[str]:
    return [c for c in changes.columns if c not in (*rules.key, ACTION)]


def inserted_rows(
    changes: DataFrame,
    columns: list[str],
    rules: ChangeRules = EMPLOYEES,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """The rows to add for the INSERT changes, in the given column order."""
    today = as_of_column(as_of)
    fixed = {
        rules.started: today,
        rules.stamped: today,
        rules.ended: F.lit(None).cast("date"),
    }
    return only(changes, INSERT).select(*[fixed.get(c, F.col(c)).alias(c) for c in columns])
