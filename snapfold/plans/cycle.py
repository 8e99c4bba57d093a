"""One load cycle: snapshot -> bronze -> cleaned -> changes -> silver -> gold."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, functions as F

from snapfold import schemas
from snapfold.operators import cdc, gold
from snapfold.operators.conform import conform_employees
from snapfold.operators.keys import check_key, watched_key
from snapfold.sources.lake import Lake
from snapfold.sources.snapshot import scan_snapshot

logger = logging.getLogger(__name__)

SILVER = "silver.employees"
STAGED = "silver.staged_employees"
STAGING_VIEW = "silver.tmp_employees"
CHANGES_VIEW = "silver.employees_cdc_view"


@dataclass(frozen=True)
class CycleReport:
    """What a cycle did; ``initial`` cycles load the state instead of diffing it."""

    initial: bool
    rows: int
    inserted: int
    updated: int
    deleted: int
    unchanged: int
    departments: int
    years: int


def _type_of(lake: Lake, table: str, column: str) -> str:
    """The declared type of a column of one of the lake's tables."""
    return dict(lake.layouts[table].columns)[column]


def load_bronze(lake: Lake, path: str | list[str]) -> int:
    """Replace the raw table with the snapshot; returns its row count.

    Its staging twin is a view of the same rows without the load timestamp.
    """
    seen = Observation()
    rows, scanned = scan_snapshot(lake.spark, path)
    raw = (
        rows.withColumn(schemas.KEY, F.col(schemas.KEY).cast(_type_of(lake, "bronze.employees", schemas.KEY)))
        .withColumn("ingestion_timestamp", F.current_timestamp())
        .observe(seen, F.count(F.lit(1)).alias("n"))
    )
    lake.publish({"bronze.employees": raw})
    lake.delete_folder(scanned)
    columns = ", ".join(f"`{c}`" for c in schemas.SNAPSHOT_COLUMNS)
    lake.spark.sql(
        f"CREATE OR REPLACE VIEW {lake.catalog_name('bronze.tmp_employees')} AS "
        f"SELECT {columns} FROM {lake.catalog_name('bronze.employees')}"
    )
    return seen.get["n"]


def stage_incoming(
    lake: Lake, as_of: dt.date | str | None = None, key: tuple[str, ...] = (schemas.KEY,)
) -> DataFrame:
    """The cleaned rows of the raw table as a table, dealt and sorted like the state; aborts on bad keys.

    That is the one exchange of the incoming rows.  Equal keys meet in it, so the key is checked on
    the way, before the commit; only where it fails are the keys counted, for the report.
    """
    raw = lake.table("bronze.employees")
    incoming = conform_employees(raw, as_of, _type_of(lake, SILVER, schemas.KEY))
    lake.fit_buckets(SILVER, like="bronze.employees")
    lake.fit_buckets(STAGED, like="bronze.employees")
    dealt, verify = lake.by_key(STAGED, incoming), None
    if key == (schemas.KEY,):
        seen = Observation()
        dealt = watched_key(dealt, seen, *key)

        def verify() -> None:
            if seen.get["bad"]:
                check_key(raw, *key)
    else:
        check_key(incoming, *key)
    lake.publish({STAGED: dealt}, verify)
    _show_staging(lake, "true")
    return lake.table(STAGED)


def _show_staging(lake: Lake, condition: str) -> None:
    lake.spark.sql(
        f"CREATE OR REPLACE VIEW {lake.catalog_name(STAGING_VIEW)} AS "
        f"SELECT * FROM {lake.catalog_name(STAGED)} WHERE {condition}"
    )


def clear_staging(lake: Lake) -> None:
    """Empty the staging view.  The rows stay behind the changes view until the next are staged."""
    _show_staging(lake, "false")


def refresh_silver(lake: Lake, incoming: DataFrame) -> None:
    """Make the cleaned rows the state, whatever it was."""
    lake.fit_buckets(SILVER, like="bronze.employees")
    lake.publish({SILVER: incoming if lake.same_buckets(SILVER, STAGED) else lake.by_key(SILVER, incoming)})


def changes_sql(lake: Lake, rules: cdc.ChangeRules = cdc.EMPLOYEES) -> str:
    """Classification of the staged rows against the state, as SQL over the published names."""
    columns = schemas.names(lake.layouts[STAGED].columns)
    values = [c for c in columns if c not in (*rules.key, rules.stamped)]
    first = rules.key[0]
    same = " AND ".join(f"new.`{k}` = old.`{k}`" for k in rules.key)
    changed = " OR ".join(f"NOT (new.`{c}` <=> old.`{c}`)" for c in rules.compare)
    return (
        f"SELECT {', '.join(f'coalesce(new.`{k}`, old.`{k}`) AS `{k}`' for k in rules.key)}, "
        f"CASE WHEN old.`{first}` IS NULL THEN '{cdc.INSERT}' WHEN new.`{first}` IS NULL THEN '{cdc.DELETE}' "
        f"WHEN {changed} THEN '{cdc.UPDATE}' ELSE '{cdc.NO_CHANGE}' END AS {cdc.ACTION}, "
        f"{', '.join(f'new.`{c}`' for c in values)} "
        f"FROM {lake.catalog_name(STAGED)} AS new FULL OUTER JOIN {lake.catalog_name(SILVER)} AS old ON {same}"
    )


def show_changes(lake: Lake, rules: cdc.ChangeRules = cdc.EMPLOYEES) -> DataFrame:
    """The changes of the published state that the staged rows stand for, as a stored, live view.

    Any session can read it; it follows every publish.  Both sides are bucketed and sorted by the
    key, so it is read without an exchange.  Between cycles it shows what is left to change.
    """
    lake.spark.sql(f"CREATE OR REPLACE VIEW {lake.catalog_name(CHANGES_VIEW)} AS {changes_sql(lake, rules)}")
    return lake.spark.table(lake.catalog_name(CHANGES_VIEW))


def update_silver(
    lake: Lake,
    incoming: DataFrame,
    rules: cdc.ChangeRules = cdc.EMPLOYEES,
    as_of: dt.date | str | None = None,
) -> dict[str, int]:
    """Apply the changes to the published state; returns how many there were of a kind.

    The counts come from the tasks that write the rows, so they need no second pass.
    """
    lake.fit_buckets(SILVER, like="bronze.employees")
    counts = Observation()
    settled = cdc.settle(incoming, lake.table(SILVER), rules, as_of)
    if not lake.keeps_buckets(SILVER):
        # Someone set another number of buckets: shuffle, or each task writes to all.
        # Counted behind the shuffle, where no task runs again for a lost map output.
        settled = lake.by_key(SILVER, settled)
    settled = settled.observe(counts, *cdc.count_actions())
    lake.publish({SILVER: cdc.drop_deleted(settled)})
    return counts.get


def load_gold(lake: Lake, as_of: dt.date | str | None = None) -> tuple[int, int]:
    """Replace both aggregate tables in one commit, from one scan of the state."""
    columns = replace(
        gold.EMPLOYEES,
        count_type=_type_of(lake, "gold.department_kpi", "total_employees"),
        total_type=_type_of(lake, "gold.department_kpi", "total_salary_cost"),
    )
    # One row per department, year and flag.
    tallies = gold.shared_tally(lake.table(SILVER), as_of, columns).persist()
    try:
        kpi, trends = gold.gold_tables(tallies, as_of, columns)
        seen_kpi, seen_trends = Observation(), Observation()
        count = F.count(F.lit(1)).alias("n")
        lake.publish(
            {
                "gold.department_kpi": kpi.observe(seen_kpi, count),
                "gold.hiring_trends": trends.observe(seen_trends, count),
            }
        )
        return seen_kpi.get["n"], seen_trends.get["n"]
    finally:
        tallies.unpersist()


def run_cycle(
    lake: Lake,
    path: str | list[str],
    as_of: dt.date | str | None = None,
    rules: cdc.ChangeRules = cdc.EMPLOYEES,
    keep: int | None = None,
) -> CycleReport:
    """Take in one full snapshot and bring every table up to date.

    ``as_of`` is the one "today" of the cycle.  A failure leaves the tables as the
    last commit left them and is raised; running the same cycle again is safe.
    With ``keep``, all but the last so many versions of the tables are deleted.
    """
    as_of = as_of or lake.spark.sql("SELECT current_date()").first()[0]
    logger.info("cycle started: %s as of %s", path, as_of)
    try:
        rows = load_bronze(lake, path)
        logger.info("bronze: %d rows", rows)

        incoming = stage_incoming(lake, as_of, rules.key)
        initial = not lake.exists(SILVER)
        counts = {}
        if initial:
            refresh_silver(lake, incoming)
            show_changes(lake, rules)
        else:
            show_changes(lake, rules)
            counts = update_silver(lake, incoming, rules, as_of)
        clear_staging(lake)
        logger.info("silver: %s", "initial load" if initial else counts)

        departments, years = load_gold(lake, as_of)
        logger.info("gold: %d departments, %d years", departments, years)
        if keep:
            logger.info("%d old folders deleted", lake.expire(keep))
    except Exception:
        logger.exception("cycle failed: %s as of %s", path, as_of)
        raise
    logger.info("cycle completed: %s as of %s", path, as_of)
    return CycleReport(
        initial=initial,
        rows=rows,
        inserted=counts.get(cdc.INSERT, 0),
        updated=counts.get(cdc.UPDATE, 0),
        deleted=counts.get(cdc.DELETE, 0),
        unchanged=counts.get(cdc.NO_CHANGE, 0),
        departments=departments,
        years=years,
    )
