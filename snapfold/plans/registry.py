"""The registered queries: every operator on whole test tables.

Dates are shown as ISO text and decimals as doubles, so that results compare
byte for byte with those of another engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapfold.functions import cleaning
from snapfold.functions.fingerprint import row_fingerprint, row_text
from snapfold.functions.numeric import rounded_mean
from snapfold.operators import cdc, gold, keys, running
from snapfold.operators.conform import conform_employees, normalise_nulls
from snapfold.plans import inputs
from snapfold.plans.cycle import load_bronze, refresh_silver, run_cycle, stage_incoming
from snapfold.schemas import SNAPSHOT_COLUMNS
from snapfold.session import configure, scratch_dir
from snapfold.sources.lake import LAYOUTS, WIDE_LAYOUTS, WIDE_TOTAL_LAYOUTS, Lake, Layout
from snapfold.sources.snapshot import read_snapshot

Query = Callable[[SparkSession, str], DataFrame]

# Order cost totals outgrow INT.
ORDER_KPI = gold.KpiColumns(count_type="int", total_type="bigint")


def shown(df: DataFrame) -> DataFrame:
    def show(name: str, sql_type: str):
        if sql_type == "date":
            return F.col(name).cast("string").alias(name)
        if sql_type.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return df.select(*[show(name, sql_type) for name, sql_type in df.dtypes])


# -- sources ---------------------------------------------------------------------


def write_snapshot(rows: DataFrame, path: str) -> str:
    """Snapshot rows as a folder of CSV part files."""
    rows.write.mode("overwrite").csv(
        path,
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def _roster_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    return write_snapshot(inputs.raw_roster(spark, sf_dir), scratch_dir(spark, name))


def small_splits(spark: SparkSession) -> SparkSession:
    """A session that cuts files every 256 KB."""
    session = configure(spark.newSession())
    session.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    return session


def _more_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The same files with a column ahead that the snapshot does not have."""
    rows = inputs.raw_roster(spark, sf_dir).select(F.lit("more").alias("extra"), "*")
    return write_snapshot(rows, scratch_dir(spark, name))


# The scans: how their files are written, and how they are read.
SCANS = {
    "csv_snapshot": (_roster_files, read_snapshot),
    "csv_snapshot_in_splits": (_more_files, lambda spark, path: read_snapshot(small_splits(spark), path)),
}


def csv_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    write, read = SCANS["csv_snapshot"]
    return read(spark, write(spark, sf_dir, "csv_snapshot"))


def csv_snapshot_in_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files cut anywhere."""
    write, read = SCANS["csv_snapshot_in_splits"]
    return read(spark, write(spark, sf_dir, "csv_snapshot_in_splits"))


def bronze_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published raw table, through its staging view."""
    path = _roster_files(spark, sf_dir, "bronze_staging_files")
    lake = new_lake(spark, "bronze_staging")
    load_bronze(lake, path)
    return spark.table(lake.catalog_name("bronze.tmp_employees"))


def na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_nulls(inputs.raw_roster(spark, sf_dir))


# -- cleaning --------------------------------------------------------------------


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_roster(spark, sf_dir).select(
        "employee_id",
        cleaning.clean_names(F.col("first_name")).alias("first_name"),
        cleaning.clean_names(F.col("last_name")).alias("last_name"),
    )


def clean_names_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select("doc_id", cleaning.clean_names(F.col("text")).alias("title"))


def clean_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_roster(spark, sf_dir).select(
        "employee_id", cleaning.clean_email(F.col("email")).alias("email")
    )


def clean_email_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id", cleaning.clean_email(host).alias("email")
    )


def clean_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_roster(spark, sf_dir).select(
        "employee_id", cleaning.clean_phone(F.col("phone")).alias("phone")
    )


def clean_phone_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select("doc_id", cleaning.clean_phone(F.col("text")).alias("phone"))


def clean_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_roster(spark, sf_dir).select(
        "employee_id", cleaning.clean_salary(F.col("salary")).alias("salary")
    )


def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end, flag = cleaning.clean_employment_dates(
        F.col("status"), F.col("joining_date"), F.col("termination_date")
    )
    return shown(
        inputs.raw_roster(spark, sf_dir).select(
            "employee_id",
            start.alias("joining_date"),
            end.alias("termination_date"),
            flag.alias("status_flag"),
        )
    )


def clean_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_roster(spark, sf_dir).select(
        "employee_id", cleaning.clean_address(F.col("address")).alias("address")
    )


def clean_address_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select("doc_id", cleaning.clean_address(F.col("text")).alias("address"))


def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(conform_employees(inputs.raw_roster(spark, sf_dir), inputs.GOLD_AS_OF))


# -- keys and changes ------------------------------------------------------------


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = inputs.table(spark, sf_dir, "lineitem")
    return keys.key_violations(lineitem, "l_orderkey", "l_linenumber")


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(incoming, current)"""
    return (
        inputs.order_state(spark, sf_dir, inputs.LATER),
        inputs.order_state(spark, sf_dir, inputs.EARLIER),
    )


def cdc_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(cdc.classify(*_pair(spark, sf_dir)))


def cdc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.action_counts(cdc.classify(*_pair(spark, sf_dir)))


def cdc_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the rows of both days, which hold every order between them."""
    incoming, current = (
        rows.withColumn("day", F.lit(day)) for rows, day in zip(_pair(spark, sf_dir), (inputs.LATER, inputs.EARLIER), strict=True)
    )
    compared = [F.col(c) for c in cdc.EMPLOYEES.compare]
    return incoming.unionByName(current).select(
        "day",
        "employee_id",
        row_text(*compared).alias("row_text"),
        row_fingerprint(*compared).alias("fingerprint"),
    )


def cdc_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, current = _pair(spark, sf_dir)
    changes = cdc.classify(incoming, current)
    return shown(cdc.inserted_rows(changes, current.columns, as_of=inputs.LATER))


def cdc_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(cdc.updated_rows(cdc.settle(*_pair(spark, sf_dir), as_of=inputs.LATER)))


def cdc_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(cdc.surviving_rows(*_pair(spark, sf_dir)))


def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(cdc.apply_changes(*_pair(spark, sf_dir), as_of=inputs.LATER))


def cdc_apply_converging(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = cdc.EMPLOYEES.also_applying("salary")
    return shown(cdc.apply_changes(*_pair(spark, sf_dir), rules, inputs.LATER))


def cdc_redetect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.left_over(*_pair(spark, sf_dir), as_of=inputs.LATER)


# -- aggregates ------------------------------------------------------------------


def _unflagged_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.unflagged(inputs.order_lifecycle(spark, sf_dir))
    return gold.tally(rows, {"department": F.col("department")}, inputs.GOLD_AS_OF)


def cond_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unflagged_tally(spark, sf_dir).select(
        "department", F.col("n").alias("total_employees"), F.col("n_active").alias("active_employees")
    )


def cond_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unflagged_tally(spark, sf_dir).select("department", F.col("cost").alias("total_salary_cost"))


def avg_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    tallies = gold.tally(
        inputs.order_lifecycle(spark, sf_dir), {"status": F.col("status")}, inputs.GOLD_AS_OF
    )
    mean = rounded_mean(F.col("paid"), F.col("n_paid"), 2)
    return shown(tallies.select("status", mean.alias("avg_salary")))


def avg_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = rounded_mean(F.col("days"), F.col("n_days")).cast("int")
    return _unflagged_tally(spark, sf_dir).select("department", mean.alias("avg_tenure_days"))


def mode_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    trends = gold.hiring_trends(inputs.order_lifecycle(spark, sf_dir), inputs.GOLD_AS_OF)
    return trends.select("hiring_year", "most_hired_dept")


def department_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.order_lifecycle(spark, sf_dir)
    return shown(gold.department_kpi(rows, inputs.GOLD_AS_OF, ORDER_KPI))


def hiring_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.order_lifecycle(spark, sf_dir)
    return shown(gold.hiring_trends(rows, inputs.GOLD_AS_OF, ORDER_KPI))


def _declared_total(kpi: DataFrame) -> DataFrame:
    """Stored KPI rows with their cost total as INT, as declared; as BIGINT where one outgrows that."""
    total = F.col("total_salary_cost")
    (fits,) = kpi.agg(F.bool_and(total.between(-(2**31), 2**31 - 1))).first()
    return kpi if fits is False else kpi.withColumn("total_salary_cost", total.cast("int"))


def gold_after_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = cdc.apply_changes(*_pair(spark, sf_dir), as_of=inputs.LATER)
    folder = scratch_dir(spark, f"gold_after_cdc-{uuid.uuid4().hex[:8]}")
    gold.department_kpi(state, inputs.LATER, ORDER_KPI).write.parquet(folder)
    stored = spark.read.parquet(folder).orderBy(F.desc_nulls_first("total_salary_cost"))
    return shown(_declared_total(stored))


def _advanced_gold(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Both gold tables of the later day: the earlier day's stored ledger and the changes since."""
    incoming, current = _pair(spark, sf_dir)
    folder = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    running.ledger(current).write.parquet(folder)
    stored = spark.read.parquet(folder)
    moved = running.ledger(running.movements(incoming, current, as_of=inputs.LATER))
    return running.gold_tables(running.advance(stored, moved), inputs.LATER, ORDER_KPI)


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_advanced_gold(spark, sf_dir, "gold_incremental")[0])


def trends_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_advanced_gold(spark, sf_dir, "trends_incremental")[1])


# -- whole cycles ----------------------------------------------------------------


def new_lake(spark: SparkSession, name: str, layouts: dict[str, Layout] = LAYOUTS) -> Lake:
    """An empty lake in a folder of its own."""
    root = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    return Lake(spark, root, prefix=f"{name}_", layouts=layouts)


def initial_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first state: dirty files through the raw table into the keyed one."""
    path = _roster_files(spark, sf_dir, "initial_silver_files")
    lake = new_lake(spark, "initial_silver")
    load_bronze(lake, path)
    refresh_silver(lake, stage_incoming(lake, inputs.GOLD_AS_OF))
    return shown(lake.table("silver.employees"))


def order_files(spark: SparkSession, sf_dir: str, as_of: str, path: str, units: str) -> str:
    """The order snapshot of a day as CSV part files."""
    rows = inputs.order_snapshot(spark, sf_dir, as_of, units)
    return write_snapshot(
        rows.select(*[F.col(c).cast("string").alias(c) for c in SNAPSHOT_COLUMNS]), path
    )


def _two_cycles(
    spark: SparkSession, sf_dir: str, name: str, layouts=LAYOUTS, units: str = inputs.HUNDREDS
) -> Lake:
    """The earlier and then the later order snapshot, as files, through all layers."""
    lake = new_lake(spark, name, layouts)
    for as_of in (inputs.EARLIER, inputs.LATER):
        files = order_files(spark, sf_dir, as_of, scratch_dir(spark, f"{name}_{as_of}"), units)
        run_cycle(lake, files, as_of)
    return lake


def cycle_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _two_cycles(spark, sf_dir, "cycle_silver", WIDE_TOTAL_LAYOUTS)
    return shown(lake.table("silver.employees"))


def cycle_department_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _two_cycles(spark, sf_dir, "cycle_department_kpi", WIDE_TOTAL_LAYOUTS)
    return shown(_declared_total(lake.table("gold.department_kpi")))


def cycle_wide_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts in cents: cost totals beyond INT, in tables declared for them."""
    lake = _two_cycles(spark, sf_dir, "cycle_wide_kpi", WIDE_LAYOUTS, inputs.CENTS)
    return shown(lake.table("gold.department_kpi"))


def cycle_hiring_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _two_cycles(spark, sf_dir, "cycle_hiring_trends", WIDE_TOTAL_LAYOUTS)
    return shown(lake.table("gold.hiring_trends"))


def _configured(query: Query) -> Query:
    """The query, with the settings it relies on put into the session first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _configured(query)
    for query in (
        csv_snapshot,
        csv_snapshot_in_splits,
        na_tokens,
        bronze_staging,
        clean_names,
        clean_names_text,
        clean_email,
        clean_email_hosts,
        clean_phone,
        clean_phone_text,
        clean_salary,
        clean_dates,
        clean_address,
        clean_address_text,
        conform,
        key_violations,
        cdc_classify,
        cdc_counts,
        cdc_fingerprint,
        cdc_insert,
        cdc_update,
        cdc_delete,
        cdc_apply,
        cdc_apply_converging,
        cdc_redetect,
        cond_count,
        cond_sum,
        avg_rounded,
        avg_tenure,
        mode_by_year,
        department_kpi,
        hiring_trends,
        gold_after_cdc,
        gold_incremental,
        trends_incremental,
        initial_silver,
        cycle_silver,
        cycle_department_kpi,
        cycle_wide_kpi,
        cycle_hiring_trends,
    )
}
