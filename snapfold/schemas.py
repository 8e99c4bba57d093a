"""Column lists, table DDL and the missing-value tokens (all fixed values)."""

from __future__ import annotations

KEY = "employee_id"

# Snapshot columns in file order.
SNAPSHOT_COLUMNS = (
    "employee_id",
    "first_name",
    "last_name",
    "department",
    "email",
    "phone",
    "status",
    "salary",
    "joining_date",
    "termination_date",
    "address",
)

# Field texts that mean "missing" in a snapshot file, quoted or not.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Table layouts, as (column, SQL type).  VARCHAR limits, INT and
# DECIMAL ranges are enforced by Spark when rows are inserted (ANSI mode).
BRONZE_EMPLOYEES = (
    ("employee_id", "INT"),
    ("first_name", "STRING"),
    ("last_name", "STRING"),
    ("department", "STRING"),
    ("email", "STRING"),
    ("phone", "STRING"),
    ("status", "STRING"),
    ("salary", "STRING"),
    ("joining_date", "STRING"),
    ("termination_date", "STRING"),
    ("address", "STRING"),
    ("ingestion_timestamp", "TIMESTAMP"),
)

SILVER_EMPLOYEES = (
    ("employee_id", "INT"),
    ("first_name", "VARCHAR(100)"),
    ("last_name", "VARCHAR(100)"),
    ("department", "VARCHAR(100)"),
    ("email", "VARCHAR(200)"),
    ("phone", "VARCHAR(20)"),
    ("status", "VARCHAR(15)"),
    ("salary", "INT"),
    ("joining_date", "DATE"),
    ("termination_date", "DATE"),
    ("status_flag", "BOOLEAN"),
    ("address", "STRING"),
    ("updated_at", "DATE"),
)

GOLD_DEPARTMENT_KPI = (
    ("department", "VARCHAR(100)"),
    ("total_employees", "INT"),
    ("active_employees", "INT"),
    ("avg_salary", "DECIMAL(10,2)"),
    ("total_salary_cost", "INT"),
    ("avg_tenure_days", "INT"),
    ("last_updated", "DATE"),
)

GOLD_HIRING_TRENDS = (
    ("hiring_year", "INT"),
    ("total_hires", "INT"),
    ("avg_starting_salary", "DECIMAL(10,2)"),
    ("most_hired_dept", "VARCHAR(100)"),
    ("last_updated", "DATE"),
)


# What outgrows INT in large tables: keys, head counts and cost totals.
_WIDE = ("employee_id", "total_employees", "active_employees", "total_salary_cost", "total_hires")


def widened(layout, columns=_WIDE):
    """The layout with BIGINT keys, counts and totals, or those of them that are named."""
    return tuple((name, "BIGINT" if name in columns else sql_type) for name, sql_type in layout)


def names(layout) -> list[str]:
    return [name for name, _ in layout]


def ddl(layout) -> str:
    return ", ".join(f"`{name}` {sql_type}" for name, sql_type in layout)
