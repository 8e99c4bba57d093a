"""Raw snapshot rows -> cleaned, typed rows, in one projection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from snapfold import schemas
from snapfold.functions import cleaning


def as_of_column(as_of: dt.date | str | None) -> Column:
    """The one "today" of a run; the current date only if none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def normalise_nulls(df: DataFrame, tokens: tuple[str, ...] = schemas.NA_TOKENS) -> DataFrame:
    """Every text column with the missing-value tokens turned into NULL."""
    quoted = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)
    return df.selectExpr(
        *[
            f"CASE WHEN `{name}` NOT IN ({quoted}) THEN `{name}` END AS `{name}`" if sql_type == "string" else f"`{name}`"
            for name, sql_type in df.dtypes
        ]
    )


def conform_employees(
    raw: DataFrame, as_of: dt.date | str | None = None, key_type: str = "int"
) -> DataFrame:
    """All cleaning rules at once, in silver column order.

    Department and status are copied as they are.  The steps become stacked
    projections of one code-generated stage: every text is shaped, and every date
    read, exactly once.
    """
    shaped = raw.select(
        F.col("employee_id").cast(key_type).alias("employee_id"),
        cleaning.strip(F.col("first_name")).alias("first_name"),
        cleaning.strip(F.col("last_name")).alias("last_name"),
        "department",
        cleaning.mail_text(F.col("email")).alias("email"),
        cleaning.digits(F.col("phone")).alias("phone"),
        "status",
        cleaning.digits(F.col("salary")).alias("salary"),
        cleaning.strip(F.col("joining_date")).alias("start_text"),
        cleaning.strip(F.col("termination_date")).alias("end_text"),
        cleaning.one_line(F.col("address")).alias("address"),
    )
    dated = shaped.withColumns(
        {
            "start": cleaning.date_or_null(F.col("start_text")),
            "end": cleaning.date_or_null(F.col("end_text")),
        }
    )
    start, end, flag = cleaning.resolve_dates(
        F.col("status"),
        F.col("start"),
        F.col("end"),
        F.col("start_text").isNull(),
        F.col("end_text").isNull(),
    )
    judged = {
        "first_name": cleaning.title_case(F.col("first_name")),
        "last_name": cleaning.title_case(F.col("last_name")),
        "email": cleaning.mail_or_null(F.col("email")),
        "phone": cleaning.phone_or_null(F.col("phone")),
        "salary": cleaning.salary_or_null(F.col("salary")),
        "joining_date": start,
        "termination_date": end,
        "status_flag": flag,
        "address": cleaning.address_or_null(F.col("address")),
        "updated_at": as_of_column(as_of),
    }
    return dated.select(
        *[
            judged.get(name, F.col(name)).alias(name)
            for name in schemas.names(schemas.SILVER_EMPLOYEES)
        ]
    )
