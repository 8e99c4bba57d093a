"""Business records derived from whole test tables, for the registered queries.

The expressions are plain SQL that Spark and the checking engine read alike, so
both sides start from the same rows; what is checked is what the operators make
of them.  Which kind of dirt a record carries depends on its customer's nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapfold.functions.cleaning import resolve_dates
from snapfold.schemas import SILVER_EMPLOYEES, SNAPSHOT_COLUMNS, names

# As-of dates: the gold tables, and the earlier and later order snapshot.
GOLD_AS_OF = "2001-12-31"
EARLIER = "1999-06-30"
LATER = "1999-12-31"

# Dirty snapshot rows over orders joined with customer.
RAW_ROSTER = {
    "employee_id": "cast(o_orderkey as string)",
    "first_name": """CASE c_nationkey
        WHEN 0 THEN concat('  o', chr(39), lower(c_mktsegment), ' ')
        WHEN 1 THEN concat(c_mktsegment, '-', lower(c_mktsegment))
        WHEN 2 THEN concat(chr(9), lower(c_mktsegment), ' 3rd', chr(10))
        WHEN 3 THEN ''
        WHEN 4 THEN '   '
        WHEN 5 THEN NULL
        WHEN 6 THEN concat('josé ÁLVAREZ ', c_mktsegment)
        WHEN 7 THEN concat('ßtraße ', lower(c_mktsegment))
        WHEN 8 THEN concat('ﬁn', lower(c_mktsegment))
        WHEN 9 THEN 'NULL'
        ELSE c_mktsegment END""",
    "last_name": """CASE c_nationkey
        WHEN 10 THEN NULL
        WHEN 11 THEN lower(c_name)
        WHEN 12 THEN concat(upper(c_name), ' mcÉLAN d', chr(39), 'or’azur')
        WHEN 13 THEN 'n/a'
        ELSE c_name END""",
    "department": """CASE c_nationkey
        WHEN 21 THEN lower(o_orderpriority)
        WHEN 22 THEN NULL
        ELSE o_orderpriority END""",
    "email": """CASE c_nationkey
        WHEN 0 THEN concat(' ', c_name, '@X.Com ')
        WHEN 1 THEN 'user_no_domain'
        WHEN 2 THEN concat('USER_NO_DOMAIN', chr(10))
        WHEN 3 THEN ''
        WHEN 4 THEN concat(c_name, 'example.com')
        WHEN 5 THEN concat(c_name, '.example.net')
        WHEN 6 THEN 'example.org'
        WHEN 7 THEN concat(c_name, '.gmail.com')
        WHEN 8 THEN '@'
        WHEN 9 THEN NULL
        WHEN 10 THEN concat(c_name, 'EXAMPLE.ORG')
        ELSE concat(lower(c_mktsegment), cast(o_orderkey as string), '@example.org') END""",
    "phone": """CASE c_nationkey
        WHEN 0 THEN concat('(394)387-', cast(o_orderkey as string), 'x172')
        WHEN 1 THEN concat('+1-277-', cast(o_orderkey as string), 'x8890')
        WHEN 2 THEN 'n/a'
        WHEN 3 THEN ''
        WHEN 4 THEN NULL
        WHEN 5 THEN 'call me'
        WHEN 6 THEN concat('٣٩٤-', cast(o_orderkey as string))
        ELSE concat('001-', cast(o_orderkey as string), '.', cast(o_custkey as string)) END""",
    "status": """CASE c_nationkey
        WHEN 23 THEN ' active'
        WHEN 24 THEN NULL
        ELSE CASE o_orderstatus
            WHEN 'F' THEN 'Terminated' WHEN 'O' THEN 'Active' ELSE 'Leave' END END""",
    "salary": """CASE c_nationkey
        WHEN 0 THEN concat('$', cast(whole as string))
        WHEN 1 THEN concat('-', cast(whole as string))
        WHEN 2 THEN concat('$', cast(cast(floor(whole / 1000) as bigint) as string), ',',
                           lpad(cast(whole % 1000 as string), 3, '0'), '.50')
        WHEN 3 THEN 'abc'
        WHEN 4 THEN ''
        WHEN 5 THEN NULL
        WHEN 6 THEN concat(cast(whole as string), '.0')
        ELSE cast(whole as string) END""",
    "joining_date": """CASE c_nationkey
        WHEN 0 THEN concat(cast(year(day) as string), '-', cast(month(day) as string), '-',
                           cast(day(day) as string))
        WHEN 1 THEN concat(' ', cast(day as string), chr(9))
        WHEN 2 THEN concat(cast(year(day) as string), '-02-30')
        WHEN 3 THEN concat(cast(day(day) as string), '/', cast(month(day) as string), '/',
                           cast(year(day) as string))
        WHEN 4 THEN substr(cast(day as string), 3)
        WHEN 5 THEN concat(cast(day as string), ' 00:00')
        WHEN 6 THEN ''
        WHEN 7 THEN concat('1', cast(day as string))
        WHEN 8 THEN NULL
        WHEN 9 THEN 'garbage'
        ELSE cast(day as string) END""",
    "termination_date": """CASE
        WHEN o_orderstatus = 'O' OR c_nationkey = 8 THEN NULL
        WHEN c_nationkey = 2 THEN '2023-02-29'
        WHEN c_nationkey = 9 THEN 'garbage'
        ELSE cast(day + (c_nationkey - 14) * 37 as string) END""",
    "address": """CASE c_nationkey
        WHEN 0 THEN concat('No. ', cast(o_orderkey as string), chr(10), 'NATION_0, "IL" 453')
        WHEN 1 THEN concat(' UNKNOWN', chr(10))
        WHEN 2 THEN chr(10)
        WHEN 3 THEN ''
        WHEN 4 THEN NULL
        WHEN 5 THEN concat('a', chr(13), chr(10), 'b ', cast(o_orderkey as string))
        WHEN 6 THEN 'unknown'
        WHEN 7 THEN concat('Unit "', cast(o_orderkey as string), '"')
        ELSE concat(cast(o_orderkey as string), ' ', c_mktsegment, ' Street', chr(10),
                    'NATION_', cast(c_nationkey as string)) END""",
}

# State of an order's lines on a day (``{day}``), per order.
LINES_AS_OF = {
    "n_shipped": "count(CASE WHEN cast(l_shipdate as date) <= {day} THEN 1 END)",
    "shipped": """sum(CASE WHEN cast(l_shipdate as date) <= {day}
        THEN cast(floor(l_extendedprice) as bigint) END)""",
    "last_ship": """max(CASE WHEN cast(l_shipdate as date) <= {day}
        THEN cast(l_shipdate as date) END)""",
    "worst_flag": "max(CASE WHEN cast(l_shipdate as date) <= {day} THEN ascii(l_returnflag) END)",
}

# One record per order, as known on a day.
ORDER_SNAPSHOT = {
    "employee_id": "cast(o_orderkey as int)",
    "first_name": """CASE WHEN n_shipped >= 2 THEN concat('Flag ', chr(worst_flag))
        WHEN n_shipped = 1 THEN '' END""",
    "last_name": "concat('Order#', cast(o_orderkey as string))",
    "department": "CASE WHEN chr(worst_flag) = 'R' THEN 'RETURNS' ELSE o_orderpriority END",
    "email": "concat('order', cast(o_orderkey as string), '@in', cast({day} as string), '.com')",
    "phone": "concat('1', cast(o_custkey as string), cast(coalesce(n_shipped, 0) as string))",
    "status": """CASE WHEN coalesce(n_shipped, 0) = 0
            THEN CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'Active' END
        WHEN n_shipped = 2 THEN 'Active'
        WHEN n_shipped = 3 THEN 'Leave'
        ELSE 'Terminated' END""",
    "salary": """cast(floor((coalesce(shipped, 0) + cast(floor(o_totalprice) as bigint)) {units})
        as int)""",
    "joining_date": "cast(o_orderdate as date)",
    "termination_date": "CASE WHEN n_shipped = 1 OR n_shipped >= 4 THEN last_ship END",
    "address": """CASE WHEN n_shipped = 3 THEN NULL
        ELSE concat(cast(coalesce(n_shipped, 0) as string), ' lines', chr(10), 'on ',
                    cast({day} as string)) END""",
}
# Of seven classes of keys, the one that a snapshot lacks: not yet there, or no longer.
ABSENT = {EARLIER: 3, LATER: 5}
# Amounts that fit the employee tables' INT total, and such that outgrow it.
HUNDREDS, CENTS = "/ 100", "* 100"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(as_of: str) -> str:
    return f"DATE '{as_of}'"


def raw_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dirty snapshot row per order, all text."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("day", F.col("o_orderdate").cast("date"))
        .withColumn("whole", F.floor("o_totalprice").cast("bigint"))
        .selectExpr(*[f"{RAW_ROSTER[c]} AS {c}" for c in SNAPSHOT_COLUMNS])
    )


def _lines(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(*[F.expr(e.format(day=_day(as_of))).alias(c) for c, e in LINES_AS_OF.items()])
    )


def known_on(as_of: str) -> str:
    """The condition on orders that a snapshot holds; two snapshots together hold every order."""
    return f"o_orderkey % 7 <> {ABSENT[as_of]}"


def snapshot_columns(as_of: str, units: str = HUNDREDS) -> dict[str, str]:
    return {c: ORDER_SNAPSHOT[c].format(day=_day(as_of), units=units) for c in SNAPSHOT_COLUMNS}


def order_snapshot(
    spark: SparkSession, sf_dir: str, as_of: str, units: str = HUNDREDS
) -> DataFrame:
    """Snapshot rows of the orders known on a day, dates not yet resolved."""
    orders = table(spark, sf_dir, "orders").where(known_on(as_of))
    lines = _lines(spark, sf_dir, as_of)
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").selectExpr(
        *[f"{e} AS {c}" for c, e in snapshot_columns(as_of, units).items()]
    )


def order_state(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    """The same as typed, keyed state with resolved dates."""
    rows = order_snapshot(spark, sf_dir, as_of)
    start, end, flag = resolve_dates(
        F.col("status"),
        F.col("joining_date"),
        F.col("termination_date"),
        F.col("joining_date").isNull(),
        F.col("termination_date").isNull(),
    )
    resolved = {
        "joining_date": start,
        "termination_date": end,
        "status_flag": flag,
        "updated_at": F.lit(as_of).cast("date"),
    }
    return rows.select(
        *[resolved.get(c, F.col(c)).alias(c) for c in names(SILVER_EMPLOYEES)]
    )


def order_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as employment records: from the order date to the first shipment."""
    orders = table(spark, sf_dir, "orders")
    first_ship = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min(F.col("l_shipdate").cast("date")).alias("first_ship"))
    )
    rows = orders.join(first_ship, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = (
        F.when(F.col("o_orderstatus") == "F", "Terminated")
        .when(F.col("o_orderstatus") == "O", "Active")
        .otherwise("Leave")
    )
    ordered = F.col("o_orderdate").cast("date")
    start, end, flag = resolve_dates(
        status, ordered, F.col("first_ship"), ordered.isNull(), F.col("first_ship").isNull()
    )
    return rows.select(
        F.col("o_orderkey").alias("employee_id"),
        F.col("o_orderpriority").alias("department"),
        status.alias("status"),
        F.floor("o_totalprice").cast("int").alias("salary"),
        start.alias("joining_date"),
        end.alias("termination_date"),
        flag.alias("status_flag"),
    )
