"""Orders whose cost totals outgrow INT, as those of large tables do."""

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from snapfold.plans import inputs
from tests.compare import compare


@pytest.fixture(scope="module")
def large(spark, sf_dir, tmp_path_factory):
    """A folder of 1000 orders and their lines; amounts fit INT, their totals do not."""
    folder = str(tmp_path_factory.mktemp("large"))
    orders = inputs.table(spark, sf_dir, "orders").where("o_orderkey < 1000")
    orders.withColumn("o_totalprice", F.lit(8.8e9)).write.parquet(f"{folder}/orders.parquet")
    lines = inputs.table(spark, sf_dir, "lineitem").where("l_orderkey < 1000")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.fixture(scope="module")
def large_con(large):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{large}/{table}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", ["cycle_silver", "cycle_hiring_trends"])
def test_tables_beside_the_totals(spark, large, large_con, name):
    assert compare(spark, large_con, large, queries()[name], oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["cycle_department_kpi", "gold_after_cdc"])
def test_totals_beyond_int(spark, large, large_con, name):
    """The SQL casts the total to integer, and stops here; its copy casts to bigint."""
    sql = oracle_sql()[name]
    with pytest.raises(duckdb.ConversionException):
        large_con.execute(sql)
    wide = sql.replace("cast(cost AS integer)", "cast(cost AS bigint)")
    assert compare(spark, large_con, large, queries()[name], wide) is None
