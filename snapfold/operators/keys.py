"""Primary-key report and check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window, functions as F

N_EXAMPLES = 20


class KeyViolation(ValueError):
    """A key is missing or occurs more than once."""


def key_violations(df: DataFrame, *key: str) -> DataFrame:
    """Keys that are NULL or repeated, with their row counts.

    Only the key columns are read and counts are combined before the shuffle, so
    a key that holds a third of all rows costs one row per task.
    """
    missing = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in key])
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | missing)
    )


def check_key(df: DataFrame, *key: str) -> None:
    """Raise, with their number and some examples, unless ``key`` identifies every row."""
    violations = key_violations(df, *key)
    n = violations.count()
    if n:
        found = violations.limit(N_EXAMPLES).collect()
        examples = ", ".join(f"{tuple(r[k] for k in key)} x{r.n_rows}" for r in found)
        more = ", ..." if n > N_EXAMPLES else ""
        raise KeyViolation(
            f"key ({', '.join(key)}) has {n} missing or repeated values: {examples}{more}"
        )


def watched_key(df: DataFrame, seen: Observation, *key: str) -> DataFrame:
    """The same rows; ``seen`` counts those whose key is missing or not the first of its kind.

    Rows that are dealt by the key and sorted by it anyway, for a join or for bucketed files,
    are compared with their neighbours on the way: no further exchange, and no further sort.
    """
    missing = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in key])
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    bad = F.count_if((F.col("__place") > 1) | missing).alias("bad")
    return df.withColumn("__place", place).observe(seen, bad).drop("__place")
