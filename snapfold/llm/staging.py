"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from snapfold.session import scratch_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name not used before, below the shared scratch folder."""
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def staged(rows: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet and read back: computed once, and safe from lost executors."""
    spark = rows.sparkSession
    folder = new_folder(spark, name)
    rows.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
