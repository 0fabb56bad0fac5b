"""Read the given parquet tables and keep exact money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchbook.functions.text import col_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(value: Column | str) -> Column:
    """Money as whole cents, so that sums do not depend on the order of addition."""
    return F.round(col_of(value) * 100).cast("long")
