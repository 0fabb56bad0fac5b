"""Dimension joins under a role name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def role(dim: DataFrame, key: str, prefix: str, *columns: str) -> DataFrame:
    """The dimension with its key and columns renamed ``<prefix>_<column>``, ready to join."""
    wanted = columns or [c for c in dim.columns if c != key]
    return dim.select(
        F.col(key).alias(f"{prefix}_{key}"), *[F.col(c).alias(f"{prefix}_{c}") for c in wanted]
    )


def union_names(*columns: DataFrame, name: str) -> DataFrame:
    """Distinct non-empty set union of one-column frames. Each side is reduced before the union."""
    merged = None
    for df in columns:
        side = df.toDF(name).distinct()
        merged = side if merged is None else merged.unionByName(side)
    return merged.distinct()
