"""The first numbered lines of each group as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered_lines_to_columns(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, names: Mapping[int, str]
) -> DataFrame:
    """Line 1, 2, … of each group as named columns (a missing line is NULL).

    The rank filter is applied before the shuffle as well as after it, so a group with many lines
    sends only its first few.
    """
    numbered = df.withColumn(
        "_line", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).where(F.col("_line") <= max(names))
    return numbered.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_line") == n, F.col(value))).alias(name) for n, name in names.items()]
    )
