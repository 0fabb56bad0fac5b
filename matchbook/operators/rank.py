"""Best and latest rows per group, leaderboards, and short form strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group. Spark limits each group before the shuffle too."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def leaderboard(df: DataFrame, order: Sequence[Column], n: int, at_least: Column | None = None) -> DataFrame:
    """Top ``n`` rows, optionally only those with a minimum sample. Give a full tie-break."""
    kept = df if at_least is None else df.where(at_least)
    return kept.orderBy(*order).limit(n)


def recent_form(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: Column,
    n: int = 5,
    form: str = "form",
) -> DataFrame:
    """The last ``n`` texts of each group, oldest first, as 'a, b, c'."""
    latest = [F.col(c).desc() for c in order]
    last = top_per_group(df.withColumn("_text", text), keys, latest, n, "_back")
    listed = F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("at"), F.col("_text").alias("text"))))
    return last.groupBy(*keys).agg(
        F.concat_ws(", ", F.transform(listed, lambda s: s["text"])).alias(form)
    )
