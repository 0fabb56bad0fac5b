"""Deltas of a cumulative score, falls in quick succession, and rows joined by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.operators.chunks import CHUNK, MAX_ROWS, chunk_groups, chunk_numbered
from matchbook.operators.scan import ordered_scan


def cumulative_deltas(
    df: DataFrame,
    keys: Sequence[str],
    number: str,
    score: str,
    delta: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``delta`` = score minus the previous score of the group (the first row counts from 0).

    ``number`` numbers the rows of a group 1, 2, 3, …
    """
    chunked = chunk_numbered(df, keys, number, max_rows)
    return (
        ordered_scan(chunked, keys, [number], lags={"_previous": score})
        .withColumn(delta, F.col(score) - F.coalesce(F.col("_previous"), F.lit(0)))
        .drop("_previous", CHUNK)
    )


def collapses(
    df: DataFrame,
    keys: Sequence[str],
    number: str,
    score: str,
    falls: int,
    limit: int,
    pieces: int | None = None,
) -> DataFrame:
    """Spells in which ``falls`` or more rows in a row fall for less than ``limit``.

    ``number`` counts the rows of a group 1, 2, 3, …; ``score`` is cumulative. A spell is
    measured from the score at the fall before its first one (0 at the start). Overlapping spells
    merge. Rows meet by grouping on (group, number), which spreads a hot group over all tasks.
    Output: keys, first_fall, last_fall, score_before, score_after.
    """
    # Each row is a possible start at its own number and the end of the spell ``falls`` before.
    number_, score_ = F.col(number).cast("long"), F.col(score).cast("long")
    none = F.lit(None).cast("long")
    ends = F.array(
        F.struct(number_.alias("_from"), score_.alias("_score"), none.alias("_after")),
        F.struct((number_ - falls).alias("_from"), none.alias("_score"), score_.alias("_after")),
    )
    met = (
        df.select(*keys, F.inline(ends))
        .where(F.col("_from") >= 0)
        .groupBy(*keys, "_from")
        .agg(F.max("_score").alias("_score"), F.max("_after").alias("_after"))
    )
    start = F.when(F.col("_from") == 0, F.lit(0).cast("long")).otherwise(F.col("_score"))
    spells = met.withColumn("_score", start).where(F.col("_after") - F.col("_score") < limit)
    chunked = chunk_groups(spells, keys, ["_from"], pieces)
    stepped = ordered_scan(chunked, keys, ["_from"], lags={"_before": "_from"})
    apart = F.coalesce(F.col("_from") - F.col("_before") >= falls, F.lit(True))
    merged = ordered_scan(stepped, keys, ["_from"], sums={"_spell": F.when(apart, 1).otherwise(0)})
    return merged.groupBy(*keys, "_spell").agg(
        (F.min("_from") + 1).alias("first_fall"),
        (F.max("_from") + falls).alias("last_fall"),
        F.min_by("_score", "_from").alias("score_before"),
        F.max_by("_after", "_from").alias("score_after"),
    ).drop("_spell")
