"""Group dated rows into series: a new one starts after a long enough gap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.operators.chunks import CHUNK, chunk_groups, place
from matchbook.operators.scan import ordered_scan
from matchbook.session import stored


def gap_series(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    tie: str,
    max_gap_days: int,
    *,
    firsts: Mapping[str, Column | str] | None = None,
    totals: Mapping[str, Column] | None = None,
    sums: Mapping[str, Column] | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Add series_no, series_position, series_size, plus values of the series' first row,
    totals of the series, and running sums inside it.

    Rows of a group are ordered by (date, tie), unknown dates last; a gap of more than ``max_gap_days`` days, or a
    missing date on either side, starts a new series. Both scans share one shuffle; the series
    facts come from an aggregate joined back, so no window runs over a whole series.
    """
    firsts, totals, sums = dict(firsts or {}), dict(totals or {}), dict(sums or {})
    order = [date, tie]
    chunked = chunk_groups(df, keys, order, pieces)
    stepped = ordered_scan(chunked, keys, order, number="_pos", lags={"_previous": date})
    gap = F.datediff(F.col(date), F.col("_previous"))
    values = {f"_value_{n}": F.coalesce(v, F.lit(0)).cast("long") for n, v in sums.items()}
    numbered = ordered_scan(
        stepped.select("*", *[v.alias(n) for n, v in values.items()]),
        keys,
        order,
        sums={
            "series_no": F.when(gap <= max_gap_days, 0).otherwise(1),
            **{f"_run_{n}": f"_value_{n}" for n in sums},
        },
    ).drop(CHUNK, "_previous")
    numbered = stored(numbered)  # read twice: for the facts of each series, and for the rows
    # What the group had summed up before the series began.
    before = [
        F.min_by(F.col(f"_run_{n}") - F.col(f"_value_{n}"), "_pos").alias(f"_before_{n}") for n in sums
    ]
    first_row = {n: F.min_by(v, place(order)).alias(n) for n, v in firsts.items()}
    facts = numbered.groupBy(*keys, "series_no").agg(
        F.min("_pos").alias("_start"),
        F.count(F.lit(1)).alias("series_size"),
        *first_row.values(),
        *[value.alias(name) for name, value in totals.items()],
        *before,
    )
    joined = numbered.join(facts, [*keys, "series_no"]).withColumn(
        "series_position", F.col("_pos") - F.col("_start") + 1
    )
    inside = [(F.col(f"_run_{n}") - F.col(f"_before_{n}")).alias(n) for n in sums]
    spent = [f"{p}_{n}" for n in sums for p in ("_run", "_value", "_before")]
    return joined.select("*", *inside).drop("_pos", "_start", *spent)
