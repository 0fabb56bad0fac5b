"""Ordered scans over groups of any size: row number, running sum, previous value, first value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.functions.text import col_of
from matchbook.operators.chunks import CHUNK, along, chunk_groups, place


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    sums: Mapping[str, Column | str] | None = None,
    lags: Mapping[str, Column | str] | None = None,
    firsts: Mapping[str, Column | str] | None = None,
    lasts: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Add running columns along ``order`` inside each group of a chunked frame.

    ``number`` is the 1-based row number, ``sums`` inclusive running sums, ``lags`` the previous
    row's value, ``firsts`` the value of the group's first row, ``lasts`` the latest value that is not
    null, the row's own included. ``order`` must be total; nulls in it come last. The window runs per (group, chunk); chunk totals of hot groups are then carried forward. The big
    side of that join already has the window's partitioning, so it is not shuffled again.
    """
    sums, lags, firsts, lasts = dict(sums or {}), dict(lags or {}), dict(firsts or {}), dict(lasts or {})
    part = [*keys, CHUNK]
    within = Window.partitionBy(*part).orderBy(*along(order))
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inputs = {f"_in_{name}": col_of(value) for name, value in {**sums, **lags, **firsts, **lasts}.items()}
    prepared = df.withColumns(inputs) if inputs else df

    local = {"_rn": F.row_number().over(within).cast("long")}
    local |= {name: F.sum(f"_in_{name}").over(running) for name in sums}
    local |= {name: F.lag(f"_in_{name}").over(within) for name in lags}
    local |= {name: F.first(f"_in_{name}").over(running) for name in firsts}
    local |= {name: F.last(f"_in_{name}", ignorenulls=True).over(running) for name in lasts}
    scanned = prepared.withColumns(local)

    # One row per chunk of a hot group.
    at = place(order)
    totals = [F.count(F.lit(1)).alias("_rows")]
    totals += [F.sum(f"_in_{name}").alias(f"_sum_{name}") for name in sums]
    if lags:
        totals.append(F.max_by(F.struct(*[F.col(f"_in_{n}").alias(n) for n in lags]), at).alias("_last"))
    if firsts:
        totals.append(F.min_by(F.struct(*[F.col(f"_in_{n}").alias(n) for n in firsts]), at).alias("_first"))
    for name in lasts:
        given = F.col(f"_in_{name}").isNotNull()
        totals.append(F.max_by(F.when(given, F.col(f"_in_{name}")), F.when(given, at)).alias(f"_latest_{name}"))
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        prepared.where(F.col(CHUNK) >= 0)
        .groupBy(*part)
        .agg(*totals)
        .select(
            *part,
            F.sum("_rows").over(before).alias("_c_rows"),
            *[F.sum(f"_sum_{n}").over(before).alias(f"_c_sum_{n}") for n in sums],
            *([F.lag("_last").over(chunks).alias("_c_last")] if lags else []),
            *([F.first("_first").over(before).alias("_c_first")] if firsts else []),
            *[F.last(f"_latest_{n}", ignorenulls=True).over(before).alias(f"_c_latest_{n}") for n in lasts],
        )
        .where(F.col("_c_rows") > 0)  # few: only a group that goes on from an earlier chunk has any
    )
    joined = scanned.join(carry, part, "left")
    out: dict[str, Column] = {}
    for name in sums:
        here, earlier = F.col(name), F.col(f"_c_sum_{name}")
        out[name] = F.coalesce(here + earlier, here, earlier)
    for name in lags:
        out[name] = F.when(F.col("_rn") == 1, F.col(f"_c_last.{name}")).otherwise(F.col(name))
        out[name] = F.when((F.col("_rn") == 1) & F.col("_c_last").isNull(), F.lit(None)).otherwise(out[name])
    for name in firsts:
        out[name] = F.when(F.col("_c_first").isNotNull(), F.col(f"_c_first.{name}")).otherwise(F.col(name))
    for name in lasts:
        out[name] = F.coalesce(F.col(name), F.col(f"_c_latest_{name}"))
    if number:
        out[number] = F.col("_rn") + F.coalesce(F.col("_c_rows"), F.lit(0))
    new = [*sums, *lags, *firsts, *lasts, *([number] if number else [])]
    kept = [c for c in df.columns if c not in new]
    return joined.select(*kept, *[out[name].alias(name) for name in new])


def scan_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    pieces: int | None = None,
    suspects: DataFrame | None = None,
    **columns,
) -> DataFrame:
    """Cut large groups along ``order``, scan, and drop the chunk again."""
    chunked = chunk_groups(df, keys, order, pieces, suspects=suspects)
    return ordered_scan(chunked, keys, order, **columns).drop(CHUNK)


def with_totals(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Add whole-group aggregates to every row.

    Aggregate and join instead of an unordered window: the aggregate is combined on the map side,
    and a hot key on the join side is split by adaptive execution.
    """
    summed = df.groupBy(*keys).agg(*[value.alias(name) for name, value in totals.items()])
    return df.join(summed, list(keys), "left")
