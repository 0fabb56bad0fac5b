"""Cut an ordered line stream into blocks at marker lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.operators.chunks import CHUNK, along


def segment_blocks(
    lines: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    marker: str,
    flags: Mapping[str, Column],
) -> DataFrame:
    """Add ``block_id``, ``first_content``, ``last_content`` and one boolean per flag.

    ``lines`` carries ``_chunk`` (see chunks) and a boolean ``marker`` column. A marker line raises
    the block number by one. ``first_content``/``last_content`` are the lowest and highest block
    with a non-marker line in the group. Each flag becomes true on every line of a block in which
    any line meets it.

    One shuffle by (group, chunk). In a group of one chunk the windows are the answer; for hot
    groups, one summary row per chunk corrects the block numbers, the content bounds, and the
    flags of the first and last block of the chunk, the only two that can cross a chunk border.
    """
    part = [*keys, CHUNK]
    whole = Window.partitionBy(*part)
    running = whole.orderBy(*along(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_block = Window.partitionBy(*part, "_local")
    names = list(flags)

    met = [F.coalesce(c, F.lit(False)).alias(f"_is_{n}") for n, c in flags.items()]
    annotated = (
        lines.select("*", *met)
        .withColumn("_local", F.sum(F.when(F.col(marker), 1).otherwise(0)).over(running))
        .withColumns(
            {
                "_lo": F.min(F.when(~F.col(marker), F.col("_local"))).over(whole),
                "_hi": F.max(F.when(~F.col(marker), F.col("_local"))).over(whole),
                "_markers": F.max("_local").over(whole),
                **{f"_any_{n}": F.max(f"_is_{n}").over(in_block) for n in names},
            }
        )
    )

    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    group = Window.partitionBy(*keys)
    summary = (
        annotated.where(F.col(CHUNK) >= 0)
        .groupBy(*part)
        .agg(
            F.max("_markers").alias("_m"),
            F.min("_lo").alias("_clo"),
            F.max("_hi").alias("_chi"),
            *[F.max(F.when(F.col("_local") == 0, F.col(f"_is_{n}"))).alias(f"_head_{n}") for n in names],
            *[
                F.max(F.when(F.col("_local") == F.col("_markers"), F.col(f"_is_{n}"))).alias(f"_tail_{n}")
                for n in names
            ],
        )
        .withColumn(
            "_offset",
            F.coalesce(F.sum("_m").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("_glo", F.min(F.col("_offset") + F.col("_clo")).over(group))
        .withColumn("_ghi", F.max(F.col("_offset") + F.col("_chi")).over(group))
    )
    # The block that ends one chunk opens the next; gather its flags over all chunks it touches.
    ends = F.array(
        F.struct(
            F.lit(0).alias("side"),
            F.col("_offset").alias("block"),
            *[F.col(f"_head_{n}").alias(n) for n in names],
        ),
        F.struct(
            F.lit(1).alias("side"),
            (F.col("_offset") + F.col("_m")).alias("block"),
            *[F.col(f"_tail_{n}").alias(n) for n in names],
        ),
    )
    one_block = Window.partitionBy(*keys, "block")
    fix = (
        summary.select("*", F.explode(ends).alias("_end"))
        .select(*part, "_offset", "_glo", "_ghi", "_end.*")
        .select(
            *part,
            "_offset",
            "_glo",
            "_ghi",
            "side",
            *[F.coalesce(F.max(n).over(one_block), F.lit(False)).alias(n) for n in names],
        )
        .groupBy(*part, "_offset", "_glo", "_ghi")
        .agg(
            F.count(F.lit(1)).alias("_ends"),
            *[F.max(F.when(F.col("side") == 0, F.col(n))).alias(f"_first_{n}") for n in names],
            *[F.max(F.when(F.col("side") == 1, F.col(n))).alias(f"_last_{n}") for n in names],
        )
    )

    joined = annotated.join(fix, part, "left")
    at_head = F.col("_offset").isNotNull() & (F.col("_local") == 0)
    at_tail = F.col("_offset").isNotNull() & (F.col("_local") == F.col("_markers"))
    return joined.select(
        *lines.columns,
        (F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))).alias("block_id"),
        F.coalesce(F.col("_glo"), F.col("_lo")).alias("first_content"),
        F.coalesce(F.col("_ghi"), F.col("_hi")).alias("last_content"),
        *[
            F.when(at_head, F.col(f"_first_{n}"))
            .when(at_tail, F.col(f"_last_{n}"))
            .otherwise(F.col(f"_any_{n}"))
            .alias(n)
            for n in names
        ],
    )
