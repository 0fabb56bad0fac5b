"""Split hot groups of an ordered table into bounded pieces.

A window partitioned by a group runs each group in one task, so one group with a third of all rows
would be the whole job. Ordered operators here work on (group, chunk) instead, and add what the
earlier chunks of the same group carry over. Chunks are either computed from a row number, or cut from
the sorted rows and stored, so a lost and repeated task always gets the same chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.session import stored

CHUNK = "_chunk"
MAX_ROWS = 1_000_000
PIECES: int | None = None
LISTED = 10_000
_COLD = -1


def along(order: Sequence[str]) -> list[Column]:
    """Sort columns of an ordered operator: unknown positions come last."""
    return [F.col(c).asc_nulls_last() for c in order]


def place(order: Sequence[str]) -> Column:
    """A struct that compares like ``along`` sorts."""
    return F.struct(*[c for name in order for c in (F.col(name).isNull().alias(f"_no_{name}"), F.col(name))])


def chunk_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    pieces: int | None = None,
    max_rows: int = MAX_ROWS,
    suspects: DataFrame | None = None,
) -> DataFrame:
    """Add ``_chunk``: the rows of groups of more than ``max_rows`` rows are sorted by group and ``order`` and cut into
    even pieces, numbered along the sort. Smaller groups stay whole, as chunk -1.

    A group with many rows spans several pieces wherever its rows lie along the order, and also where positions
    repeat, as long as ``order`` tells rows apart. The groups are counted first, which reads the keys only; without
    large ones that is all. ``suspects`` may name, by some of the keys, the groups that can be large at all (any
    superset does), when that is cheaper to tell. Rows without a key are never cut. The cut rows are stored once, so that both readers of the chunks
    (the windows and what is carried between them) see the same cut. With ``pieces`` all groups are cut, into so many;
    else into the session's shuffle partitions, with small ones merged.
    """
    pieces = pieces or PIECES
    if pieces:
        return _cut(df, keys, order, pieces)
    if suspects is None:
        large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max_rows).select(*keys)
    else:
        large = suspects.distinct()
    large = large.dropna()
    listed = large.limit(LISTED + 1).count()
    if not listed:
        return df.withColumn(CHUNK, F.lit(_COLD).cast("long"))
    large = stored(large.select(*[F.col(k).alias(f"_large_{k}") for k in large.columns]))
    same = [F.col(k.removeprefix("_large_")) == F.col(k) for k in large.columns]
    listed_large = F.broadcast(large) if listed <= LISTED else large
    whole = df.join(listed_large, same, "left_anti").withColumn(CHUNK, F.lit(_COLD).cast("long"))
    return whole.unionByName(_cut(df.join(listed_large, same, "left_semi"), keys, order))


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int | None = None) -> DataFrame:
    by = [*[F.col(k) for k in keys], *along(order)]
    dealt = df.repartitionByRange(pieces, *by) if pieces else df.repartitionByRange(*by)
    return stored(dealt.withColumn(CHUNK, F.spark_partition_id().cast("long")))


def chunk_numbered(
    df: DataFrame,
    keys: Sequence[str],
    number: str,
    max_rows: int = MAX_ROWS,
    suspects: DataFrame | None = None,
) -> DataFrame:
    """The same for groups whose rows already carry a unique whole number, such as a line number.

    A group is hot when it has a row numbered beyond ``max_rows``. That test is a filter the scan
    can push down, so ordinary tables pay one pruned scan for it and no aggregate. The list of hot
    groups is counted first: without any there is no join, a list of at most ``LISTED`` groups is
    broadcast, a longer one joined like any table. ``suspects`` may name the groups that can be
    hot at all (any superset does), when that is cheaper to tell than by numbering.
    """
    beyond = df.where(F.col(number) > max_rows) if suspects is None else suspects
    hot = beyond.select(*keys).distinct().withColumn("_hot", F.lit(True))
    listed = hot.limit(LISTED + 1).count()
    if not listed:
        return df.withColumn(CHUNK, F.lit(_COLD).cast("long"))
    slice_no = F.floor(F.col(number) / max_rows).cast("long")
    return (
        df.join(F.broadcast(hot) if listed <= LISTED else hot, list(keys), "left")
        .withColumn(CHUNK, F.when(F.col("_hot"), slice_no).otherwise(F.lit(_COLD).cast("long")))
        .drop("_hot")
    )
