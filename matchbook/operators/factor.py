"""Leave-one-out comparison of each member with its peers in the same group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def leave_one_out(
    df: DataFrame, group: Sequence[str], member: Sequence[str], measures: Mapping[str, Column], meet: str | None = None
) -> DataFrame:
    """One row per (group, member) with ``own_<m>`` sums and ``peer_<m>`` = group sum - own sum.

    Members are summed first (combined before the shuffle), and the group sums come from those
    sums. No row meets another row of its group. A row without a group has no peers and is left
    out; saying so up front gives both uses of the member sums the same plan, so the rows are read
    and shuffled once. ``meet`` may ask for a kind of join.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group])
    own = df.where(known).groupBy(*group, *member).agg(
        *[F.sum(value).alias(f"own_{m}") for m, value in measures.items()]
    )
    totals = own.groupBy(*group).agg(*[F.sum(f"own_{m}").alias(f"_all_{m}") for m in measures])
    return own.join(totals.hint(meet) if meet else totals, list(group)).withColumns(
        {f"peer_{m}": F.col(f"_all_{m}") - F.col(f"own_{m}") for m in measures}
    ).drop(*[f"_all_{m}" for m in measures])
