"""Resolve a shortened name against a roster, refusing to guess."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.functions.text import col_of, part
from matchbook.operators.arrays import bound
from matchbook.operators.scan import scan_groups


def name_fragment(surname: Column | str) -> Column:
    """Text after the first apostrophe if there is any, else a blank and the surname."""
    tail = part(surname, "'", 2)
    return F.when(tail != "", tail).otherwise(F.concat(F.lit(" "), col_of(surname)))


def resolve_listed(df: DataFrame, names: Column, asked: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """The same rows as ``resolve_suffixes`` where each row holds the roster of its group as a short array ``names``
    (repeats count once): nothing is shuffled or sorted."""
    found = {}
    for fragment, hits in asked.values():
        ends = bound(F.lower(fragment), lambda f: F.filter(F.array_distinct(names), lambda n: F.endswith(F.lower(n), f)))
        found[f"_of_{hits}"] = F.when(F.length(fragment) > 0, ends)
    held = df.withColumns(found)
    for column, (_, hits) in asked.items():
        of = F.col(f"_of_{hits}")
        held = held.withColumn(column, F.when(F.size(of) == 1, F.get(of, F.lit(0))))
        held = held.withColumn(hits, F.when(of.isNull(), 0).otherwise(F.size(of)).cast("long"))
    return held.drop(*found)


_ROSTER, _LOW, _HIGH = 1, 0, 2


def resolve_suffixes(
    df: DataFrame,
    roster: DataFrame,
    keys: Sequence[str],
    name: str,
    asked: Mapping[str, tuple[Column, str]],
    suspects: DataFrame | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Look up name endings in the roster of their group: for each ``column: (fragment, hits)`` of ``asked`` add the
    roster name that ends in the fragment when exactly one does, and how many different names do. Case does not count.

    Read backwards, the names that end in a fragment begin with it, so in sorted order they lie between the fragment
    and the fragment with a byte above all text. Both ends go into the sorted names of the group: the difference of
    their running numbers is the number of hits, and the name last seen at the upper end is the hit. So there is one
    sort, and neither endings nor pairs are made. A group of any size is cut along the order (``chunk_groups``, which
    takes ``suspects``); rows that repeat travel once, with their number.

    A NULL or empty fragment (a guarded row), or a NULL key, keeps its row with 0 hits and no name.
    """
    text = lambda c: F.reverse(F.lower(c)).cast("binary")
    columns = df.columns
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    row = F.struct(*columns, "_times")
    ends = [F.struct(F.lit(None).cast("int").alias("ask"), F.lit(_LOW).alias("end"), F.lit(None).cast("binary").alias("at"))]
    for i, (fragment, _) in enumerate(asked.values()):
        at = F.when(known & (F.length(fragment) > 0), text(fragment))
        for end, place in ((_LOW, at), (_HIGH, F.concat(at, F.lit(b"\xff")))):
            ends.append(F.struct(F.lit(i).alias("ask"), F.lit(end).alias("end"), place.alias("at")))
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_times"))
    edges = rows.select(
        *keys, row.alias("_row"), F.explode(F.filter(F.array(*ends), lambda e: e.ask.isNull() | e.at.isNotNull())).alias("_e")
    ).select(*keys, "_row", F.col("_e.ask").alias("_ask"), F.col("_e.end").alias("_end"), F.col("_e.at").alias("_at"))
    edges = edges.withColumn("_salt", F.xxhash64("_row")).withColumn("_name", F.lit(None).cast("string"))
    names = roster.select(*keys, F.col(name).alias("_name")).where(known & F.col("_name").isNotNull()).distinct()
    names = names.select("*", F.lit(_ROSTER).alias("_end"), text(F.col("_name")).alias("_at"))
    sorted_names = scan_groups(
        edges.unionByName(names, allowMissingColumns=True),
        keys,
        ["_at", "_end", "_name", "_salt"],
        pieces,
        suspects=suspects,
        sums={"_seen": F.when(F.col("_end") == _ROSTER, 1).otherwise(0)},
        lasts={"_latest": "_name"},
    )
    found = []
    for i in range(len(asked)):
        upper = (F.col("_ask") == i) & (F.col("_end") == _HIGH)
        lower = (F.col("_ask") == i) & (F.col("_end") == _LOW)
        found.append(F.sum(F.when(upper, F.col("_seen")).when(lower, -F.col("_seen"))).alias(f"_hits_{i}"))
        found.append(F.max(F.when(upper, F.col("_latest"))).alias(f"_hit_{i}"))
    answered = (
        sorted_names.where(F.col("_end") != _ROSTER)
        .select("_row.*", "_ask", "_end", "_seen", "_latest")
        .groupBy(*columns, "_times")
        .agg(*found)
    )
    out = [F.col(c) for c in columns]
    for i, (column, (_, hits)) in enumerate(asked.items()):
        out.append(F.when(F.col(f"_hits_{i}") == 1, F.col(f"_hit_{i}")).alias(column))
        out.append(F.coalesce(f"_hits_{i}", F.lit(0)).alias(hits))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_again")
    return answered.select(*out, again).drop("_again")
