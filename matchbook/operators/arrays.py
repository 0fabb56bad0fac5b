"""Ordered steps on a whole group held as one array: no shuffle, no window.

A group that is small enough to be one row, such as a text file of a few megabytes, is cut where it is read. Groups of
any size go through ``segment`` and ``scan`` instead; both forms give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Predicate = Callable[[Column], Column]


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body or a lambda inside it uses the value."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def segment_array(items: Column, marker: Predicate, flags: Mapping[str, Predicate]) -> Column:
    """Cut an array into blocks at markers: an array of structs, one per block, linear in the items.

    A block has ``block_id``, ``start`` (its first item's place, from 0), ``items``, ``first_content`` and
    ``last_content`` of the whole array, and one boolean per flag, true if any of its items meets it. Block 0 is what
    lies before the first marker and may be empty; every later block begins with its marker.
    """

    def true(test: Predicate) -> Predicate:
        return lambda item: F.coalesce(test(item), F.lit(False))

    def cut(all_items: Column) -> Column:
        at = F.filter(
            F.transform(all_items, lambda item, i: F.when(true(marker)(item), i)), lambda i: i.isNotNull()
        )
        return bound(at, lambda marks: bound(edges(all_items, marks), lambda spans: blocks(all_items, spans)))

    def edges(all_items: Column, marks: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), marks)
        ends = F.concat(marks, F.array(F.size(all_items)))
        return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a).alias("size")))

    def blocks(all_items: Column, spans: Column) -> Column:
        # A block has content if it holds more than its marker.
        with_content = F.filter(
            F.transform(spans, lambda s, k: F.when(s["size"] > F.when(k > 0, 1).otherwise(0), k)),
            lambda k: k.isNotNull(),
        )
        outer = F.struct(F.array_min(with_content).alias("first"), F.array_max(with_content).alias("last"))

        def block(content: Column) -> Column:
            return F.transform(
                spans,
                lambda s, k: bound(
                    F.slice(all_items, s["start"] + 1, s["size"]),
                    lambda own: F.struct(
                        k.cast("long").alias("block_id"),
                        s["start"].alias("start"),
                        own.alias("items"),
                        content["first"].cast("long").alias("first_content"),
                        content["last"].cast("long").alias("last_content"),
                        *[F.exists(own, true(test)).alias(name) for name, test in flags.items()],
                    ),
                ),
            )

        return bound(outer, block)

    return bound(items, cut)
