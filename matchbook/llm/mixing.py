"""Mix sources to target weights by capped water-filling.

Every source gets its share of all words by weight, but at most so many epochs of its own; what a clamped
source leaves goes to the others by weight, until none is above its cap. A source then takes whole
repetitions of all its documents and, for the rest of its target, one more repetition of the first documents
in a seeded random order. The last of these is taken in part, so a source meets its target to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.store import stored
from matchbook.llm.words import WORD

EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 42


def size_of(text: str | Column) -> Column:
    """The number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def order_of(doc_id: str, seed: int, text: str) -> Column:
    """32 hex digits that put documents in a random order, the same on every run; by the text where there is no id."""
    unnamed = F.concat(F.lit("null "), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), unnamed)))


def ranked(sources: DataFrame, column: str) -> DataFrame:
    """Add ``rank`` (from 0) by the column, null last, without bringing all rows to one task."""
    dealt = sources.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("pid", F.spark_partition_id())
    dealt = stored(dealt, "dealt")
    before = F.coalesce(F.sum("n").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = dealt.groupBy("pid").agg(F.count("*").alias("n")).select("pid", before.alias("offset"))
    own = F.row_number().over(Window.partitionBy("pid").orderBy(F.col(column).asc_nulls_last())) - 1
    return dealt.withColumn("own", own).join(offsets, "pid").withColumn("rank", F.col("own") + F.col("offset")).drop("pid", "own", "offset")


def water_level(sources: DataFrame, epochs: int) -> float | None:
    """Words for one unit of weight among the sources that are not clamped; None: nothing to share.

    Each round is one aggregate over the sources (n words, weight w). Clamping raises the level, which can
    clamp further sources, so the rounds end when the level stays.
    """
    total = sources.agg(F.sum("n")).first()[0]
    if not total:
        return None
    level = -1.0
    while True:
        clamped = F.lit(level) * F.col("w") > epochs * F.col("n")
        taken, free = sources.agg(
            F.sum(F.when(clamped, epochs * F.col("n")).otherwise(0)), F.sum(F.when(clamped, 0).otherwise(F.col("w")))
        ).first()
        new = (total - taken) / free
        if new == level:
            return level
        level = new


def shares(docs: DataFrame, id_col: str, source_col: str, text_col: str, weights: tuple, epochs: int, seed: int) -> DataFrame:
    """One row per source: n, target, whole repetitions, and where in the random order the last one ends."""
    counts = stored(
        docs.select(
            F.col(source_col).alias("_source"),
            F.conv(F.substring(order_of(id_col, seed, text_col), 1, 3), 16, 10).cast("int").alias("bucket"),
            size_of(text_col).alias("size"),
        )
        .groupBy("_source", "bucket")
        .agg(F.sum("size").alias("size")),
        "buckets",
    )
    sources = ranked(counts.groupBy("_source").agg(F.sum("size").alias("n")), "_source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(sources.withColumn("w", weight), "sources")
    level = water_level(sources, epochs)
    cap = (epochs * F.col("n")).cast("double")
    filled = F.lit(level) * F.col("w")
    target = F.lit(0.0) if level is None else F.when(filled > cap, cap).otherwise(filled)
    goals = (
        sources.withColumn("target", target)
        .withColumn("whole", F.when(F.col("n") > 0, F.floor(F.col("target") / F.col("n"))).otherwise(0).cast("long"))
        .withColumn("rest", F.round("target").cast("long") - F.col("whole") * F.col("n"))
    )
    # The buckets of a source are at most 4096 rows, whatever its size. The last repetition ends in the first bucket
    # whose running sum reaches the rest.
    up_to = F.sum("size").over(Window.partitionBy("_source").orderBy("bucket"))
    ends = (
        counts.withColumn("up_to", up_to)
        .join(goals.select(F.col("_source").alias("s"), "rest"), F.col("_source").eqNullSafe(F.col("s")))
        .where(F.col("up_to") >= F.col("rest"))
        .groupBy("s")
        .agg(F.min("bucket").alias("edge"), F.min_by(F.col("up_to") - F.col("size"), "bucket").alias("before"))
    )
    return goals.join(ends, F.col("_source").eqNullSafe(F.col("s"))).select(
        "_source", "n", "target", "whole", "rest", "edge", "before"
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple = WEIGHTS,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Add size, source_size, target and taken (words the mix takes of the row, repetitions counted).

    Sources weigh ``weights`` by rank in code point order, null last as a source of its own. Null and empty
    texts have size 0 and nothing is taken of them. Rows that repeat count each; rows of one id follow each
    other in the random order, the smaller first; rows without an id have their place by their text. An empty table gives no rows. Columns of ``docs`` with the
    new names are replaced.
    """
    new = ("size", "source_size", "target", "taken", "whole")
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in new])
    goals = stored(shares(docs, id_col, source_col, text_col, weights, epochs, seed), "shares")
    rows = docs.withColumn("_order", order_of(id_col, seed, text_col)).withColumn(
        "_bucket", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int")
    )
    rows = rows.join(goals, F.col(source_col).eqNullSafe(F.col("_source")))
    far = rows.where(F.col("_bucket") != F.col("edge")).withColumn("size", size_of(text_col))
    far = far.withColumn("_more", F.when(F.col("_bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0).cast("long")))
    # Only the bucket in which the last repetition ends needs its documents in order: 1 in 4096 of a source.
    near = rows.where(F.col("_bucket") == F.col("edge")).withColumn("size", size_of(text_col))
    by = Window.partitionBy("_source").orderBy("_order", "size", F.xxhash64(text_col))
    past = F.coalesce(F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("before")
    near = near.withColumn("_more", F.greatest(F.lit(0), F.least("size", F.col("rest") - past)).cast("long"))
    taken = F.col("whole") * F.col("size") + F.col("_more")
    return far.unionByName(near).select(
        *[f"`{c}`" for c in docs.columns], "size", F.col("n").alias("source_size"), "target", taken.alias("taken"), "whole"
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each as often as it is taken whole, and the one taken in part cut after its words.

    A text without words is repeated as often as its source takes all documents. A cut text has one space
    between words; its n_chars is counted anew.
    """
    columns = docs.columns
    taken = mix(docs, **options)
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.col("whole")).cast("int")
    cuts = F.concat(
        F.array_repeat(F.lit(None).cast("long"), times), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<long>"))
    )
    copies = taken.withColumn("_cut", F.explode(cuts))
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), F.lit(1), F.col("_cut").cast("int"))
    copies = copies.withColumn("text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(words, " ")))
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        counted = F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        copies = copies.withColumn("n_chars", counted)
    return copies.select(*[f"`{c}`" for c in columns])
