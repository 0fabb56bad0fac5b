"""Line dedup: range-partitioned hashes with a secondary sort, answered by per-document keep bitmaps.

Each line's key is hashed where its document is read; only (hash, document, position) travels. The hashes are
range-partitioned and sorted within a partition by document and position, so a stream over the rows meets the first
document that holds a key before all others; later documents' lines are to be dropped. What comes back to a document
is its keep bitmap, run-length coded, and never text.

A key that a large share of all lines have would fill one range. Such keys are found by counting ranges of hashes
first, and then exactly; there are at most ``RANGES`` of them, so their first documents are summed up before any
shuffle and sent to where the lines are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.store import stored

#: Equal ranges of the 64-bit hash whose rows are counted. A key is hot if it has more rows than an average range.
RANGES = 1 << 16
#: Keys with fewer rows are never hot.
HOT_ROWS = 1000
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column | str) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    column = F.col(text) if isinstance(text, str) else text
    return F.split(F.coalesce(column, F.lit("")), "\n")


def trimmed(line: Column) -> Column:
    """A line without ASCII white space at its ends."""
    return F.btrim(line, F.lit(SPACE))


def key_of(line: Column) -> Column:
    """A trimmed line with A-Z in lower case; ``translate`` looks at one letter at a time, so plain ASCII is spared it."""
    plain = F.octet_length(line) == F.length(line)
    return F.when(plain, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10) -> DataFrame:
    """(h, g, doc, row, pos): 96 bits of hash and the length of each key of at least ``least`` code points.

    ``row`` is a hash of the whole text, which tells rows that share an id apart.
    """
    # The text is hashed below the generator: above it, every line would hash the whole text again.
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("row"), lines_of(text_col).alias("lines"))
    line = trimmed(F.col("line"))
    # Lower case keeps the length, so short lines go before their key is made; both hashes then share one key.
    lines = texts.select("doc", "row", F.posexplode("lines").alias("pos", "line")).where(F.length(line) >= least)
    g = F.shiftleft(F.hash(key_of(line)).cast("long"), 32).bitwiseOR(F.length(line).cast("long"))
    return lines.select(F.xxhash64(key_of(line)).alias("h"), g.alias("g"), "doc", "row", "pos")


def hot_keys(keys: DataFrame, least_rows: int = HOT_ROWS) -> DataFrame:
    """(h, g, first): the keys with more rows than ``least_rows`` and than an average range, and their smallest
    document; null if none has an id. At most ``RANGES`` rows."""
    # A hot key makes its range at least half as large again as the average, or larger than ``least_rows``.
    span = F.shiftright("h", 48)
    spans = stored(keys.groupBy(span.alias("span")).agg(F.count("*").alias("n")), "ranges")
    total = spans.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(least_rows, total // RANGES)
    full = spans.where(F.col("n") > max(least_rows, 3 * total // (2 * RANGES))).select("span")
    some = keys.withColumn("span", span).join(F.broadcast(full), "span", "left_semi")
    sums = some.groupBy("h", "g").agg(F.count("*").alias("n"), F.min("doc").alias("first"))
    return sums.where(F.col("n") > limit).select("h", "g", "first")


def dropped_lines(keys: DataFrame, least_rows: int = HOT_ROWS) -> DataFrame:
    """(doc, row, pos) of the lines whose key an earlier document holds; documents without an id come last, as one."""
    hot = stored(hot_keys(keys, least_rows), "hot_keys")
    # Both lists are bounded by RANGES rows, which is checked by construction: see ``hot_keys``.
    known = keys.join(F.broadcast(hot), ["h", "g"]).where(~F.col("doc").eqNullSafe(F.col("first")))
    rest = keys.join(F.broadcast(hot), ["h", "g"], "left_anti")
    stream = Window.partitionBy("h", "g").orderBy(F.asc_nulls_last("doc"), "pos")
    # The window asks for no other exchange: ranges of (h, g) keep the rows of a key together.
    ranged = rest.repartitionByRange("h", "g").withColumn("first", F.first("doc").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    later = ranged.where(~F.col("doc").eqNullSafe(F.col("first")))
    return known.select("doc", "row", "pos").unionByName(later.select("doc", "row", "pos"))


def edges_of(dropped: Column, n: Column) -> Column:
    """A keep bitmap as the positions where it changes: lines are kept from the first to the second, dropped from
    there to the third, and so on; an even number of positions from 0 to ``n``. ``dropped`` is a sorted column."""
    start = F.filter(dropped, lambda p, i: (i == 0) | (p != F.get(dropped, i - 1) + 1))
    end = F.filter(dropped, lambda p, i: (i == F.size(dropped) - 1) | (p != F.get(dropped, i + 1) - 1))
    inner = F.flatten(F.zip_with(start, end, lambda a, b: F.array(a, b + 1)))
    return F.concat(F.array(F.lit(0)), inner, F.array(n))


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10, least_rows: int = HOT_ROWS
) -> DataFrame:
    """(doc, row, dropped): for every document that loses lines, by its id and a hash of its text, their positions.

    ``edges_of`` makes the bitmap of them, once the number of lines is known. Keys shorter than ``least`` code points
    never lose lines. An empty table gives no rows; further columns are ignored.
    """
    keys = stored(line_keys(docs, id_col, text_col, least), "line_keys")
    drops = dropped_lines(keys, least_rows)
    return drops.groupBy("doc", "row").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))


def with_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with n_lines (long), n_dropped (long) and keep_edges (the run-length coded bitmap, see ``edges_of``).

    A line's key is the line without white space at its ends, A-Z in lower case; a key of enough code points that at
    least two documents hold loses all its lines but those of the smallest id. Documents without an id count as one
    document, after all others. Rows that repeat keep and lose the same lines; rows that share an id but not a text
    are the same document in two parts. Null and empty texts have one empty line. Every row stays; columns of
    ``docs`` with the new names are replaced. An empty table gives no rows.
    """
    new = ("n_lines", "n_dropped", "keep_edges")
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in new])
    maps = keep_bitmaps(docs, id_col, text_col, **options).withColumnsRenamed({"doc": "_doc", "row": "_row"})
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(text_col) == F.col("_row"))
    n = F.size(lines_of(text_col))
    lost = F.coalesce("dropped", F.array().cast("array<int>"))
    return docs.join(maps, same, "left").select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n.cast("long").alias("n_lines"),
        F.size(lost).cast("long").alias("n_dropped"),
        edges_of(lost, n).alias("keep_edges"),
    )


def kept_text(text: str = "text", edges: str = "keep_edges") -> Column:
    """The kept lines of a text, joined again; empty if none is kept."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def joined(lines: Column) -> Column:
        starts = F.filter(edges, lambda e, i: i % 2 == 0)
        ends = F.filter(edges, lambda e, i: i % 2 == 1)
        kept = F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a))
        return F.array_join(F.flatten(kept), "\n")

    # The lines are bound to a name, or they would be split again for every kept run.
    once = F.get(F.transform(F.array(lines_of(text)), joined), F.lit(0))
    return F.when(F.size(edges) == 2, whole).otherwise(once)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with repeated lines taken out; all columns and rows stay (a text may become empty)."""
    maps = with_bitmaps(docs, id_col, text_col, **options)
    text = F.when(F.col(text_col).isNotNull(), kept_text(text_col))
    return maps.withColumn(text_col, text).select(*[f"`{c}`" for c in docs.columns])
