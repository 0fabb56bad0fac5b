"""Text files as numbered lines, without gathering a large file in one place."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from matchbook.functions.text import col_of
from matchbook.session import stored

# A whole file this size is still a small row; larger files are read in splits.
WHOLE_FILE_BYTES = 4 * 1024 * 1024
PATTERN = "*.txt"
_COLUMNS = ["raw_line", "source_file_name", "source_file_row_number"]


def lines_of(text: Column | str) -> Column:
    """The lines of a text as an array: blanks kept, any line ending, none after the last."""
    value, newline = col_of(text), F.lit("\n")
    # Plain replacements and a split at one character: a pattern would be tried at every place of the text.
    one_ending = F.replace(F.replace(value, F.lit("\r\n"), newline), F.lit("\r"), newline)
    ended = F.when(F.contains(value, F.lit("\r")), one_ending).otherwise(value)
    without = F.substr(ended.cast("binary"), F.lit(1), F.octet_length(ended) - 1).cast("string")
    return F.split(F.when(F.endswith(ended, newline), without).otherwise(ended), "\n", -1)


def split_lines(df: DataFrame, text: str, line: str, number: str) -> DataFrame:
    """One row per line of a text column: 1-based number, blanks kept, any line ending."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(lines_of(F.col(text))).alias("_at", line)).select(
        *others, line, (F.col("_at") + 1).cast("long").alias(number)
    )


def base_folder(path: str) -> str:
    """The folder that names are relative to: the part before any pattern, or the folder of a single file."""
    plain = re.split(r"[*?\[{]", path, maxsplit=1)[0]
    if plain != path or path.endswith(PATTERN[1:]):
        plain = plain.rpartition("/")[0]
    return plain.rstrip("/").split(":", 1)[-1].lstrip("/")


def _relative(path: str) -> Column:
    """File name below the folder, the same however the path was written. Paths arrive percent-encoded."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.substring_index(decoded, f"/{base_folder(path)}/", -1)


def scan_text(reader: DataFrameReader | DataStreamReader, path: str, whole: bool) -> DataFrame:
    """Lines (or whole files) with the file's name, size, and where the split starts."""
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", PATTERN)
    return reader.text(path, wholetext=whole).select(
        "value",
        _relative(path).alias("source_file_name"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_start"),
    )


def number_splits(lines: DataFrame) -> DataFrame:
    """Number the lines of files read in splits.

    A task reads a split in file order, so the distance from the split's first row is the line's
    place in the split; the lines of earlier splits of the same file are added. The lines are stored
    once with their order, and so is the table of offsets, one row per split: the text files are read
    once, and whatever is read again, by a repeated task too, has the same numbers. Offsets of a size
    that Spark broadcasts leave the lines where they are. Without lines nothing is stored.
    """
    number = (F.col("_id") - F.col("_first") + F.col("_skip") + 1).alias("source_file_row_number")
    columns = [c for c in lines.columns if c not in ("_path", "_start", "_size")]
    if lines.isEmpty():
        return lines.select(*columns, F.lit(None).cast("long").alias("source_file_row_number"))
    placed = stored(lines.drop("_size").withColumn("_id", F.monotonically_increasing_id()))
    joined = placed.join(split_offsets(placed), ["_path", "_start"])
    return joined.select(*columns, number)


def split_offsets(placed: DataFrame) -> DataFrame:
    """One stored row per split: file, start, its first row's place in the order, and the lines of earlier splits."""
    splits = placed.groupBy("_path", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    return stored(splits.withColumn("_skip", F.coalesce(F.sum("_lines").over(earlier), F.lit(0))).drop("_lines"))


def whole_files(scan: DataFrame, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """(value, source_file_name): the text of each file up to the size limit that is not empty."""
    kept = scan.where((F.col("_size") <= whole_file_bytes) & (F.length("value") > 0))
    # Reading by lines drops a byte-order mark, so reading whole files does too.
    return kept.select(F.regexp_replace("value", "^\\uFEFF", "").alias("value"), "source_file_name")


def small_files(scan: DataFrame, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Whole files up to the size limit, split and numbered where they are read."""
    files = whole_files(scan, whole_file_bytes)
    return split_lines(files, "value", "raw_line", "source_file_row_number").select(*_COLUMNS)


def large_files(scan: DataFrame, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Lines of the files above the limit, numbered over their splits."""
    kept = scan.where(F.col("_size") > whole_file_bytes)
    return number_splits(kept).withColumnRenamed("value", "raw_line").select(*_COLUMNS)


def with_load_time(lines: DataFrame) -> DataFrame:
    return lines.withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))


def read_files(
    spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """The files below ``path`` by size: (value, source_file_name, loaded_at) for the small ones, lines for the rest."""
    small = whole_files(scan_text(spark.read, path, True), whole_file_bytes)
    large = large_files(scan_text(spark.read, path, False), whole_file_bytes)
    return with_load_time(small), with_load_time(large)


def read_lines(spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """The raw line table of every ``.txt`` file below ``path``.

    Files up to ``whole_file_bytes`` are one row each and are numbered where they are read, with
    no shuffle. Larger files are read in splits by many tasks, as soon as this is called. The size test is on file metadata,
    so each scan only opens its own files.
    """
    small = small_files(scan_text(spark.read, path, True), whole_file_bytes)
    large = large_files(scan_text(spark.read, path, False), whole_file_bytes)
    return with_load_time(small.unionByName(large))
