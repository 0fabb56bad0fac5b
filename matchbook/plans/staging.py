"""Raw lines -> numbered blocks -> one role per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.functions.text import first_match
from matchbook.operators.arrays import segment_array
from matchbook.operators.chunks import CHUNK, MAX_ROWS, chunk_numbered
from matchbook.operators.segment import segment_blocks
from matchbook.sources.lines import lines_of, split_lines

FILE = "source_file_name"
ROW = "source_file_row_number"
#: How rows meet by file: sorted, which holds for files of any size, or in a table of the hashed rows of one bucket of files.
MERGE, HASH = "merge", "shuffle_hash"

# Line patterns of the input format, anchored because rlike only searches.
MARKER = r"^\*+$"
DIVIDER = r"^-+$"
BATTING_HEADER = r"^.* - (1st|2nd) Innings\s+R\s+B\s+4s\s+6s\s*$"
BOWLING_HEADER = r"^(O|B)\s+(M|D)\s+R\s+W\s+Econ$"
FOW_DATA = r"^([0-9]+-[0-9]+\s*)+$"


def by_file(tables, table: str) -> tuple[DataFrame, str]:
    """The rows of a table, and the column that tells their matches apart: the file, where the rows lie in buckets by it
    (what meets by it and more then needs no shuffle), else the match."""
    rows = tables.by_file(table) if hasattr(type(tables), "by_file") else getattr(tables, table)
    return rows, FILE if FILE in rows.columns else "match_id"


def scorecard_lines(raw: DataFrame) -> DataFrame:
    """The raw table as it is, one row per line."""
    return raw.select("raw_line", FILE, ROW, "loaded_at")


def file_lines(files: DataFrame) -> DataFrame:
    """The same, from whole files (value, file name, loaded_at)."""
    return scorecard_lines(split_lines(files, "value", "raw_line", ROW))


def _batting_header(line: Column) -> Column:
    # The pattern looks for its word at every place of a line: most lines do not have it at all. So with the other patterns
    # below: a plain sign that they need is looked for first.
    return line.contains(" Innings") & line.rlike(BATTING_HEADER)


def _is_marker(line: Column) -> Column:
    return line.contains("*") & F.trim(line).rlike(MARKER)


# What tells the type of a block, looked for in every line of it.
_HEADERS = {
    "_batting": lambda line: _batting_header(line),
    "_bowling": lambda line: line.contains("Econ") & F.trim(line).rlike(BOWLING_HEADER),
}


def _block_type() -> Column:
    """By position first (first and last block with any content line), then by the header line found."""
    return first_match(
        [
            (F.col("is_marker_line"), None),
            (F.col("block_id") == F.col("first_content"), "match_header"),
            (F.col("block_id") == F.col("last_content"), "result"),
            (F.col("_batting"), "batting"),
            (F.col("_bowling"), "bowling"),
        ],
        "unknown",
    )


def file_blocks(files: DataFrame) -> DataFrame:
    """``blocks`` of whole files (value, file name, loaded_at), cut where they are read: no shuffle."""
    cut = segment_array(lines_of(F.col("value")), _is_marker, _HEADERS)
    of_block = files.select(FILE, "loaded_at", F.explode(cut).alias("_block")).select(FILE, "loaded_at", "_block.*")
    return (
        of_block.select("*", F.posexplode("items").alias("_at", "raw_line"))
        .withColumn(ROW, (F.col("start") + F.col("_at") + 1).cast("long"))
        .withColumn("is_marker_line", (F.col("block_id") > 0) & (F.col("_at") == 0))
        .withColumn("block_type", _block_type())
        .select("raw_line", FILE, ROW, "loaded_at", "is_marker_line", "block_id", "block_type")
    )


def blocks(lines: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Add is_marker_line, block_id, block_type (and the internal ``_chunk``) to lines of files of any size."""
    marked = chunk_numbered(lines, [FILE], ROW, max_rows).withColumn(
        "is_marker_line", F.coalesce(_is_marker(F.col("raw_line")), F.lit(False))
    )
    headers = {name: test(F.col("raw_line")) for name, test in _HEADERS.items()}
    cut = segment_blocks(marked, [FILE], [ROW], "is_marker_line", headers)
    return cut.withColumn("block_type", _block_type()).drop("first_content", "last_content", *_HEADERS)


def classified(block_lines: DataFrame) -> DataFrame:
    """Add row_type, the role of the line in its block; NULL for markers and unknown blocks."""
    line, block = F.trim("raw_line"), F.col("block_type")
    batting, bowling = block == "batting", block == "bowling"
    return block_lines.withColumn(
        "row_type",
        first_match(
            [
                (F.col("is_marker_line"), None),
                (F.coalesce(line, F.lit("")) == "", "blank"),
                (line.startswith("-") & line.rlike(DIVIDER), "divider"),
                (block == "match_header", "match_header_data"),
                (block == "result", "result_data"),
                (batting & _batting_header(F.col("raw_line")), "batting_header"),
                (batting & line.ilike("Extras:%"), "extras"),
                (batting & line.ilike("TOTAL:%"), "total"),
                (batting, "batting_data"),
                (bowling & line.contains("Econ") & line.rlike(BOWLING_HEADER), "bowling_header"),
                (bowling & line.ilike("Fall of Wickets:%"), "fow_header"),
                (bowling & line.contains("-") & line.rlike(FOW_DATA), "fow_data"),
                (bowling, "bowling_data"),
            ]
        ),
    )


def of_type(lines: DataFrame, *row_types: str) -> DataFrame:
    return lines.where(F.col("row_type").isin(list(row_types)))


__all__ = ["FILE", "ROW", "MERGE", "HASH", "CHUNK", "by_file", "scorecard_lines", "file_lines", "blocks", "file_blocks", "classified", "of_type"]
