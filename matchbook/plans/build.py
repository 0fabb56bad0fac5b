"""All tables of one corpus, each computed from stored upstream tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from matchbook.operators.chunks import MAX_ROWS
from matchbook.plans import entities, marts, staging
from matchbook.schemas import COLUMNS, as_table
from matchbook.sources.lines import read_files

TABLES = list(COLUMNS)
RAW = "scorecard_lines"
# The one table that holds the text. It is stored by the role of the line, so that each reader opens only its lines;
# the blocks are a view of it, and so are the raw lines where the input is not at hand.
LINES = "stg_row_classification"
VIEWS = {RAW: ["raw_line", "source_file_name", "source_file_row_number", "loaded_at"], "stg_blocks": None}
# Tables in dependency order; those of one wave do not read each other.
WAVES = [
    [LINES],
    ["stg_blocks"],
    ["int_match_header", "int_result", "int_innings_totals"],
    ["int_batting_rows", "int_bowling_rows", "int_fow_rows", "dim_team"],
    [
        "int_partnerships",
        "int_fielding_dismissals",
        "int_batting_match_factor",
        "int_bowling_match_factor",
        "dim_player",
        "dim_match",
    ],
    ["fact_batting", "fact_bowling", "fact_fow", "fact_partnership", "fact_fielding"],
    ["fact_player_match_summary", "fact_team_match_summary"],
]


#: Files that a task writes at once; rows for more are sorted first.
OPEN_FILES = 32


class Scorecards:
    """The model tables over raw lines (``raw``), whole files (``files``) or both, stored under ``path``.

    Whole files (value, source_file_name, loaded_at) are cut into classified lines where they are read, without a
    shuffle; lines of files of any size are cut by windows over bounded pieces. Both give the same rows.

    ``frame(table)`` is the table as a lazy frame over its stored inputs. ``stored(table)`` writes
    it once and reads it back. Storing each table as it is first needed cuts the lineage: later
    plans stay small, a lost executor only repeats work on one table, and the line parsing is done
    once rather than once per reader.

    With ``buckets``, tables whose rows come from one file are stored in so many buckets of whole files (catalog tables
    over the same folders), so that what meets by file is not shuffled again. Facts do not name the file, but keep its
    name in their folder: ``by_file(table)`` shows it. For many files, each much smaller than a bucket.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        raw: DataFrame | None = None,
        max_rows: int = MAX_ROWS,
        files: DataFrame | None = None,
        buckets: int | None = None,
    ):
        self.spark = spark
        self.path = path
        self.raw = raw
        self.files = files
        self.max_rows = max_rows
        self.buckets = buckets
        self.meet = staging.HASH if buckets else staging.MERGE
        if buckets:  # rows dealt by file also meet by file and more without another shuffle
            spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
            # A task reads a bucket, not as much as fits a split: well compressed text unpacks to many times its size.
            spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
            # A task writes one bucket, by the role of the line at most: its few files are open together, and no row is sorted.
            spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
        self._catalog: dict[str, str] = {}
        self._done: dict[str, DataFrame] = {}
        self._by_file: dict[str, DataFrame] = {}

    @classmethod
    def of_folder(cls, spark: SparkSession, path: str, source: str, **sizes: int) -> "Scorecards":
        """Over the text files below ``source``: small ones as whole files, large ones as lines."""
        files, raw = read_files(spark, source, **sizes)
        return cls(spark, path, raw, files=files)

    @property
    def has_input(self) -> bool:
        """Whether there are lines or files to build from; not where an earlier build is opened."""
        return self.raw is not None or self.files is not None

    def folder(self, table: str) -> str:
        return f"{self.path}/{table}"

    def stored(self, table: str) -> DataFrame:
        if table in self._done:
            return self._done[table]
        if table == "stg_blocks":
            return self.stored(LINES).select(*COLUMNS[table])
        if table == RAW and LINES in self._done:
            # Numbered from the input again: a view of what was made of the lines could not tell that some are missing.
            return self.frame(RAW) if self.has_input else self.stored(LINES).select(*VIEWS[RAW])
        target, made = self.folder(table), self._made(table)
        in_buckets = self.buckets and staging.FILE in made.columns
        frame = made if in_buckets or table == RAW else as_table(made, table)
        writer = (frame.repartition(self.buckets, staging.FILE) if in_buckets else frame).write.mode("overwrite")
        writer = writer.partitionBy("row_type") if table == LINES else writer
        if in_buckets:
            self._catalog[table] = f"matchbook_{table}_{uuid4().hex}"
            writer.bucketBy(self.buckets, staging.FILE).option("path", target).saveAsTable(self._catalog[table])
        else:
            writer.parquet(target)
        read = self._read(table, frame.schema)
        if in_buckets:
            self._by_file[table] = read
        self._done[table] = read if table == RAW else as_table(read, table)
        return self._done[table]

    def by_file(self, table: str) -> DataFrame:
        """The stored table, with the name of the file also where it is no column of the table, if it lies in buckets
        by it. Rows that meet by file and more then need no shuffle."""
        plain = self.stored(table)
        return self._by_file.get(table, plain)

    def _read(self, table: str, schema: StructType) -> DataFrame:
        if table in self._catalog:
            return self.spark.table(self._catalog[table]).select(*schema.names)
        return self.spark.read.schema(schema).parquet(self.folder(table)).select(*schema.names)

    def frame(self, table: str) -> DataFrame:
        made = self._made(table)
        return made if table == RAW else as_table(made, table)

    def _made(self, table: str) -> DataFrame:
        """What is stored: the table, with the name of the file where the plan has it."""
        if table == RAW:
            return self._of_input(staging.scorecard_lines, staging.file_lines)
        return self._models()[table]()

    def _of_input(
        self, of_lines: Callable[[DataFrame], DataFrame], of_files: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """What is made of the lines and of the whole files, together."""
        parts = [(self.raw, of_lines), (self.files, of_files)]
        return reduce(DataFrame.unionByName, [make(frame) for frame, make in parts if frame is not None])

    def _lines(self) -> DataFrame:
        if RAW in self._done:
            return staging.classified(staging.blocks(self._done[RAW], self.max_rows))
        columns = COLUMNS["stg_blocks"]
        blocks = self._of_input(
            lambda raw: staging.blocks(staging.scorecard_lines(raw), self.max_rows).select(*columns), staging.file_blocks
        )
        return staging.classified(blocks)

    def build(self) -> "Scorecards":
        """Write every table in dependency order (a full refresh).

        The tables of a wave are independent jobs and are submitted together, so that the short
        ones do not leave executors idle.
        """
        for wave in WAVES:
            with ThreadPoolExecutor(len(wave)) as jobs:
                list(jobs.map(self.stored, wave))
        return self

    def forget(self) -> None:
        """Drop the catalog entries of the bucketed tables; their folders stay."""
        for name in self._catalog.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def open(self) -> "Scorecards":
        """Use the tables an earlier build left under ``path``."""
        for table in TABLES:
            if table not in VIEWS:
                self._done[table] = self.spark.read.parquet(self.folder(table)).select(*COLUMNS[table])
        return self

    def __getattr__(self, table: str) -> DataFrame:
        if table in COLUMNS or table == RAW:
            return self.stored(table)
        raise AttributeError(table)

    def _models(self) -> dict[str, Callable[[], DataFrame]]:
        t, n, lines, meet = self, self.max_rows, LINES, self.meet
        return {
            "stg_blocks": lambda: t.stored("stg_blocks"),
            lines: self._lines,
            "int_match_header": lambda: entities.match_header(t.stored(lines)),
            "int_result": lambda: entities.result(t.stored(lines)),
            "int_innings_totals": lambda: entities.innings_totals(t.stored(lines), n),
            "int_batting_rows": lambda: entities.batting_rows(t.stored(lines), t.int_innings_totals, n, meet),
            "int_bowling_rows": lambda: entities.bowling_rows(
                t.stored(lines), t.int_innings_totals, t.int_match_header, n, meet
            ),
            "int_fow_rows": lambda: entities.fow_rows(t.stored(lines), t.int_innings_totals, meet),
            "int_partnerships": lambda: entities.partnerships(
                t.int_innings_totals, t.int_batting_rows, t.int_fow_rows, n, meet
            ),
            "int_fielding_dismissals": lambda: entities.fielding_dismissals(
                t.int_batting_rows, t.int_match_header, t.int_bowling_rows, n, meet
            ),
            "int_batting_match_factor": lambda: entities.batting_match_factor(t.int_batting_rows, meet),
            "int_bowling_match_factor": lambda: entities.bowling_match_factor(t.int_bowling_rows, meet),
            "dim_team": lambda: marts.dim_team(t.int_match_header),
            "dim_player": lambda: marts.dim_player(t.int_batting_rows, t.int_bowling_rows, t.int_result),
            "dim_match": lambda: marts.dim_match(
                t.int_match_header, t.int_result, t.dim_team, meet=meet
            ),
            "fact_batting": lambda: marts.fact_batting(
                t.int_batting_rows,
                t.dim_match,
                t.dim_team,
                t.int_innings_totals,
                t.int_batting_match_factor,
                meet,
            ),
            "fact_bowling": lambda: marts.fact_bowling(
                t.int_bowling_rows,
                t.dim_match,
                t.dim_team,
                t.int_innings_totals,
                t.int_bowling_match_factor,
                meet,
            ),
            "fact_fow": lambda: marts.fact_fow(t.int_fow_rows, t.dim_match, t.dim_team, meet),
            "fact_partnership": lambda: marts.fact_partnership(t.int_partnerships, t.dim_match, t.dim_team, meet),
            "fact_fielding": lambda: marts.fact_fielding(
                t.int_fielding_dismissals, t.dim_match, t.dim_team, meet
            ),
            "fact_player_match_summary": lambda: marts.fact_player_match_summary(
                t.by_file("fact_batting"),
                t.by_file("fact_bowling"),
                t.by_file("fact_fielding"),
                t.int_batting_match_factor,
                t.int_bowling_match_factor,
                t.dim_match,
                self.buckets,
                meet,
            ),
            "fact_team_match_summary": lambda: marts.fact_team_match_summary(
                t.int_innings_totals,
                t.int_bowling_rows,
                t.by_file("fact_batting"),
                t.by_file("fact_bowling"),
                t.dim_match,
                t.dim_team,
                meet,
            ),
        }
