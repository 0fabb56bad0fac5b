"""One query per model table over the rendered reports."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchbook.bindings.cards import render
from matchbook.bindings.cards_oracle import expected
from matchbook.plans.build import RAW, Scorecards
from matchbook.plans.staging import FILE, ROW
from matchbook.schemas import COLUMNS
from matchbook.session import shared_dir
from matchbook.sources.tables import table

#: Reports in a bucket, about 400,000 lines.
BUCKET_REPORTS = 5_000
_CORPORA: dict[tuple[str, str], Scorecards] = {}
# Text the oracle does not hold, and the load time.
_NOT_COMPARED = {"raw_line", "loaded_at"}


def corpus(spark: SparkSession, folder: str) -> Scorecards:
    """The rendered reports of a folder, stored once per application in the shared folder, as are the tables."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _CORPORA:
        path = f"{shared_dir(spark)}/cards-{uuid4().hex}"
        tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        buckets = max(1, tasks, -(-table(spark, folder, "customer").count() // BUCKET_REPORTS))
        reports, name = render(spark, folder, buckets), f"matchbook_reports_{uuid4().hex}"
        written = reports.repartition(buckets, FILE).write.bucketBy(buckets, FILE)
        written.option("path", f"{path}/reports").saveAsTable(name)
        _CORPORA[key] = Scorecards(spark, path, files=spark.table(name), buckets=buckets)
    return _CORPORA[key]


def plain(df: DataFrame) -> DataFrame:
    """Comparable types: whole numbers as long, decimals as double."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("long")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        out.append(column.alias(field.name))
    return df.select(*out)


def compared(name: str) -> list[str]:
    return [c for c in COLUMNS[name] if c not in _NOT_COMPARED]


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(corpus(spark, folder).frame(name).select(*compared(name)))

    return run


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lines as they are loaded: every line of every report once, numbered, with its load time."""
    return corpus(spark, folder).frame(RAW).select(FILE, ROW, "loaded_at")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {RAW: lines} | {f"scorecard_{name}": _model(name) for name in COLUMNS}


def oracle_sql() -> dict[str, str]:
    loaded = "TIMESTAMP '2026-09-01 03:00:00' AS loaded_at"
    return {RAW: expected(f"SELECT source_file_name, source_file_row_number, {loaded} FROM stg_lines")} | {
        f"scorecard_{name}": expected(f"SELECT {', '.join(compared(name))} FROM {name}")
        for name in COLUMNS
    }
