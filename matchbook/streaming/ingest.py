"""Load each text file once, as it arrives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchbook.schemas import RAW_LINES
from matchbook.sources.lines import (
    WHOLE_FILE_BYTES,
    large_files,
    scan_text,
    small_files,
    with_load_time,
)

# Files older than this against the newest one would be passed over.
FOREVER = "100000d"
OnBatch = Callable[[DataFrame, str], None]


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    on_batch: OnBatch | None = None,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    files_per_batch: int = 10_000,
) -> None:
    """Append the lines of files not loaded before to the raw table at ``target``, then stop.

    The stream's checkpoint remembers loaded files. Each micro-batch overwrites its own folder, so
    a batch repeated after a failure leaves no duplicates and a failed one no partial rows. Small
    and large files are separate streams because they are numbered differently; the size test is
    part of each stream's plan, so a stream opens only its own files. A file counts however old
    it is when it arrives. ``on_batch``
    receives the written lines of a batch and a name that is the same when it is repeated.
    """
    for kind, whole, numbered in (("small", True, small_files), ("large", False, large_files)):

        def land(batch: DataFrame, batch_id: int, kind=kind, numbered=numbered) -> None:
            name = f"{kind}-{batch_id}"
            folder = f"{target}/batch={name}"
            lines = with_load_time(numbered(batch, whole_file_bytes))
            lines.write.mode("overwrite").parquet(folder)
            if on_batch is not None:
                written = batch.sparkSession.read.schema(RAW_LINES).parquet(folder)
                if not written.isEmpty():
                    on_batch(written, name)

        reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", FOREVER)
        own = F.col("_size") <= whole_file_bytes if whole else F.col("_size") > whole_file_bytes
        query = (
            scan_text(reader, source, whole)
            .where(own)
            .writeStream.foreachBatch(land)
            .option("checkpointLocation", f"{checkpoint}/{kind}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def raw_table(spark: SparkSession, target: str) -> DataFrame:
    """The raw line table that ``ingest`` fills."""
    return spark.read.schema(RAW_LINES).option("recursiveFileLookup", "true").parquet(target)
