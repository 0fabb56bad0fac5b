"""Tables written between jobs, in the folder that all executors share."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from matchbook.session import shared_dir


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame under ``spark.checkpoint.dir`` and read it back.

    A lost executor then repeats only what follows, and every later reader sees the same rows.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def share(spark: SparkSession, model: Any) -> Broadcast:
    """Send a model of bounded size to the executors, with its class; ``shared`` unpacks it there."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def shared(sent: Broadcast) -> Any:
    return pickle.loads(sent.value)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``most_bytes`` of the column, or one row."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
