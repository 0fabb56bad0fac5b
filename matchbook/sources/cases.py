"""A table of cases that grows by appending: each case once, however often it is sent."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchbook.sources.versions import Manifests, VersionExists

KEY, BATCH = "case_key", "batch"


def case_key(columns: list[str]) -> Column:
    """A digest of the whole case; fields that are NULL and fields that are empty differ."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


class Cases:
    """Cases under ``path``, in complete versions (see ``versions``): one folder for each append that added any.

    A case is all its columns; of equal cases one is kept, with the number of the first append that had it. Appending
    the same frame again, after a lost job too, adds nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.manifests = Manifests(spark, path)

    def _latest(self) -> tuple[int, list[str], dict[str, str]]:
        numbers = self.manifests.versions()
        if not numbers:
            return 0, [], {}
        held = self.manifests.version(numbers[-1])
        return numbers[-1], held["folders"], held["types"]

    def _of(self, folders: list[str], types: dict[str, str]) -> DataFrame:
        schema = ", ".join(f"`{name}` {kind}" for name, kind in types.items())
        return self.spark.read.schema(schema).parquet(*[f"{self.manifests.path}/{f}" for f in folders])

    def append(self, cases: DataFrame) -> int:
        """Add the cases that are not there yet and return the number of the version that holds them all.

        Only the keys of the older cases are read. A writer that finds its version taken looks again at what is new.
        """
        columns = cases.columns
        keyed = cases.withColumn(KEY, case_key(columns)).dropDuplicates([KEY])
        while True:
            number, folders, types = self._latest()
            new = keyed.withColumn(BATCH, F.lit(number + 1))
            if types and types != dict(new.dtypes):
                raise ValueError(f"the cases have {types}, not {dict(new.dtypes)}")
            if folders:
                new = new.join(self._of(folders, types).select(KEY), KEY, "left_anti").select(*columns, KEY, BATCH)
            folder = f"data/{uuid.uuid4().hex}"
            new.write.parquet(f"{self.manifests.path}/{folder}")
            content = {"folders": [*folders, folder], "types": dict(new.dtypes)}
            if folders and self._of([folder], content["types"]).isEmpty():
                self.manifests.delete(folder)
                return number
            try:
                self.manifests.publish(number + 1, content)
                return number + 1
            except VersionExists:
                self.manifests.delete(folder)

    def read(self) -> DataFrame:
        """All cases of the latest version, with ``case_key`` and ``batch``."""
        number, folders, types = self._latest()
        if not number:
            raise ValueError(f"no cases under {self.manifests.path}")
        return self._of(folders, types)
