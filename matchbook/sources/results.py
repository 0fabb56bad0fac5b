"""Results that are kept and read again while their inputs stay as they are."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from matchbook.sources.versions import Manifests, VersionExists


class Results:
    """Results under ``path``, each found by what is asked and by the files it was made of.

    The key is a digest of the optimised plan in canonical form, the names and types of the result, and for every scan,
    in the order of the plan, each file with its size and time. A result of anything but files, such as rows given by
    the driver, is not kept. The driver looks at one entry per input file, as it does to plan the scan.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.manifests = Manifests(spark, path)

    def key(self, frame: DataFrame) -> str | None:
        """The digest by which the result of the frame is kept; None if it cannot be."""
        plan = frame._jdf.queryExecution().optimizedPlan()
        leaves, scans = plan.collectLeaves(), []
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if leaf.getClass().getSimpleName() != "LogicalRelation":
                return None
            relation = leaf.relation()
            if relation.getClass().getSimpleName() != "HadoopFsRelation":
                return None
            files = relation.location().allFiles()
            status = [files.apply(k) for k in range(files.size())]
            scans.append(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in status))
        if not scans or not plan.deterministic():
            return None
        asked = plan.canonicalized().treeString(True, False, 2**31 - 1, False, False)
        return hashlib.sha256(repr((asked, frame.dtypes, scans)).encode()).hexdigest()

    def reload(self, frame: DataFrame) -> DataFrame:
        """The result of the frame: read if it is kept, else made, kept and read.

        What is written appears only when it is complete; of two writers of one result the first stays.
        """
        key = self.key(frame)
        if key is None:
            return frame
        entry = f"{key}.json"
        if not self.manifests.exists(entry):
            folder = f"data/{uuid.uuid4().hex}"
            frame.write.parquet(f"{self.manifests.path}/{folder}")
            try:
                self.manifests.write(entry, {"folder": folder})
            except VersionExists:
                self.manifests.delete(folder)
        folder = self.manifests.read(entry)["folder"]
        return self.spark.read.schema(frame.schema).parquet(f"{self.manifests.path}/{folder}")
