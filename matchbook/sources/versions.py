"""Numbered manifests of a set of tables: a version is complete when its manifest appears, and never changes after.

A manifest is a small JSON file that lists the folders of every table. It is written beside its place and renamed
there, which fails if another writer was first; so a reader that holds a manifest sees one version, and a writer that
dies leaves at most folders that no manifest lists.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class VersionExists(RuntimeError):
    """Another writer has published this version."""


class Manifests:
    """The manifests under ``path``; every path given and returned is relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self._gateway = spark.sparkContext._gateway
        self._hadoop = self._gateway.jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._files = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        """What lies in a folder, sorted; nothing if there is none."""
        place = self._at(folder)
        if not self._files.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(place))

    def exists(self, name: str) -> bool:
        return self._files.exists(self._at(name))

    def read(self, name: str) -> dict:
        stream = self._files.open(self._at(name))
        try:
            return json.loads(self._gateway.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, content: dict, replace: bool = False) -> None:
        """The whole file or nothing; without ``replace``, an existing one stays and raises ``VersionExists``."""
        draft = self._at(f"_drafts/{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        stream.write(bytearray(json.dumps(content, indent=1).encode()))
        stream.close()
        place = self._at(name)
        self._files.mkdirs(place.getParent())
        kind = getattr(self._hadoop, "Options$Rename")
        option = self._gateway.new_array(kind, 1)
        option[0] = kind.valueOf("OVERWRITE" if replace else "NONE")
        context = self._hadoop.FileContext.getFileContext(draft.toUri(), self._conf)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(place), option)
        except Py4JJavaError as error:
            self._files.delete(draft, False)
            if self._files.exists(place):
                raise VersionExists(name) from error
            raise

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.names("_versions") if n.startswith("v") and n.endswith(".json"))

    def version(self, number: int) -> dict:
        return self.read(f"_versions/v{number}.json")

    def publish(self, number: int, content: dict) -> None:
        self.write(f"_versions/v{number}.json", content)
