"""Sets of tables that change all at once.

A run writes its tables into a version folder of its own. Only when all of them are there, one small file names them; readers take the newest such file. So a run that
is ended in the middle leaves what was there before, and readers that are under way keep their files. The name is written aside and renamed, as a file that is seen is
whole then.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


class Publication:
    """The published sets of tables under a folder: ``versions/<number>-<run>/...`` and ``published/<number>.json``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.folder}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("published") if n.endswith(".json")]

    def _tables(self, number: int) -> dict[str, str]:
        stream = self._fs.open(self._path(f"{self.folder}/published/{number:06d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> dict[str, str]:
        """Path of every table of the newest set; empty before the first."""
        numbers = self._numbers()
        return {name: f"{self.folder}/{path}" for name, path in self._tables(numbers[-1]).items()} if numbers else {}

    def folders(self, path: str) -> list[str]:
        """The names in a folder of this publication."""
        return self._names(path.removeprefix(f"{self.folder}/"))

    def begin(self) -> str:
        """A fresh version folder to write into."""
        number = max([0, *self._numbers()]) + 1
        return f"{self.folder}/versions/{number:06d}-{uuid.uuid4().hex[:8]}"

    def publish(self, tables: Mapping[str, str], keep: int = 2) -> None:
        """Make ``tables`` (name to path, all under this folder) the newest set, and delete versions that none of the ``keep`` newest sets names.

        Versions that were begun later than the oldest of these are left alone: they may still be written.
        """
        number = max([0, *self._numbers()]) + 1
        inside = {name: path.removeprefix(f"{self.folder}/") for name, path in tables.items()}
        aside, final = self._path(f"{self.folder}/published/.{uuid.uuid4().hex}"), self._path(f"{self.folder}/published/{number:06d}.json")
        stream = self._fs.create(aside, False)
        stream.write(json.dumps(inside, indent=1).encode())
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(aside, final):
            raise RuntimeError(f"another run has published {final} meanwhile")
        numbers = self._numbers()
        kept = numbers[-keep:]
        named = {path.split("/")[1] for n in kept for path in self._tables(n).values()}
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{self.folder}/published/{n:06d}.json"), False)
        for version in self._names("versions"):
            if version not in named and int(version.split("-")[0]) < kept[0]:
                self._fs.delete(self._path(f"{self.folder}/versions/{version}"), True)
