"""Versions of a table: what its readers see changes from one moment to the next.

A version is a small JSON file that names the folders that belong to it. It is written under
a name of its own and then renamed to its number, which fails where that version exists, so of
two writers one wins and the other begins again. Readers take the highest number. The files go
through the file system of the folder's address; its rename must be atomic, as those of local
and HDFS folders are.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class StaleVersion(RuntimeError):
    """Another writer has made this version first."""


class Manifest:
    """The versions kept under ``folder``; at most ``keep`` of them."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 3) -> None:
        self.spark, self.folder, self.keep = spark, folder, keep
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path(folder).getFileSystem(self._conf)

    def _name(self, version: int) -> str:
        return f"{self.folder}/v{version:010d}.json"

    def versions(self) -> list[int]:
        """Numbers of the versions there are, ascending."""
        folder = self._path(self.folder)
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def read(self, version: int | None = None) -> tuple[int, dict]:
        """Number and contents of a version, the latest by default; 0 and nothing before the first."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return 0, {}
        stream = self._files.open(self._path(self._name(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return version, json.loads(text)

    def commit(self, after: int, contents: dict) -> int:
        """Make ``contents`` the version after ``after``; raises :class:`StaleVersion` where there is one."""
        made = self._path(f"{self.folder}/.{uuid.uuid4().hex}")
        out = self._files.create(made, False)
        try:
            out.write(bytearray(json.dumps(contents, sort_keys=True).encode()))
        finally:
            out.close()
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(options, 0)
        target = self._files.makeQualified(self._path(self._name(after + 1)))
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(self._files.makeQualified(made), target, none)
        except Py4JJavaError as error:
            self._files.delete(made, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise StaleVersion(f"version {after + 1} of {self.folder} exists") from None
            raise
        return after + 1

    def forget(self) -> list[dict]:
        """Remove all but the last versions; returns what the removed ones held."""
        gone = []
        for version in self.versions()[: -self.keep]:
            gone.append(self.read(version)[1])
            self._files.delete(self._path(self._name(version)), False)
        return gone

    def remove(self, folder: str) -> None:
        """Remove a folder that no version names any more."""
        self._files.delete(self._path(folder), True)
