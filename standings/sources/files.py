"""Folders, and small documents in them, in whatever file system Spark reads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, in whatever file system it lies."""
    folder, files = _at(spark, path)
    files.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _at(spark, path)
    return files.exists(folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    folder, files = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table's writer has finished."""
    return exists(spark, f"{path}/_SUCCESS")


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, location, length, changed) of the data files below ``path``, without reading one.

    ``location`` is what ``_metadata.file_path`` says of a file's rows.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    changed = F.unix_micros("modificationTime").alias("changed")
    return listed.select("path", F.col("_metadata.file_path").alias("location"), "length", changed)


class Manifest:
    """A small document in numbered versions; the last complete one counts.

    A version is a file of its own that is created once and never changed, so readers see an old or a new
    document, whole. Two writers that begin from the same version cannot both create the next one.
    A file that its writer left unfinished is passed over.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/_versions"

    def _numbers(self) -> list[int]:
        names = names_in(self.spark, self.folder)
        return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)

    def read(self, number: int | None = None) -> tuple[int, dict]:
        """The last complete version, or that with ``number``; 0 and an empty document without one."""
        for at in self._numbers() if number is None else [number]:
            content = self._content(at)
            if content is not None:
                return at, content
        return 0, {}

    def _content(self, number: int) -> dict | None:
        path, files = _at(self.spark, f"{self.folder}/{number:010d}.json")
        stream = files.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)["content"]
        except (ValueError, KeyError):
            return None

    def commit(self, seen: int, content: dict) -> int:
        """Add the version after all there are, unless another writer was faster than the reader of ``seen``."""
        if self.read()[0] != seen:
            raise RuntimeError(f"{self.folder} has moved on from version {seen}")
        number = max(self._numbers(), default=0) + 1
        path, files = _at(self.spark, f"{self.folder}/{number:010d}.json")
        stream = files.create(path, False)
        try:
            stream.write(bytearray(json.dumps({"content": content}), "utf-8"))
        finally:
            stream.close()
        return number

    def forget(self, keep: int) -> tuple[list[dict], list[dict]]:
        """Drop all but the last ``keep`` versions; returns those that stay and those that went."""
        stay, gone = [], []
        for number in self._numbers():
            content = self._content(number)
            if len(stay) >= keep:
                path, files = _at(self.spark, f"{self.folder}/{number:010d}.json")
                files.delete(path, False)
                gone.append(content or {})
            elif content is not None:
                stay.append(content)
        return stay, gone
