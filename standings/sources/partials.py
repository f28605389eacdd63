"""Sums of a large input kept between runs, so that a run reads only what has changed."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from standings.sources.files import Manifest, delete_folder, file_listing, names_in

UNIT = "_unit"


def _unit(location: Column) -> Column:
    """What is added up by itself: a file's folder if the table is partitioned, else the file."""
    file = F.substring_index(location, "/", -1)
    folder = F.left(location, F.length(location) - F.length(file) - 1)
    return F.when(F.substring_index(folder, "/", -1).contains("="), folder).otherwise(location)


class PartialSums:
    """Partial sums of the Parquet table under ``source``, one set for each of its units.

    A unit is a partition folder, such as a month, or a file of a table without partitions. Its sums are
    kept under a digest of its files' names, lengths and times of change, and of ``settings``. A refresh
    lists the files, reads the units whose digest is new in one pass, and names the sums of all
    units in a new version of a manifest. Sums of units that were changed or are gone are no longer named.
    The kept table has as many rows as the sums of each unit, and units are known to the driver by name.
    """

    def __init__(self, spark: SparkSession, source: str, state: str, schema: StructType, settings: str = ""):
        self.spark, self.source, self.state = spark, source.rstrip("/"), state.rstrip("/")
        self.schema, self.settings = schema, settings
        self.manifest = Manifest(spark, self.state)
        self.files_read: list[str] = []

    def _units(self) -> dict[str, tuple[str, list[str]]]:
        """Digest of each unit: its location, and the paths that read it."""
        line = F.concat_ws("|", "location", "length", "changed")
        listed = file_listing(self.spark, self.source).select(_unit(F.col("location")).alias("unit"), "path", line.alias("line"))
        found = listed.groupBy("unit").agg(F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("line"))), 256).alias("digest"), F.collect_list("path").alias("paths"))
        return {
            hashlib.sha256(f"{self.settings}|{self.schema.simpleString()}|{r['unit']}|{r['digest']}".encode()).hexdigest(): (r["unit"], r["paths"])
            for r in found.collect()
        }

    def refresh(self, summed: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
        """The partial sums of all units. ``summed(rows, keys)`` adds rows up by ``keys`` and its own keys."""
        units, (seen, content) = self._units(), self.manifest.read()
        known = content.get("units", {})
        new = {digest: unit for digest, unit in units.items() if digest not in known}
        folders = {digest: known[digest] for digest in units if digest in known}
        self.files_read = sorted(path for _, paths in new.values() for path in paths)
        schema = content.get("schema")
        if new or schema is None:
            rows = self._rows(self.files_read)
            sums = summed(rows, [UNIT])
            schema = StructType([f for f in sums.schema if f.name != UNIT]).jsonValue()
            run = f"data/{uuid.uuid4().hex}"
            if new:
                name = F.substring(F.sha2(UNIT, 256), 1, 32)
                sums.withColumn(UNIT, name).hint("rebalance", UNIT).write.partitionBy(UNIT).parquet(f"{self.state}/{run}")
            written = set(names_in(self.spark, f"{self.state}/{run}"))
            for digest, (unit, _) in new.items():
                folder = f"{UNIT}={hashlib.sha256(unit.encode()).hexdigest()[:32]}"
                folders[digest] = f"{run}/{folder}" if folder in written else ""
        if folders != known:
            self.manifest.commit(seen, {"schema": schema, "units": folders})
            stay, gone = ({at for each in kept for at in each.get("units", {}).values()} for kept in self.manifest.forget(2))
            for folder in sorted(gone - stay - {""}):
                delete_folder(self.spark, f"{self.state}/{folder}")
        paths = [f"{self.state}/{folder}" for folder in folders.values() if folder]
        schema = StructType.fromJson(schema)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema).withColumn(UNIT, F.lit(""))
        reader = self.spark.read.option("basePath", self.source).schema(self.schema)
        return reader.parquet(*paths).withColumn(UNIT, _unit(F.col("_metadata.file_path")))
