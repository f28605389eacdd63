"""Tables written once and read many times within a run."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standings.sources.files import delete_folder, file_listing, is_complete

# Counts up whenever what a staged table holds changes.
LAYOUT = 1


class Workspace:
    """A folder for staged tables, under the checkpoint folder the cluster shares.

    A staged table cuts lineage, so losing an executor costs a file read and not another
    pass over the ledger. Its size on disk is also known to the planner, which then decides
    by itself whether the table is small enough to broadcast.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{(root or shared_folder(spark)).rstrip('/')}/standings-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table that ``build`` gives, kept."""
        return self.keep(build(), name)

    def failed(self) -> None:
        """A run that failed has no use for its tables."""
        self.clear()

    def clear(self) -> None:
        """Delete the staged tables, once everything that reads them has been written."""
        delete_folder(self.spark, self.path)


class ResumableWorkspace(Workspace):
    """Staged tables that a later run finds again by name, as long as its inputs and options are the same.

    The folder's name is ``key``, a digest of all that the tables depend on, so tables of other inputs are
    never read. A table counts when its writer finished it; then it is read and nothing it was made of
    is looked at. What a failed run has finished stays; a run that succeeds clears it.
    """

    def __init__(self, spark: SparkSession, key: str, root: str | None = None):
        super().__init__(spark, root)
        self.path = f"{(root or shared_folder(spark)).rstrip('/')}/standings-resumable/{key}"

    def staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.path}/{name}"
        if not is_complete(self.spark, path):
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def failed(self) -> None:
        pass


def inputs_key(spark: SparkSession, folders: Iterable[str], *settings) -> str:
    """A digest of every input file's name, length and time of change, and of the settings' text."""
    digest = hashlib.sha256(repr((LAYOUT, settings)).encode())
    for folder in folders:
        seen = file_listing(spark, folder).select(F.xxhash64("path", "length", "changed").alias("h"))
        # Sums do not depend on the order of files, and no list of them comes to the driver.
        total = seen.agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
        digest.update(repr((folder, tuple(total))).encode())
    return digest.hexdigest()[:32]


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; without one, a folder of this machine if Spark is local."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="standings-")
