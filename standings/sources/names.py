"""Names in one Unicode normal form, so that composed and decomposed spellings are one name."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMS = ("NFC", "NFD", "NFKC", "NFKD")


def normal_name(name: str | None, form: str) -> str | None:
    return None if name is None else unicodedata.normalize(form, name)


def with_normal_names(df: DataFrame, column: str, form: str) -> DataFrame:
    """``df`` with the names of ``column`` in the normal form ``form``.

    Spark has no function for it, so the different names that hold anything but ASCII, a few for each
    branch, are brought to the form once, and those that changed are joined back. ASCII is in every form
    already; NULL stays. Names must compare as bytes here, so this comes before any collation.
    """
    if form not in FORMS:
        raise ValueError(f"{form} is none of {', '.join(FORMS)}")
    different = df.select(F.col(column).alias("_name")).where(F.col("_name").rlike(r"[^\x00-\x7F]")).distinct()

    def normalize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(n, unicodedata.normalize(form, n)) for n in batch.column(0).to_pylist()]
            changed = [p for p in pairs if p[0] != p[1]]
            columns = [pa.array([p[i] for p in changed], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["_name", "_normal"])

    changed = different.mapInArrow(normalize, "_name string, _normal string")
    named = df.join(changed, F.col(column) == F.col("_name"), "left")
    return named.withColumn(column, F.coalesce("_normal", column)).select(*df.columns)
