from standings.sources.schemas import (
    FUNDING,
    LEDGER,
    LINE_MAP,
    LOAN_TAPE,
    PROVINCES,
    conform,
    sales_schema,
)
from standings.sources.sinks import replace_partitions, replace_table
from standings.sources.snapshots import CatalogSnapshots, SnapshotSet
from standings.sources.staging import ResumableWorkspace, Workspace

__all__ = [
    "CatalogSnapshots",
    "FUNDING",
    "LEDGER",
    "LINE_MAP",
    "LOAN_TAPE",
    "PROVINCES",
    "ResumableWorkspace",
    "SnapshotSet",
    "Workspace",
    "conform",
    "replace_partitions",
    "replace_table",
    "sales_schema",
]
