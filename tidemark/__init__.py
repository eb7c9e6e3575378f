"""Incremental table sync on Spark."""

from tidemark.config import SyncConfig, TableSync
from tidemark.errors import ConcurrentWriteError
from tidemark.plans.handover import (
    bulk_load,
    delete_checkpoint,
    preflight,
    reconcile,
    set_checkpoint,
    source_watermark,
    vacuum,
)
from tidemark.plans.sync import (
    SyncReport,
    TableSyncStats,
    plan_concurrency,
    rebuild_table,
    sync_table,
    sync_tables,
    sync_tables_distributed,
)
from tidemark.sources import FrameSource, JdbcSource

__all__ = [
    "ConcurrentWriteError",
    "FrameSource",
    "JdbcSource",
    "SyncConfig",
    "SyncReport",
    "TableSync",
    "TableSyncStats",
    "bulk_load",
    "delete_checkpoint",
    "plan_concurrency",
    "preflight",
    "rebuild_table",
    "reconcile",
    "set_checkpoint",
    "source_watermark",
    "sync_table",
    "sync_tables",
    "sync_tables_distributed",
    "vacuum",
]
