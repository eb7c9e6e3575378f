"""Watermarks, checkpoints and bulk loads outside a sync run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark.config import SyncConfig, TableSync, build_catalog
from tidemark.errors import in_table, translate
from tidemark.operators.catalog import config_frame, described_frame, preflight_frame
from tidemark.operators.scan import summary
from tidemark.plans.sync import _session, _source
from tidemark.sinks.checkpoint import CHECKPOINT_SCHEMA, CheckpointStore
from tidemark.sinks.delta import default_target
from tidemark.sinks.snapshot import MIN_RETAIN_HOURS
from tidemark.sinks.storage import at_once
from tidemark.sources import Source
from tidemark.sources.base import require_columns

RECONCILED = (
    "table string, source_rows bigint, target_rows bigint, source_newest string, target_newest string, "
    "missing_rows bigint, in_step boolean"
)


def source_watermark(
    source: Source | str,
    table: TableSync | dict,
    *,
    login_timeout_sec: int | None = 30,
    query_timeout_sec: int | None = 300,
    spark: SparkSession | None = None,
) -> str | None:
    """The source's greatest watermark now, as a checkpoint records it; None if empty.

    For a bulk load, take it before the export starts: rows written meanwhile are then
    fetched again, which is harmless, instead of skipped.
    """
    [entry] = build_catalog([table])
    entry.check_names()
    spark = _session(spark)
    reader = _source(spark, source)
    try:
        reader.configure(SyncConfig("", "", 1, login_timeout_sec, query_timeout_sec))
        columns = reader.describe([entry])[entry.table]
        require_columns(entry, columns)
        return reader.watermark(entry, columns)
    except Exception as e:  # noqa: BLE001 - translated and raised again
        raise in_table(translate(e, reader.secrets), entry.table) from None


def set_checkpoint(
    output_uri: str,
    table: TableSync | dict,
    last_value: str,
    *,
    checkpoint_uri: str | None = None,
    spark: SparkSession | None = None,
) -> None:
    """Records a checkpoint for rows loaded by other means. The source is not contacted.

    The value may lie before the current one. One that lies ahead of what was loaded makes
    the rows in between invisible to every later sync.
    """
    [entry] = build_catalog([table])
    config = SyncConfig(output_uri, checkpoint_uri).validate()
    CheckpointStore(_session(spark), config.checkpoint_uri).advance(entry, last_value)


def delete_checkpoint(
    output_uri: str,
    table: TableSync | dict,
    *,
    checkpoint_uri: str | None = None,
    spark: SparkSession | None = None,
) -> None:
    """Forgets how far a table was synced, so that its next sync is a full one."""
    [entry] = build_catalog([table])
    config = SyncConfig(output_uri, checkpoint_uri).validate()
    CheckpointStore(_session(spark), config.checkpoint_uri).delete(entry)


def bulk_load(output_uri: str, table: TableSync | dict, rows: DataFrame, *, target_factory: Callable = default_target):
    """Writes ``rows`` as the whole table: a first load by other means, or a rebuild. Returns what the target says."""
    [entry] = build_catalog([table])
    uri = SyncConfig(output_uri).validate().table_uri(entry.table)
    return target_factory(rows.sparkSession, uri).publish(rows)


def vacuum(
    output_uri: str,
    tables,
    *,
    checkpoint_uri: str | None = None,
    retain_hours: float = MIN_RETAIN_HOURS,
    spark: SparkSession | None = None,
    target_factory: Callable = default_target,
) -> int:
    """Removes superseded files of the tables and of their checkpoints; returns how many.

    To be scheduled: every sync of every table leaves a superseded checkpoint behind.
    """
    config, spark = SyncConfig(output_uri, checkpoint_uri).validate(), _session(spark)
    store = CheckpointStore(spark, config.checkpoint_uri)
    catalog = build_catalog(tables)
    targets = [target_factory(spark, config.table_uri(t.table)) for t in catalog] + [store.target(t) for t in catalog]
    return sum(at_once(spark, lambda target: target.vacuum(retain_hours), targets))


def preflight(
    source: Source | str,
    tables,
    *,
    output_uri: str = "",
    checkpoint_uri: str | None = None,
    login_timeout_sec: int | None = 30,
    query_timeout_sec: int | None = 300,
    spark: SparkSession | None = None,
) -> list[Row]:
    """What a sync would do, one row per table in configured order. Writes nothing.

    A missing table raises; a missing column only makes its table not ready. Without
    ``output_uri`` no checkpoint is read.
    """
    catalog = build_catalog(tables)
    spark = _session(spark)
    config = SyncConfig(output_uri, checkpoint_uri, 1, login_timeout_sec, query_timeout_sec)
    reader = _source(spark, source)
    for entry in catalog:
        try:
            entry.check_names()
        except ValueError as e:
            raise in_table(e, entry.table) from None
    try:
        reader.configure(config)
        described = described_frame(spark, reader.describe(catalog) if catalog else {})
        checkpoints = (
            CheckpointStore(spark, config.checkpoint_uri).view(catalog)
            if config.checkpoint_uri
            else spark.createDataFrame([], CHECKPOINT_SCHEMA)
        )
        found = preflight_frame(config_frame(spark, catalog), described, checkpoints).collect()
    except Exception as e:  # noqa: BLE001 - translated and raised again
        raise translate(e, reader.secrets) from None
    place = {entry.table: i for i, entry in enumerate(catalog)}
    return sorted(found, key=lambda row: place[row["table"]])


def reconcile(
    source: Source | str,
    output_uri: str,
    tables,
    *,
    login_timeout_sec: int | None = 30,
    query_timeout_sec: int | None = 300,
    spark: SparkSession | None = None,
    target_factory: Callable = default_target,
) -> DataFrame:
    """Row counts and greatest watermarks of source and target, one row per table.

    Each side counts where its rows are, several tables at a time; what comes back is a
    count and a mark. A target that was never created counts as empty.
    """
    catalog = build_catalog(tables)
    spark = _session(spark)
    config = SyncConfig(output_uri, None, 1, login_timeout_sec, query_timeout_sec).validate()
    reader = _source(spark, source)

    def one(entry: TableSync) -> tuple:
        columns = described[entry.table]
        watermark, _ = require_columns(entry, columns)
        type_name = next(c.type_name for c in columns if c.name == watermark)
        source_rows, source_newest = reader.summary(entry, columns)
        target = target_factory(spark, config.table_uri(entry.table))
        rows, newest = summary(target.read(), watermark, type_name).first() if target.exists() else (0, None)
        return entry.table, source_rows, rows, source_newest, newest, source_rows - rows, source_newest == newest

    try:
        for entry in catalog:
            entry.check_names()
        reader.configure(config)
        described = reader.describe(catalog)
        return spark.createDataFrame(at_once(spark, one, catalog), RECONCILED)
    except Exception as e:  # noqa: BLE001 - translated and raised again
        raise translate(e, reader.secrets) from None
