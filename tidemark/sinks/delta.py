"""The same target kept in Delta Lake, where the session has that format.

``MERGE`` does the upsert; Spark and Delta decide how. The format is not a dependency of
this package, so this module is only reachable when the session is configured for it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.errors import ConcurrentWriteError, SettingError
from tidemark.operators.upsert import last_writer, require_keys
from tidemark.sinks.snapshot import MIN_RETAIN_HOURS, MergeStats, SnapshotTarget, Staged, evolve, staged_totals

# Fixed text: how Delta's commit-race exceptions are named.
_CONFLICTS = ("ConcurrentModificationException", "ConcurrentAppendException", "ConcurrentWriteException",
              "ConcurrentDeleteReadException", "ConcurrentDeleteDeleteException", "MetadataChangedException",
              "ProtocolChangedException", "ConcurrentTransactionException")

# Fixed text: conditions by which Spark and Delta say that there is no table. Any other failure is one.
_NO_TABLE = ("TABLE_OR_VIEW_NOT_FOUND", "DELTA_TABLE_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST")


def delta_available(spark: SparkSession) -> bool:
    return "delta" in spark.conf.get("spark.sql.extensions", "").lower()


def default_target(spark: SparkSession, uri: str):
    """Delta Lake where the session has it, the Parquet table of this package elsewhere."""
    return DeltaTarget(spark, uri) if delta_available(spark) else SnapshotTarget(spark, uri)


@dataclass
class DeltaTarget:
    spark: SparkSession
    uri: str
    staging_uri: str | None = None

    def __post_init__(self):
        # Delta passes over folders whose name starts with an underscore.
        self.staging_uri = self.staging_uri or f"{self.uri.rstrip('/')}/_staging"
        if not delta_available(self.spark):
            raise SettingError("this session is not configured for Delta tables")
        self.identifier = f"delta.`{self.uri}`"
        self._staging = SnapshotTarget(self.spark, self.staging_uri)

    def read(self) -> DataFrame:
        return self.spark.table(self.identifier)

    def open_or_create(self, schema: T.StructType) -> T.StructType:
        try:
            return self.read().schema
        except AnalysisException as e:
            if e.getCondition() not in _NO_TABLE:
                raise
        self.spark.createDataFrame([], schema).write.format("delta").save(self.uri)
        return schema

    open = open_or_create

    def exists(self) -> bool:
        try:
            self.read().schema
            return True
        except AnalysisException as e:
            if e.getCondition() not in _NO_TABLE:
                raise
            return False

    def stage(self, df: DataFrame) -> Staged:
        return self._staging.stage(df)

    def publish(self, df: DataFrame) -> None:
        df.write.format("delta").mode("overwrite").option("overwriteSchema", "true").save(self.uri)

    def merge(self, staged: Staged, keys: list[str], watermark: str, type_name: str = "", base=None) -> MergeStats:
        keys = require_keys(keys)
        try:
            evolve(base or self.open_or_create(staged.frame.schema), staged.frame.schema)
            totals = staged_totals(staged.frame, keys, watermark, type_name)
            stats = MergeStats(totals["fetched"], 0, 0, totals["superseded"], totals["newest"])
            if not stats.rows_fetched:
                return stats
            delta = last_writer(staged.frame, keys, watermark) if stats.rows_superseded else staged.frame
            # MERGE answers with its own counts; the history's newest entry may be another writer's.
            counts = self.spark.sql(merge_sql(self.identifier, keys), delta=delta).first().asDict()
        except Exception as e:  # noqa: BLE001 - only commit races are handled, the rest is raised again
            if any(name in str(e) for name in _CONFLICTS):
                raise ConcurrentWriteError("another writer committed first; run again") from None
            raise
        finally:
            self._staging.discard(staged)
        return replace(stats, rows_inserted=int(counts["num_inserted_rows"]), rows_updated=int(counts["num_updated_rows"]))

    def replace(self, staged: Staged, keys: list[str], watermark: str, type_name: str = "", base=None) -> MergeStats:
        """Makes the staged rows the whole table, in one commit; a changed schema is accepted."""
        keys = require_keys(keys)
        try:
            totals = staged_totals(staged.frame, keys, watermark, type_name)
            superseded = totals["superseded"]
            self.publish(last_writer(staged.frame, keys, watermark) if superseded else staged.frame)
        finally:
            self._staging.discard(staged)
        return MergeStats(totals["fetched"], totals["fetched"] - superseded, 0, superseded, totals["newest"])

    def vacuum(self, retain_hours: float = MIN_RETAIN_HOURS) -> int:
        """Removes files no version inside the window needs; returns how many."""
        if retain_hours < MIN_RETAIN_HOURS:
            raise SettingError(f"retention must be at least {MIN_RETAIN_HOURS} hours")
        if not self.exists():
            return 0
        removed = self.spark.sql(f"VACUUM {self.identifier} RETAIN {retain_hours} HOURS DRY RUN").count()
        self.spark.sql(f"VACUUM {self.identifier} RETAIN {retain_hours} HOURS")
        return removed


def merge_sql(identifier: str, keys: list[str]) -> str:
    """Matched rows take all of the delta's columns, others are inserted, none is deleted."""
    on = " AND ".join(f"target.`{k}` = source.`{k}`" for k in keys)
    return (
        f"MERGE WITH SCHEMA EVOLUTION INTO {identifier} AS target USING {{delta}} AS source ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
