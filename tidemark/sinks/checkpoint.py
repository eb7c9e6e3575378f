"""How far each source table has been synced.

One one-row table per source table, so that tables synced at the same time never share a
writer. The value is text whatever the watermark's type.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import MAX_NAME_PARTS, TableSync, join_uri
from tidemark.errors import CheckpointMismatchError
from tidemark.sinks.snapshot import SnapshotTarget
from tidemark.sinks.storage import at_once, storage

# The checkpoint table's columns.
CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("watermark_column", T.StringType(), False),
        T.StructField("last_value", T.StringType(), False),
        T.StructField("synced_at", T.TimestampType(), False),
    ]
)


@dataclass(frozen=True)
class CheckpointStore:
    spark: SparkSession
    uri: str

    def target(self, table: TableSync) -> SnapshotTarget:
        return SnapshotTarget(self.spark, join_uri(self.uri, table.path))

    def _paths(self, targets: list[SnapshotTarget]) -> list[str]:
        def current(target: SnapshotTarget) -> list[str]:
            commit = target.current()
            return target.paths(commit.runs) if commit else []

        return [path for paths in at_once(self.spark, current, targets) for path in paths]

    def _found(self, uri: str, depth: int = 0) -> list[SnapshotTarget]:
        """Every checkpoint beneath the prefix, however many parts its table's name has.

        A folder is one if it has commit files, so a table may be called ``commits`` or ``data``, and
        one table's name may go on from another's.
        """
        target = SnapshotTarget(self.spark, uri)
        here = [target] if depth and target.exists() else []
        if depth == MAX_NAME_PARTS:
            return here
        names = [name for name, _ in storage(self.spark).list(uri)]
        return here + [t for name in names for t in self._found(join_uri(uri, name), depth + 1)]

    def view(self, tables: list[TableSync] | None = None) -> DataFrame:
        """The checkpoints of ``tables``, or all beneath the prefix, in one frame."""
        targets = self._found(self.uri) if tables is None else [self.target(t) for t in tables]
        paths = self._paths(targets)
        return self._frame(paths) if paths else self.spark.createDataFrame([], CHECKPOINT_SCHEMA)

    def _frame(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(CHECKPOINT_SCHEMA).parquet(*paths)

    def read(self, tables: list[TableSync]) -> dict[str, str]:
        """Last values by table, in one job for all of them. A table never synced is absent.

        A value recorded for another watermark column is refused rather than compared.
        """
        configured = {t.table: t.watermark_column for t in tables}
        paths = self._paths([self.target(t) for t in tables])
        if not paths:
            return {}
        values = {}
        for row in self._frame(paths).collect():
            expected = configured.get(row["table_name"])
            if expected is None:
                continue
            if row["watermark_column"].lower() != expected.lower():
                error = CheckpointMismatchError(
                    f"its checkpoint belongs to column {row['watermark_column']}, not {expected}; "
                    "delete the checkpoint to re-sync the table"
                )
                error.table = row["table_name"]
                raise error
            values[row["table_name"]] = row["last_value"]
        return values

    def advance(self, table: TableSync, last_value: str) -> None:
        """Records ``last_value``. Call only after the rows it covers have been committed."""
        row = self.spark.sql("SELECT 1").select(
            F.lit(table.table).alias("table_name"),
            F.lit(table.watermark_column).alias("watermark_column"),
            F.lit(last_value).alias("last_value"),
            F.current_timestamp().alias("synced_at"),
        )
        self.target(table).publish(row)

    def delete(self, table: TableSync) -> None:
        """Forgets the table: its next sync is a full one."""
        target = self.target(table)
        base = target.current()
        if base is not None and base.runs:
            target.commit(base, CHECKPOINT_SCHEMA, {})


def listing(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints, most recently synced first."""
    return checkpoints.orderBy(F.col("synced_at").desc(), "table_name")
