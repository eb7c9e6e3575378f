"""Any Spark-readable table as a source: DataFrames, files, catalog tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SyncConfig, TableSync
from tidemark.errors import TableNotFoundError, in_table
from tidemark.functions.typemap import ColumnSpec, describe_schema, find_column
from tidemark.operators.scan import above, incremental_scan, source_watermark, summary, union_all
from tidemark.sinks.storage import at_once
from tidemark.sources.base import Scan


# How many tables one job asks for news: few enough to plan quickly, several jobs at a time.
TABLES_PER_PROBE = 25


class FrameSource:
    """Tables by name. A string is a catalog table, or a Parquet path if it holds a slash; it is
    looked up anew for every run, while a DataFrame keeps the files it was made of.

    ``declared`` gives source types where they say more than the Spark schema does:
    ``{"dbo.t": {"amount": ("decimal", 10, 2), "id": ("uniqueidentifier",)}}``.

    ``spread`` moves the rows of a full scan between tasks, by key, before they are written: for
    tables kept in fewer splits than there are cores. Without it a full scan moves no row.
    """

    secrets: tuple[str, ...] = ()

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, DataFrame | str],
        declared: Mapping[str, Mapping[str, tuple]] | None = None,
        spread: bool = False,
    ):
        self.spark = spark
        self.spread = spread
        self._tables = {name.lower(): frame for name, frame in tables.items()}
        self._looked_up: dict[str, DataFrame] = {}
        self._declared = {name.lower(): dict(spec) for name, spec in (declared or {}).items()}

    def configure(self, config: SyncConfig) -> None:
        """A new run begins. There are no limits to set: Spark reads by its own split size."""
        self._looked_up = {}

    def frame(self, table: str) -> DataFrame:
        found = self._tables.get(table.lower())
        if found is None:
            raise in_table(TableNotFoundError("the source has no such table"), table)
        if isinstance(found, DataFrame):
            return found
        if table.lower() not in self._looked_up:
            read = self.spark.read.parquet if "/" in found else self.spark.table
            self._looked_up[table.lower()] = read(found)
        return self._looked_up[table.lower()]

    def describe(self, tables: list[TableSync]) -> dict[str, list[ColumnSpec]]:
        return {
            t.table: describe_schema(self.frame(t.table).schema, self._declared.get(t.table.lower()))
            for t in tables
        }

    def scan(self, table: TableSync, columns: list[ColumnSpec], last_value: str | None) -> Scan:
        df = self.frame(table.table)
        # Rebalancing by key lets AQE size the files and split a key that is too frequent.
        spread = [find_column(df.columns, key) for key in table.primary_key]
        if last_value is not None:
            # Few rows out of many splits: gather them.
            return Scan(incremental_scan(df, self._watermark(table), last_value).hint("rebalance", *spread))
        return Scan(df.hint("rebalance", *spread) if self.spread else df)

    def watermark(self, table: TableSync, columns: list[ColumnSpec]) -> str | None:
        df, name = self.frame(table.table), self._watermark(table)
        type_name = next(c.type_name for c in columns if c.name == name)
        return source_watermark(df, name, type_name).first()["watermark"]

    def summary(self, table: TableSync, columns: list[ColumnSpec]) -> tuple[int, str | None]:
        name = self._watermark(table)
        type_name = next(c.type_name for c in columns if c.name == name)
        return tuple(summary(self.frame(table.table), name, type_name).first())

    def estimated_bytes(self, table: TableSync, last_value: str | None) -> int:
        """Spark's own estimate from file sizes and statistics; no job is run."""
        df = self.frame(table.table)
        if last_value is not None:
            df = incremental_scan(df, self._watermark(table), last_value)
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())

    def changed(self, tables, described, checkpoints: dict[str, str]) -> set[str]:
        """A job for every few tables: a name comes back if any row lies above its checkpoint.

        Only the watermark columns are read, and of those the row groups that reach beyond
        the checkpoint; each task stops at its first such row. A checkpoint that is no value
        of its column counts as news, so that the scan itself can refuse it.
        """
        known = [t for t in tables if t.table in checkpoints]

        def probe(table: TableSync) -> DataFrame:
            df, watermark = self.frame(table.table), self._watermark(table)
            newer = above(df, watermark, checkpoints[table.table])
            return df.where(newer).select(F.lit(table.table).alias("table")).limit(1)

        def names(group: list[TableSync]) -> list[str]:
            return [r["table"] for r in union_all([probe(t) for t in group]).collect()]

        groups = [known[i : i + TABLES_PER_PROBE] for i in range(0, len(known), TABLES_PER_PROBE)]
        return {name for found in at_once(self.spark, names, groups) for name in found}

    def _watermark(self, table: TableSync) -> str:
        return find_column(self.frame(table.table).columns, table.watermark_column)

