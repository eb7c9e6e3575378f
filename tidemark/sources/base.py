"""What a sync needs from a source."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame

from tidemark.config import SyncConfig, TableSync
from tidemark.errors import CheckpointMismatchError, ColumnNotFoundError
from tidemark.functions.typemap import ColumnSpec, find_column


@dataclass(frozen=True)
class Scan:
    """The rows of one run. ``newest`` is set when the source fixed the upper bound itself."""

    frame: DataFrame
    newest: str | None = None
    bounded: bool = False


class Source(Protocol):
    secrets: tuple[str, ...]

    def configure(self, config: SyncConfig) -> None:
        """Takes over batch size and time limits before the first read."""

    def describe(self, tables: list[TableSync]) -> dict[str, list[ColumnSpec]]:
        """Columns of each table in ordinal order; a table that does not exist raises."""

    def scan(self, table: TableSync, columns: list[ColumnSpec], last_value: str | None) -> Scan | None:
        """Rows above ``last_value``, or all; None if it is already known there are none."""

    def watermark(self, table: TableSync, columns: list[ColumnSpec]) -> str | None:
        """The greatest watermark now, as checkpoint text."""

    def summary(self, table: TableSync, columns: list[ColumnSpec]) -> tuple[int, str | None]:
        """Row count and greatest watermark, both taken where the rows are."""

    def changed(self, tables, described, checkpoints: dict[str, str]) -> set[str]:
        """Of the tables with a checkpoint, those that may have newer rows."""


def require_columns(table: TableSync, columns: list[ColumnSpec]) -> tuple[str, list[str]]:
    """The watermark and key columns as the source spells them; a missing one raises."""
    names = [c.name for c in columns]
    watermark = find_column(names, table.watermark_column)
    if watermark is None:
        raise ColumnNotFoundError(f"watermark column {table.watermark_column} does not exist")
    keys = [(key, find_column(names, key)) for key in table.primary_key]
    for key, found in keys:
        if found is None:
            raise ColumnNotFoundError(f"primary key column {key} does not exist")
    spec = next(c for c in columns if c.name == watermark)
    problem = watermark_problem(spec)
    if problem:
        raise CheckpointMismatchError(problem)
    return watermark, [found for _, found in keys]


def watermark_problem(spec: ColumnSpec) -> str | None:
    """Why a column cannot serve as watermark, or None."""
    if spec.spark_type.typeName() == "binary":
        return f"watermark column {spec.name} is {spec.source_type}; its text form has no order"
    return None
