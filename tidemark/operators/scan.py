"""Full and incremental scans, and the greatest watermark, of any DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import CheckpointMismatchError
from tidemark.functions.render import render_text
from tidemark.functions.typemap import describe_schema


def full_scan(df: DataFrame, watermark: str | None = None, ordered: bool = False) -> DataFrame:
    """Every row, NULL watermarks included. Sorted only when asked for."""
    return df.orderBy(F.col(watermark).asc_nulls_first()) if ordered else df


def incremental_scan(df: DataFrame, watermark: str, last_value: str, ordered: bool = False) -> DataFrame:
    """Rows strictly above ``last_value``. A NULL watermark never qualifies.

    The text becomes a literal of the column's own type, folded before the scan, so the
    comparison holds no cast on the column and reaches the Parquet row groups.
    """
    check_bound(df, watermark, last_value)
    return full_scan(df.where(above(df, watermark, last_value)), watermark, ordered)


def above(df: DataFrame, watermark: str, last_value: str) -> Column:
    """True above ``last_value``, and for every row if that is no value of the column."""
    bound = F.lit(last_value).try_cast(df.schema[watermark].dataType)
    return (F.col(watermark) > bound) | bound.isNull()


def check_bound(df: DataFrame, watermark: str, last_value: str) -> None:
    """Raises unless ``last_value`` is a value of the column; a cast error would print it."""
    raw = df.schema[watermark].dataType
    if isinstance(raw, T.BinaryType):
        raise CheckpointMismatchError(f"watermark column {watermark} is binary; its text form has no order")
    if df.sparkSession.sql("SELECT 1").select(F.lit(last_value).try_cast(raw).isNull()).first()[0]:
        raise CheckpointMismatchError(
            f"the checkpoint of watermark column {watermark} is not a valid {raw.simpleString()}"
        )


def source_watermark(df: DataFrame, watermark: str, type_name: str | None = None) -> DataFrame:
    """One row, ``watermark``: the greatest value as checkpoint text, NULL if there is none."""
    return df.agg(F.max(watermark).alias("__max")).select(
        watermark_text(df, F.col("__max"), watermark, type_name).alias("watermark")
    )


def summary(df: DataFrame, watermark: str, type_name: str | None = None) -> DataFrame:
    """One row: ``n`` rows and the greatest watermark, ``newest``, as checkpoint text."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.max(watermark).alias("__max")).select(
        "n", watermark_text(df, F.col("__max"), watermark, type_name).alias("newest")
    )


def watermark_text(df: DataFrame, value: Column, watermark: str, type_name: str | None = None) -> Column:
    """``value``, of column ``watermark``'s type, as a checkpoint records it."""
    field = df.schema[watermark]
    spec = describe_schema(T.StructType([field]))[0]
    return render_text(value, field.dataType, type_name or spec.type_name)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union of many frames, paired up level by level: Spark analyses each plan a few times
    only, where adding one after the other would go through the whole plan every time."""
    while len(frames) > 1:
        pairs = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = pairs + (frames[-1:] if len(frames) % 2 else [])
    return frames[0]
