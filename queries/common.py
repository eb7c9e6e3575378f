"""Shared by the registered queries: test tables, work folders, SQL fragments."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
WATERMARKS = {name: keys[0] for name, keys in KEYS.items()} | {
    "orders": "o_orderdate",
    "lineitem": "l_shipdate",
    "events": "ts",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def entry(table: str, **changes) -> dict:
    """The sync configuration of a test table."""
    return {
        "table": f"dbo.{table}",
        "watermark_column": WATERMARKS[table],
        "primary_key": KEYS[table],
    } | changes


def work_dir(spark: SparkSession) -> str:
    """A fresh folder for targets: in the cluster's shared folder, or local in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the comparison engine holds them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def ts_text(column: str) -> str:
    """SQL: a timestamp as checkpoint text, fraction in groups of three digits."""
    return (
        f"CASE WHEN epoch_us({column}) % 1000000 = 0 THEN strftime({column}, '%Y-%m-%d %H:%M:%S') "
        f"WHEN epoch_us({column}) % 1000 = 0 THEN strftime({column}, '%Y-%m-%d %H:%M:%S.%g') "
        f"ELSE strftime({column}, '%Y-%m-%d %H:%M:%S.%f') END"
    )


def watermark_sql(table: str) -> str:
    """SQL: a test table's greatest watermark as checkpoint text."""
    column = WATERMARKS[table]
    greatest = ts_text(f"max({column})") if table in ("orders", "lineitem", "events") else f"CAST(max({column}) AS VARCHAR)"
    return f"(SELECT {greatest} FROM {table})"
