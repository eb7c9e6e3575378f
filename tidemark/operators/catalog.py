"""Catalog rows as frames: described columns, preflight, text fallbacks, schema drift.

A described frame has one row per column: ``table, ordinal, column_name, data_type,
precision, scale, spark_type, recognised``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import TableName, TableSync
from tidemark.functions.typemap import ColumnSpec, resolve_columns

CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("database_part", T.StringType()),
        T.StructField("schema_part", T.StringType()),
        T.StructField("table_part", T.StringType()),
        T.StructField("watermark_column", T.StringType()),
        T.StructField("primary_key", T.ArrayType(T.StringType())),
    ]
)
DESCRIBED_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("precision", T.IntegerType()),
        T.StructField("scale", T.IntegerType()),
    ]
)


def config_frame(spark: SparkSession, tables: list[TableSync]) -> DataFrame:
    rows = []
    for t in tables:
        name = TableName.parse(t.table)
        rows.append((t.table, name.database, name.schema, name.table, t.watermark_column, list(t.primary_key)))
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def match_catalog(catalog: DataFrame, config: DataFrame) -> DataFrame:
    """Resolved columns of every configured table, out of ``INFORMATION_SCHEMA.COLUMNS`` rows.

    A table without a schema part belongs to the catalog row's ``default_schema``. Tables
    with no rows come back once with a NULL column, so that they can be named.
    """
    same_table = F.lower("table_part") == F.lower("table_name")
    same_schema = F.lower(F.coalesce("schema_part", "default_schema")) == F.lower("table_schema")
    matched = config.join(catalog, same_table & same_schema, "left").select(
        "table",
        F.col("ordinal_position").cast("int").alias("ordinal"),
        "column_name",
        "data_type",
        F.col("numeric_precision").cast("int").alias("precision"),
        F.col("numeric_scale").cast("int").alias("scale"),
    )
    return resolve_columns(matched)


def described_frame(spark: SparkSession, described: dict[str, list[ColumnSpec]]) -> DataFrame:
    """Specs already resolved on the driver, as a described frame."""
    rows = []
    for table, columns in described.items():
        for i, c in enumerate(columns, start=1):
            sized = c.spark_type if isinstance(c.spark_type, T.DecimalType) else None
            rows.append(
                (table, i, c.name, c.source_type, sized and sized.precision, sized and sized.scale)
            )
    return resolve_columns(spark.createDataFrame(rows, DESCRIBED_SCHEMA))


def text_fallbacks(described: DataFrame) -> DataFrame:
    """Per table, the columns stored as text for want of a mapping, in ordinal order."""
    unmapped = F.when(~F.col("recognised"), F.struct("ordinal", "column_name"))
    return described.groupBy("table").agg(
        F.transform(F.sort_array(F.collect_list(unmapped)), lambda c: c["column_name"]).alias(
            "text_fallback_columns"
        )
    )


def preflight_frame(config: DataFrame, described: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """One row per configured table: what a sync would do and whether it could run.

    An unmapped column type never makes a table unready. A binary watermark does, because
    its text form has no order.
    """
    column = F.struct("ordinal", F.col("column_name").alias("name"), F.col("data_type").alias("source_type"), "spark_type", "recognised")
    exists = F.col("column_name").isNotNull()
    name, watermark = F.lower("column_name"), F.lower("watermark_column")
    keys = F.transform("primary_key", lambda key: F.lower(key))
    # One grouping by table answers everything; what goes into it is told row by row, before rows are gathered. A
    # table has at most as many rows here as the source allows it columns.
    settings = config.select("table", "watermark_column", "primary_key")
    found = settings.join(described, "table", "left").groupBy("table").agg(
        F.first("primary_key").alias("primary_key"),
        F.sort_array(F.collect_list(F.when(exists, column))).alias("columns"),
        F.coalesce(F.bool_or(name == watermark), F.lit(False)).alias("watermark_present"),
        F.coalesce(F.bool_or((name == watermark) & (F.col("spark_type") == "binary")), F.lit(False)).alias("__binary"),
        F.collect_set(F.when(F.array_contains(keys, name), name)).alias("__keys"),
    )
    missing = F.filter("primary_key", lambda key: ~F.array_contains("__keys", F.lower(key)))
    problem = F.when(F.col("__binary"), F.lit("the watermark column is binary; its text form has no order"))
    marks = checkpoints.select(F.col("table_name").alias("table"), F.col("last_value").alias("last_synced_value"))
    return found.join(marks, "table", "left").select(
        "table",
        "columns",
        "watermark_present",
        missing.alias("missing_primary_key_columns"),
        "last_synced_value",
        problem.alias("watermark_problem"),
        (F.col("watermark_present") & (F.size(missing) == 0) & ~F.col("__binary")).alias("ready"),
    )


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, dropped or retyped between two described frames."""
    key = ["table", F.lower("column_name").alias("column_key")]
    old = before.select(*key, F.col("column_name").alias("old_name"), F.col("spark_type").alias("old_type"))
    new = after.select(*key, F.col("column_name").alias("new_name"), F.col("spark_type").alias("new_type"))
    change = (
        F.when(F.col("old_name").isNull(), "added")
        .when(F.col("new_name").isNull(), "dropped")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    return (
        old.join(new, ["table", "column_key"], "full_outer")
        .select("table", F.coalesce("new_name", "old_name").alias("column_name"), change.alias("change"), "old_type", "new_type")
        .where(F.col("change").isNotNull())
    )
