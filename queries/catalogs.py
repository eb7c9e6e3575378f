"""Preflight, text fallbacks and schema drift, over a catalog derived from the order lines."""

from pyspark.sql import functions as F

from queries.common import load
from queries.types import CATALOG_SQL, RECOGNISED_SQL, SPARK_TYPE_SQL, catalog_rows
from tidemark.functions.typemap import resolve_columns
from tidemark.operators.catalog import match_catalog, preflight_frame, schema_drift, text_fallbacks


def _config(spark, sf):
    """One configured table per order: some name columns that exist, some do not."""
    per_order = catalog_rows(spark, sf).groupBy("l_orderkey").agg(
        F.min("column_name").alias("first"),
        F.max("column_name").alias("last"),
        F.max("l_returnflag").alias("flag"),
        F.max("l_linestatus").alias("status"),
    )
    return per_order.select(
        F.concat(F.lit("sales.order_"), F.col("l_orderkey")).alias("table"),
        F.lit(None).cast("string").alias("database_part"),
        F.lit("SALES").alias("schema_part"),
        F.concat(F.lit("order_"), F.col("l_orderkey")).alias("table_part"),
        F.when(F.col("flag") == "R", F.upper("last")).otherwise("updated_at").alias("watermark_column"),
        F.when(F.col("status") == "O", F.array("first")).otherwise(F.array("first", F.lit("line_no"))).alias("primary_key"),
    )


def _described(spark, sf):
    return match_catalog(catalog_rows(spark, sf), _config(spark, sf))


def describe_columns(spark, sf):
    return _described(spark, sf).select("table", "ordinal", "column_name", "data_type", "spark_type", "recognised")


def text_fallback_columns(spark, sf):
    return text_fallbacks(_described(spark, sf)).select(
        "table", F.concat_ws(",", "text_fallback_columns").alias("text_fallback_columns")
    )


def preflight_ready(spark, sf):
    finished = load(spark, sf, "orders").where("o_orderstatus = 'F'")
    checkpoints = finished.select(
        F.concat(F.lit("sales.order_"), F.col("o_orderkey")).alias("table_name"),
        F.col("o_orderdate").cast("string").alias("last_value"),
    )
    found = preflight_frame(_config(spark, sf), _described(spark, sf), checkpoints)
    return found.select(
        "table",
        F.size("columns").alias("columns"),
        F.concat_ws(",", F.transform("columns", lambda c: F.concat_ws(":", c["name"], c["spark_type"]))).alias("described"),
        "watermark_present",
        F.concat_ws(",", "missing_primary_key_columns").alias("missing_primary_key_columns"),
        "last_synced_value",
        F.col("watermark_problem").isNotNull().alias("binary_watermark"),
        "ready",
    )


def schema_drift_orders(spark, sf):
    """Descriptions taken before and after a day: lines shipped later are new columns, returned
    ones are gone, and those still open had another type."""
    rows = resolve_columns(
        catalog_rows(spark, sf).select(
            F.col("table_name").alias("table"), "column_name", "data_type", "l_shipdate", "l_returnflag", "l_linestatus",
            F.col("numeric_precision").alias("precision"), F.col("numeric_scale").alias("scale"),
        )
    )
    day = F.lit("2000-01-01").cast("timestamp_ntz")
    before = rows.where(F.col("l_shipdate") <= day)
    after = rows.where((F.col("l_shipdate") > day) | (F.col("l_returnflag") != "R"))
    reopened = F.when((F.col("l_linestatus") == "O") & (F.col("l_shipdate") <= day), F.lit("string"))
    return schema_drift(before, after.withColumn("spark_type", F.coalesce(reopened, "spark_type")))


CONFIG_SQL = f"""
SELECT l_orderkey, 'sales.order_' || l_orderkey AS tbl,
       CASE WHEN max(l_returnflag) = 'R' THEN upper(max(column_name)) ELSE 'updated_at' END AS watermark_column,
       CASE WHEN max(l_linestatus) = 'O' THEN [min(column_name)] ELSE [min(column_name), 'line_no'] END AS primary_key
FROM ({CATALOG_SQL}) GROUP BY l_orderkey"""
DESCRIBED_SQL = f"""
SELECT tbl, watermark_column, primary_key, ordinal, column_name, data_type, l_orderkey,
       {SPARK_TYPE_SQL} AS spark_type, {RECOGNISED_SQL} AS recognised
FROM ({CONFIG_SQL}) JOIN ({CATALOG_SQL}) USING (l_orderkey)"""

QUERIES = {
    "describe_columns": (
        describe_columns,
        f'SELECT tbl AS "table", ordinal, column_name, data_type, spark_type, recognised FROM ({DESCRIBED_SQL})',
    ),
    "text_fallback_columns": (
        text_fallback_columns,
        f"""SELECT tbl AS "table",
                   coalesce(string_agg(column_name, ',' ORDER BY ordinal, column_name) FILTER (WHERE NOT recognised), '')
                       AS text_fallback_columns
            FROM ({DESCRIBED_SQL}) GROUP BY tbl""",
    ),
    "preflight_ready": (
        preflight_ready,
        f"""WITH d AS ({DESCRIBED_SQL}),
            t AS (SELECT tbl, l_orderkey, any_value(watermark_column) AS w, any_value(primary_key) AS pk,
                         count(*) AS columns,
                         string_agg(column_name || ':' || spark_type, ',' ORDER BY ordinal, column_name) AS described,
                         bool_or(lower(column_name) = lower(watermark_column)) AS watermark_present,
                         bool_or(lower(column_name) = lower(watermark_column) AND spark_type = 'binary') AS binary_watermark
                  FROM d GROUP BY tbl, l_orderkey),
            m AS (SELECT *, CASE WHEN list_contains(pk, 'line_no') THEN 'line_no' ELSE '' END AS missing FROM t)
            SELECT tbl AS "table", CAST(columns AS INTEGER) AS columns, described, watermark_present,
                   missing AS missing_primary_key_columns,
                   CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS last_synced_value,
                   binary_watermark, watermark_present AND missing = '' AND NOT binary_watermark AS ready
            FROM m LEFT JOIN orders ON o_orderkey = l_orderkey""",
    ),
    "schema_drift_orders": (
        schema_drift_orders,
        f"""WITH r AS (SELECT *, {SPARK_TYPE_SQL} AS spark_type FROM ({CATALOG_SQL})),
            b AS (SELECT * FROM r WHERE l_shipdate <= TIMESTAMP '2000-01-01'),
            a AS (SELECT * REPLACE (CASE WHEN l_linestatus = 'O' AND l_shipdate <= TIMESTAMP '2000-01-01' THEN 'string'
                                         ELSE spark_type END AS spark_type)
                  FROM r WHERE l_shipdate > TIMESTAMP '2000-01-01' OR l_returnflag <> 'R'),
            j AS (SELECT coalesce(a.table_name, b.table_name) AS tbl, coalesce(a.column_name, b.column_name) AS column_name,
                         b.spark_type AS old_type, a.spark_type AS new_type
                  FROM b FULL JOIN a ON a.table_name = b.table_name AND a.column_name = b.column_name)
            SELECT tbl AS "table", column_name,
                   CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'dropped' ELSE 'retyped' END AS change,
                   old_type, new_type
            FROM j WHERE old_type IS DISTINCT FROM new_type""",
    ),
}
