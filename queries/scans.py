"""Scans, predicates, watermarks and checkpoints' listings."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queries.common import KEYS, WATERMARKS, load, plain, ts_text, watermark_sql
from tidemark.functions.conform import conform
from tidemark.functions.typemap import describe_schema
from tidemark.operators.scan import full_scan, incremental_scan, source_watermark

CUT = "2000-01-01 00:00:00"


def full_scan_orders(spark, sf):
    orders = full_scan(load(spark, sf, "orders"))
    return plain(conform(orders, describe_schema(orders.schema)))


def ordered_scan_lineitem(spark, sf):
    return full_scan(load(spark, sf, "lineitem"), "l_shipdate", ordered=True)


def incremental_scan_orders(spark, sf):
    return incremental_scan(load(spark, sf, "orders"), "o_orderdate", CUT)


def incremental_scan_events(spark, sf):
    return incremental_scan(load(spark, sf, "events"), "ts", "2024-01-15 06:30:00.123456")


def _with_gaps(spark, sf):
    """Orders whose watermark is NULL while they are still in progress."""
    return load(spark, sf, "orders").withColumn(
        "closed_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    )


def incremental_scan_null_watermark(spark, sf):
    return incremental_scan(_with_gaps(spark, sf), "closed_at", CUT)


def strict_tie_excluded(spark, sf):
    orders = load(spark, sf, "orders")
    newest = source_watermark(orders, "o_orderdate").first()["watermark"]
    later = incremental_scan(orders, "o_orderdate", newest).agg(F.count(F.lit(1)).alias("rows_after"))
    tied = orders.agg(F.max_by(F.lit(newest), "o_orderdate").alias("newest"),
                      F.count(F.when(F.col("o_orderdate") == F.lit(newest).cast("timestamp_ntz"), 1)).alias("rows_tied"))
    # Two one-row aggregates side by side.
    return tied.withColumn("rows_after", later.scalar())


def source_watermarks(spark, sf):
    each = [
        source_watermark(load(spark, sf, t), WATERMARKS[t]).select(F.lit(t).alias("table_name"), "watermark")
        for t in KEYS
    ]
    return reduce(DataFrame.unionByName, each)


def source_watermark_of_nothing(spark, sf):
    later = load(spark, sf, "orders").where(F.col("o_orderdate") > F.lit("2100-01-01").cast("timestamp_ntz"))
    return source_watermark(later, "o_orderdate")


def described_types(spark, sf):
    """Every row of every column of orders, read through its description, counted per type."""
    orders = load(spark, sf, "orders")
    columns = describe_schema(orders.schema, {"o_totalprice": ("money",)})
    counts = [
        conform(orders, [c]).agg(F.count(F.col(c.name)).alias("filled")).select(
            F.lit(i).alias("ordinal"), F.lit(c.name).alias("column_name"), F.lit(c.source_type).alias("source_type"),
            F.lit(c.spark_type.simpleString()).alias("spark_type"), "filled",
        )
        for i, c in enumerate(columns, start=1)
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("ordinal")


QUERIES = {
    "full_scan_orders": (full_scan_orders, "SELECT * FROM orders"),
    "ordered_scan_lineitem": (ordered_scan_lineitem, "SELECT * FROM lineitem ORDER BY l_shipdate"),
    "incremental_scan_orders": (incremental_scan_orders, f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{CUT}'"),
    "incremental_scan_events": (
        incremental_scan_events,
        "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 06:30:00.123456'",
    ),
    "incremental_scan_null_watermark": (
        incremental_scan_null_watermark,
        f"""SELECT * FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS closed_at FROM orders)
            WHERE closed_at > TIMESTAMP '{CUT}'""",
    ),
    "strict_tie_excluded": (
        strict_tie_excluded,
        f"""WITH m AS (SELECT max(o_orderdate) AS w FROM orders)
            SELECT {ts_text('(SELECT w FROM m)')} AS newest,
                   (SELECT count(*) FROM orders, m WHERE o_orderdate = w) AS rows_tied,
                   (SELECT count(*) FROM orders, m WHERE o_orderdate > w) AS rows_after""",
    ),
    "source_watermarks": (
        source_watermarks,
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, {watermark_sql(t)} AS watermark" for t in KEYS),
    ),
    "source_watermark_of_nothing": (
        source_watermark_of_nothing,
        "SELECT CAST(max(o_orderdate) AS VARCHAR) AS watermark FROM orders WHERE o_orderdate > TIMESTAMP '2100-01-01'",
    ),
    "described_types": (
        described_types,
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, '{s}' AS source_type, '{t}' AS spark_type, "
            f"count({c}) AS filled FROM orders"
            for i, (c, s, t) in enumerate(
                [
                    ("o_orderkey", "bigint", "bigint"),
                    ("o_custkey", "bigint", "bigint"),
                    ("o_orderstatus", "nvarchar", "string"),
                    ("o_totalprice", "money", "double"),
                    ("o_orderdate", "datetime2", "timestamp"),
                    ("o_orderpriority", "nvarchar", "string"),
                ],
                start=1,
            )
        ),
    ),
}
