"""Type resolution, exact conversion and text rendering over whole tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries.common import load, plain, ts_text
from tidemark.functions.conform import conform, decimal_fits
from tidemark.functions.render import hex_text, render_text
from tidemark.functions.typemap import describe_schema, resolve, resolve_columns

# Source type names met in a catalog, in several spellings, some of them unmapped.
NAMES = [
    "int", "bigint", "smallint", "tinyint", " INT ", "NVarChar", "real", "float", "money", "smallmoney",
    "decimal", "numeric", "Decimal", "bit", "date", "time", "datetime", "datetime2", "smalldatetime",
    "datetimeoffset", "binary", "varbinary", "image", "timestamp", "rowversion", "char", "varchar", "text",
    "nchar", "ntext", "uniqueidentifier", "xml", "geography", "geometry", "hierarchyid", "sql_variant",
]


def catalog_rows(spark, sf):
    """INFORMATION_SCHEMA-like rows: each order a table, each of its lines a column."""
    names = F.array(*[F.lit(n) for n in NAMES])
    pick = (F.col("l_partkey") % len(NAMES) + 1).cast("int")
    return load(spark, sf, "lineitem").select(
        F.lit("sales").alias("table_schema"),
        F.lit("sales").alias("default_schema"),
        F.concat(F.lit("Order_"), F.col("l_orderkey")).alias("table_name"),
        F.concat_ws("_", F.lit("c"), "l_linenumber", "l_partkey", "l_suppkey").alias("column_name"),
        F.col("l_linenumber").cast("bigint").alias("ordinal_position"),
        F.element_at(names, pick).alias("data_type"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).cast("int").alias("numeric_precision"),
        ((F.col("l_linenumber") - 2) * 3).alias("numeric_scale"),
        "l_orderkey", "l_returnflag", "l_linestatus", "l_shipdate",
    )


NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
CATALOG_SQL = f"""
SELECT 'Order_' || l_orderkey AS table_name,
       'c_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS column_name,
       l_linenumber AS ordinal,
       {NAMES_SQL}[CAST(l_partkey % {len(NAMES)} + 1 AS INTEGER)] AS data_type,
       CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INTEGER) END AS prec,
       (l_linenumber - 2) * 3 AS scale,
       l_orderkey, l_returnflag, l_linestatus, l_shipdate
FROM lineitem"""
SPARK_TYPE_SQL = """
CASE WHEN lower(trim(data_type)) IN ('decimal','numeric') AND prec BETWEEN 1 AND 38 AND scale >= 0 AND scale <= prec
          THEN 'decimal(' || prec || ',' || scale || ')'
     WHEN lower(trim(data_type)) IN ('tinyint','smallint') THEN 'smallint'
     WHEN lower(trim(data_type)) = 'int' THEN 'int'
     WHEN lower(trim(data_type)) = 'bigint' THEN 'bigint'
     WHEN lower(trim(data_type)) IN ('real','float','money','smallmoney') THEN 'double'
     WHEN lower(trim(data_type)) = 'bit' THEN 'boolean'
     WHEN lower(trim(data_type)) = 'date' THEN 'date'
     WHEN lower(trim(data_type)) IN ('datetime','datetime2','smalldatetime','datetimeoffset') THEN 'timestamp'
     WHEN lower(trim(data_type)) IN ('binary','varbinary','image','timestamp','rowversion') THEN 'binary'
     ELSE 'string' END"""
RECOGNISED_SQL = """
(CASE WHEN lower(trim(data_type)) IN ('decimal','numeric')
      THEN coalesce(prec BETWEEN 1 AND 38 AND scale >= 0 AND scale <= prec, FALSE)
      ELSE lower(trim(data_type)) NOT IN ('geography','geometry','hierarchyid','sql_variant') END)"""


def resolve_types(spark, sf):
    rows = catalog_rows(spark, sf).select(
        "data_type", F.col("numeric_precision").alias("precision"), F.col("numeric_scale").alias("scale")
    )
    return (
        resolve_columns(rows)
        .groupBy("data_type", "precision", "scale", "spark_type", "recognised")
        .agg(F.count(F.lit(1)).alias("columns"))
    )


def conform_decimal_widen(spark, sf):
    raw = load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    return conform(raw, [resolve("o_orderkey", "bigint"), resolve("price", "decimal", 18, 4)])


def conform_decimal_narrow(spark, sf):
    """A narrower column that every value fits: each one checked, none rounded."""
    raw = load(spark, sf, "lineitem").select(
        *["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        F.col("l_extendedprice").cast("decimal(20,6)").alias("price"),
    )
    keys = [resolve(c, "bigint") for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    return conform(raw, [*keys, resolve("l_linenumber", "int"), resolve("price", "numeric", 10, 2)])


def decimal_reject_flags(spark, sf):
    raw = T.DecimalType(18, 4)
    amount = (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")).cast(raw)
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        decimal_fits(amount, raw, T.DecimalType(18, 2)).alias("fits_scale_2"),
        decimal_fits(amount, raw, T.DecimalType(18, 3)).alias("fits_scale_3"),
        decimal_fits(amount, raw, T.DecimalType(7, 4)).alias("fits_precision_7"),
        decimal_fits(amount, raw, T.DecimalType(20, 5)).alias("fits_wider"),
    )


def widen_ints_floats(spark, sf):
    raw = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.col("l_linenumber").cast("tinyint").alias("line"),
        F.col("l_discount").cast("float").alias("discount"),
        F.col("l_extendedprice").cast("decimal(19,4)").alias("price"),
    )
    keys = [resolve(c, "bigint") for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    return conform(
        raw, [*keys, resolve("line", "tinyint"), resolve("discount", "real"), resolve("price", "money")]
    )


def epoch_days_micros(spark, sf):
    """Each event at its time and at the same distance before 1970."""
    events = load(spark, sf, "events")
    before = F.expr("timestamp_ntz'1970-01-01 00:00:00' - (ts - timestamp_ntz'2024-01-01 00:00:00')")
    raw = events.select("event_id", F.col("ts").cast("date").alias("day"), "ts", before.alias("early"))
    typed = conform(
        raw, [resolve("event_id", "bigint"), resolve("day", "date"), resolve("ts", "datetime2"), resolve("early", "datetime")]
    )
    return typed.select(
        "event_id",
        F.unix_date("day").alias("days"),
        F.unix_micros("ts").alias("micros"),
        F.unix_micros("early").alias("early_micros"),
    )


def offset_to_utc(spark, sf):
    """Instants written with offsets, kept and rendered in UTC."""
    offset = F.when(F.col("event_type") == "view", "+02:00").when(F.col("event_type") == "click", "-05:30").otherwise("+00:00")
    raw = load(spark, sf, "events").select(
        "event_id", F.concat(F.col("ts").cast("string"), offset).cast("timestamp").alias("instant")
    )
    typed = conform(raw, [resolve("event_id", "bigint"), resolve("instant", "datetimeoffset")])
    text = render_text(F.col("instant"), T.TimestampType(), "datetimeoffset")
    return plain(typed.withColumn("instant_text", text))


def render_text_orders(spark, sf):
    """Columns of types nobody mapped, each kept as its text."""
    raw = load(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").alias("flag"),
        F.col("o_custkey").cast("int").alias("number"),
        F.col("o_totalprice").alias("price"),
        F.floor("o_totalprice").cast("double").alias("whole"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderdate").alias("at"),
        F.encode("o_orderpriority", "UTF-8").alias("bytes"),
        F.upper(F.concat(F.lit("6f9619ff-8b86-d011-b42d-"), F.lpad(F.hex("o_orderkey"), 12, "0"))).alias("guid"),
    )
    unmapped = ["flag", "number", "price", "whole", "amount", "day", "at", "bytes"]
    return conform(
        raw,
        [resolve("o_orderkey", "bigint"), *[resolve(c, "sql_variant") for c in unmapped], resolve("guid", "uniqueidentifier")],
    )


def render_text_events(spark, sf):
    raw = load(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("micro"),
        F.date_trunc("millisecond", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("milli"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("second"),
        F.date_format(F.col("ts"), "HH:mm:ss.SSSSSS").alias("time_of_day"),
    )
    return conform(
        raw,
        [resolve("event_id", "bigint"), *[resolve(c, "hierarchyid") for c in ("micro", "milli", "second")],
         resolve("time_of_day", "time")],
    )


def hex_documents(spark, sf):
    return load(spark, sf, "documents").select("doc_id", hex_text(F.encode("text", "UTF-8")).alias("text_hex"))


def text_fallback_embeddings(spark, sf):
    """A type without any mapping becomes text; every element can be read back from it."""
    vectors = load(spark, sf, "embeddings")
    typed = conform(vectors, describe_schema(vectors.schema))
    elements = F.split(F.expr("substring(embedding, 2, length(embedding) - 2)"), ", ")
    return typed.select("vec_id", "label", F.posexplode(elements).alias("place", "value")).select(
        "vec_id", "label", "place", F.col("value").cast("float").cast("double").alias("value")
    )


QUERIES = {
    "resolve_types": (
        resolve_types,
        f"""SELECT data_type, prec AS precision, scale, {SPARK_TYPE_SQL} AS spark_type, {RECOGNISED_SQL} AS recognised,
                   count(*) AS columns
            FROM ({CATALOG_SQL}) GROUP BY ALL""",
    ),
    "conform_decimal_widen": (
        conform_decimal_widen,
        "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS price FROM orders",
    ),
    "conform_decimal_narrow": (
        conform_decimal_narrow,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  CAST(CAST(l_extendedprice AS DECIMAL(20,6)) AS DECIMAL(10,2)) AS price FROM lineitem""",
    ),
    "decimal_reject_flags": (
        decimal_reject_flags,
        """WITH a AS (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                                     AS DECIMAL(18,4)) AS v FROM lineitem)
           SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  v * 100 = floor(v * 100) AS fits_scale_2, v * 1000 = floor(v * 1000) AS fits_scale_3,
                  abs(v) < 1000 AS fits_precision_7, TRUE AS fits_wider
           FROM a""",
    ),
    "widen_ints_floats": (
        widen_ints_floats,
        """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS SMALLINT) AS line,
                  CAST(CAST(l_discount AS REAL) AS DOUBLE) AS discount,
                  CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS price
           FROM lineitem""",
    ),
    "epoch_days_micros": (
        epoch_days_micros,
        """SELECT event_id, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS INTEGER) AS days, epoch_us(ts) AS micros,
                  epoch_us(TIMESTAMP '2024-01-01') - epoch_us(ts) AS early_micros
           FROM events""",
    ),
    "offset_to_utc": (
        offset_to_utc,
        f"""WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN ts - INTERVAL 2 HOUR
                              WHEN 'click' THEN ts + INTERVAL 330 MINUTE ELSE ts END AS instant FROM events)
            SELECT event_id, instant, replace({ts_text('instant')}, ' ', 'T') || '+00:00' AS instant_text FROM e""",
    ),
    "render_text_orders": (
        render_text_orders,
        """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS VARCHAR) AS flag, CAST(CAST(o_custkey AS INTEGER) AS VARCHAR) AS number,
                  regexp_replace(CAST(o_totalprice AS VARCHAR), '\\.0$', '') AS price,
                  CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS whole,
                  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS amount,
                  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
                  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at,
                  lower(hex(encode(o_orderpriority))) AS bytes,
                  '6f9619ff-8b86-d011-b42d-' || lower(lpad(hex(o_orderkey), 12, '0')) AS guid
           FROM orders""",
    ),
    "render_text_events": (
        render_text_events,
        f"""WITH e AS (SELECT event_id, ts, date_trunc('millisecond', ts) AS ms, date_trunc('second', ts) AS sec FROM events)
            SELECT event_id, {ts_text('ts')} AS micro, {ts_text('ms')} AS milli, {ts_text('sec')} AS second,
                   substr({ts_text('ts')}, 12) AS time_of_day
            FROM e""",
    ),
    "hex_documents": (hex_documents, "SELECT doc_id, lower(hex(encode(text))) AS text_hex FROM documents"),
    "text_fallback_embeddings": (
        text_fallback_embeddings,
        """SELECT vec_id, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS place,
                  CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings""",
    ),
}
