"""Reconciliation and run-history alerts. The history is that of the orders and events:
a run for each day, a table for each order priority or event type."""

from pyspark.sql import functions as F

import tidemark as tm
from queries.common import KEYS, WATERMARKS, entry, load, watermark_sql, work_dir
from tidemark.plans import monitor
from tidemark.plans.sync import report_frame
from tidemark.sinks.snapshot import SnapshotTarget


def _history(spark, sf):
    """Orders by day and priority. Large ones count as fetched, so that many runs are quiet."""
    return (
        load(spark, sf, "orders")
        .groupBy(
            F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("bigint").alias("run_id"),
            F.col("o_orderpriority").alias("table"),
        )
        .agg(
            F.count(F.when(F.col("o_totalprice") > 450_000, 1)).alias("rows_fetched"),
            F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("rows_inserted"),
            F.count(F.when(F.col("o_orderstatus") != "F", 1)).alias("rows_updated"),
            F.array_sort(F.collect_set("o_orderstatus")).alias("text_fallback_columns"),
            F.max("o_orderstatus").alias("last_value"),
        )
    )


def _event_history(spark, sf):
    return (
        load(spark, sf, "events")
        .groupBy(F.dayofyear("ts").cast("bigint").alias("run_id"), F.col("event_type").alias("table"))
        .agg(F.count(F.lit(1)).alias("rows_fetched"))
    )


UNTIL = {
    "orders": "o_orderdate <= timestamp_ntz'2001-01-01 00:00:00'",
    "events": "ts <= timestamp_ntz'2024-01-20 00:00:00'",
    "customer": "true",
}


def _behind(spark, sf):
    """Targets that stopped a while ago; the folder they are in."""
    out = work_dir(spark)
    source = tm.FrameSource(spark, {f"dbo.{n}": load(spark, sf, n).where(rule) for n, rule in UNTIL.items()})
    tm.sync_tables(source, out, [entry(n) for n in UNTIL], spark=spark)
    return out


def reconcile_all(spark, sf):
    source = tm.FrameSource(spark, {f"dbo.{n}": load(spark, sf, n) for n in KEYS})
    return tm.reconcile(source, _behind(spark, sf), [entry(n) for n in KEYS], spark=spark)


def reconcile_tables(spark, sf):
    out = _behind(spark, sf)
    return monitor.reconcile(
        {
            f"dbo.{n}": (load(spark, sf, n), SnapshotTarget(spark, f"{out}/dbo/{n}").read(), WATERMARKS[n])
            for n in UNTIL
        }
    )


def run_history(spark, sf):
    """Two runs over all tables, appended to the history."""
    out, source = work_dir(spark), tm.FrameSource(spark, {f"dbo.{n}": load(spark, sf, n) for n in KEYS})
    for run_id in (1, 2):
        report = tm.sync_tables(source, out, [entry(n) for n in KEYS], spark=spark)
        monitor.append_history(report_frame(spark, report.tables), f"{out}/_history", run_id)
    return spark.read.parquet(f"{out}/_history").select(F.col("run_id").cast("bigint").alias("run_id"), "table", "rows_fetched", "rows_inserted", "rows_updated")


def stalled_checkpoints(spark, sf):
    return monitor.stalled_checkpoints(_history(spark, sf), 3)


def unusual_volume(spark, sf):
    return monitor.unusual_volume(_event_history(spark, sf), 7, 2.0).select("table", "run_id", "rows_fetched")


def silent_runs(spark, sf):
    return monitor.silent_runs(_history(spark, sf), 2)


def new_text_fallbacks(spark, sf):
    return monitor.new_text_fallbacks(_history(spark, sf)).withColumn("new_fallbacks", F.concat_ws(",", "new_fallbacks"))


def update_heavy_tables(spark, sf):
    return monitor.update_heavy_tables(_history(spark, sf), 1.98)


HISTORY_SQL = """
SELECT CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS BIGINT) AS run_id, o_orderpriority AS tbl,
       count_if(o_totalprice > 450000) AS rows_fetched, count_if(o_orderstatus = 'F') AS rows_inserted,
       count_if(o_orderstatus <> 'F') AS rows_updated, list_sort(list(DISTINCT o_orderstatus)) AS fallbacks,
       max(o_orderstatus) AS last_value
FROM orders GROUP BY 1, 2"""


def _side(table, where):
    column = WATERMARKS[table]
    return (
        f"SELECT 'dbo.{table}' AS \"table\", count(*) AS source_rows, count_if({where}) AS target_rows, "
        f"CAST(max({column}) AS VARCHAR) AS source_newest, CAST(max({column}) FILTER (WHERE {where}) AS VARCHAR) AS target_newest, "
        f"count(*) - count_if({where}) AS missing_rows, max({column}) = max({column}) FILTER (WHERE {where}) AS in_step FROM {table}"
    )


def _reconciled(table):
    """SQL: a table whose target holds the rows of UNTIL, or nothing."""
    where = UNTIL.get(table, "false").replace("timestamp_ntz", "TIMESTAMP ")
    newest = watermark_sql(table)
    old = newest[:-1] + f" WHERE {where})"
    return (
        f"SELECT 'dbo.{table}' AS \"table\", count(*) AS source_rows, count_if({where}) AS target_rows, "
        f"{newest} AS source_newest, {old} AS target_newest, count(*) - count_if({where}) AS missing_rows, "
        f"coalesce({newest} = {old}, FALSE) AS in_step FROM {table}"
    )


QUERIES = {
    "reconcile_all": (reconcile_all, " UNION ALL ".join(_reconciled(t) for t in KEYS)),
    "reconcile_tables": (
        reconcile_tables,
        " UNION ALL ".join(
            [
                _side("orders", "o_orderdate <= TIMESTAMP '2001-01-01'"),
                _side("events", "ts <= TIMESTAMP '2024-01-20'"),
                _side("customer", "TRUE"),
            ]
        ),
    ),
    "run_history": (
        run_history,
        " UNION ALL ".join(
            f"SELECT CAST({run} AS BIGINT) AS run_id, 'dbo.{t}' AS \"table\", {n} AS rows_fetched, "
            f"count(DISTINCT ({', '.join(KEYS[t])})) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated FROM {t}"
            if run == 1
            else f"SELECT CAST(2 AS BIGINT), 'dbo.{t}', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)"
            for run, n in ((1, "count(*)"), (2, "0"))
            for t in KEYS
        ),
    ),
    "stalled_checkpoints": (
        stalled_checkpoints,
        f"""SELECT tbl AS "table", run_id, last_value FROM (
              SELECT *, lag(last_value, 3) OVER w AS before, row_number() OVER w AS n FROM ({HISTORY_SQL})
              WINDOW w AS (PARTITION BY tbl ORDER BY run_id))
            WHERE n > 3 AND last_value IS NOT DISTINCT FROM before""",
    ),
    "unusual_volume": (
        unusual_volume,
        """WITH h AS (SELECT dayofyear(ts) AS run_id, event_type AS tbl, count(*) AS rows_fetched FROM events GROUP BY 1, 2),
                s AS (SELECT *, avg(rows_fetched) OVER w AS m, stddev_pop(rows_fetched) OVER w AS sd, count(*) OVER w AS n FROM h
                      WINDOW w AS (PARTITION BY tbl ORDER BY run_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
           SELECT tbl AS "table", CAST(run_id AS BIGINT) AS run_id, rows_fetched FROM s WHERE n = 7 AND rows_fetched > m + 2 * sd""",
    ),
    "silent_runs": (
        silent_runs,
        f"""WITH q AS (SELECT run_id, sum(rows_fetched) OVER w AS s, count(*) OVER w AS n FROM ({HISTORY_SQL})
                       WINDOW w AS (PARTITION BY tbl ORDER BY run_id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))
            SELECT run_id, count(*) AS tables FROM q GROUP BY run_id HAVING max(s) = 0 AND min(n) = 2""",
    ),
    "new_text_fallbacks": (
        new_text_fallbacks,
        f"""SELECT tbl AS "table", run_id, array_to_string([x FOR x IN fallbacks IF NOT list_contains(before, x)], ',')
                     AS new_fallbacks
            FROM (SELECT *, lag(fallbacks) OVER (PARTITION BY tbl ORDER BY run_id) AS before FROM ({HISTORY_SQL}))
            WHERE before IS NOT NULL AND len([x FOR x IN fallbacks IF NOT list_contains(before, x)]) > 0""",
    ),
    "update_heavy_tables": (
        update_heavy_tables,
        f"""SELECT tbl AS "table", CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
                   CAST(sum(rows_updated) AS BIGINT) AS rows_updated
            FROM ({HISTORY_SQL}) GROUP BY tbl HAVING sum(rows_updated) > 1.98 * greatest(sum(rows_inserted), 1)""",
    ),
}
