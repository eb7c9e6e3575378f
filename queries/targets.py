"""Targets dealt by key, differences between two sides, streaks and repeatable history."""

from pyspark.sql import functions as F

import tidemark as tm
from queries.common import entry, load, plain, work_dir
from queries.monitoring import HISTORY_SQL, _history
from tidemark.plans import monitor
from tidemark.plans.compare import compare_tables
from tidemark.sinks.buckets import BucketedTarget
from tidemark.sinks.snapshot import SnapshotTarget


def scattered_upsert(spark, sf):
    """Orders in buckets take three changes of keys from all over: known and new ones, and some without a key."""
    orders = load(spark, sf, "orders")
    table, keys = BucketedTarget(spark, work_dir(spark), buckets=32), ["o_orderkey"]
    table.merge(table.stage(orders.where("o_orderkey % 100 <> 7")), keys, "o_orderdate")
    for i in (7, 8, 9):
        known = orders.where(f"o_orderkey % 100 = {i}").withColumn("o_totalprice", F.col("o_totalprice") + i)
        nameless = orders.where(f"o_orderkey % 1000 = {i}").withColumn("o_orderkey", F.lit(None).cast("bigint"))
        table.merge(table.stage(known.unionByName(nameless)), keys, "o_orderdate")
    return table.read()


def scattered_counts(spark, sf):
    """What the merges of a table in buckets report, by composite key, with keys that come twice."""
    lines = load(spark, sf, "lineitem")
    table, keys = BucketedTarget(spark, work_dir(spark), buckets=16), ["l_orderkey", "l_linenumber"]
    found = []
    for name, rows in (("first", lines.where("l_orderkey % 3 <> 0")), ("later", lines.where("l_orderkey % 2 = 0")), ("again", lines.where("l_orderkey % 2 = 0"))):
        stats = table.merge(table.stage(rows), keys, "l_shipdate")
        found.append((name, stats.rows_fetched, stats.rows_inserted, stats.rows_updated, stats.rows_superseded, table.read().count()))
    return spark.createDataFrame(
        found, "run string, rows_fetched long, rows_inserted long, rows_updated long, rows_superseded long, rows_held long"
    )


def bucketed_sync_events(spark, sf):
    """Two syncs of the events into a target in buckets; between them the source gains a column and loses one."""
    out, events = work_dir(spark), load(spark, sf, "events")
    day = F.col("ts") <= F.lit("2024-01-15").cast("timestamp_ntz")
    factory = BucketedTarget.factory(8)
    first = tm.FrameSource(spark, {"dbo.events": events.where(day)})
    tm.sync_tables(first, out, [entry("events")], spark=spark, target_factory=factory)
    changed = events.withColumns(
        {"ts": F.when(F.col("event_id") % 10 == 3, F.expr("ts + interval 1 year")).otherwise(F.col("ts")), "kind": F.upper("event_type")}
    ).drop("props")
    later = tm.FrameSource(spark, {"dbo.events": changed})
    tm.sync_tables(later, out, [entry("events")], spark=spark, target_factory=factory)
    return plain(factory(spark, f"{out}/dbo/events").read()).drop("ts")


def differences_found(spark, sf):
    """Line items against a copy that lost some, has others changed, some more, and some twice."""
    lines = load(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    kept = lines.where("l_orderkey % 997 <> 5")
    changed = F.when(F.col("l_partkey") % 499 == 3, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    more = lines.where("l_suppkey % 53 = 2 AND l_linenumber = 1").withColumn("l_linenumber", F.lit(1000))
    copy = kept.withColumn("l_quantity", changed).unionByName(more).unionByName(lines.where("l_orderkey % 1009 = 11"))
    return compare_tables(lines, copy, keys, folder=work_dir(spark), small=1000).rows


def silent_streaks(spark, sf):
    return monitor.silent_streaks(_history(spark, sf))


def repeated_history(spark, sf):
    """The second of three runs is reported twice; the history holds its last report once."""
    out = work_dir(spark)
    for run_id, share in ((1, 3), (2, 5), (3, 7), (2, 11)):
        report = (
            load(spark, sf, "orders").where(f"o_orderkey % {share} = 0").groupBy(F.col("o_orderpriority").alias("table")).agg(F.count(F.lit(1)).alias("rows_fetched"))
        )
        monitor.append_history(report, f"{out}/history", run_id)
    return spark.read.parquet(f"{out}/history").select(F.col("run_id").cast("bigint").alias("run_id"), "table", "rows_fetched")


_LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_EVENTS = """event_id, user_id, event_type, value"""

QUERIES = {
    "scattered_upsert": (
        scattered_upsert,
        """SELECT * REPLACE (CASE WHEN o_orderkey % 100 IN (7, 8, 9) THEN o_totalprice + o_orderkey % 100 ELSE o_totalprice END AS o_totalprice)
           FROM orders
           UNION ALL SELECT * REPLACE (CAST(NULL AS BIGINT) AS o_orderkey) FROM orders WHERE o_orderkey % 1000 IN (7, 8, 9)""",
    ),
    "scattered_counts": (
        scattered_counts,
        """WITH t AS (SELECT *, l_orderkey % 3 <> 0 AS early, l_orderkey % 2 = 0 AS late FROM lineitem),
                c AS (SELECT count_if(early) AS e, count(DISTINCT CASE WHEN early THEN (l_orderkey, l_linenumber) END) AS ek,
                             count_if(late) AS l, count(DISTINCT CASE WHEN late THEN (l_orderkey, l_linenumber) END) AS lk,
                             count(DISTINCT CASE WHEN late AND NOT early THEN (l_orderkey, l_linenumber) END) AS nk FROM t)
           SELECT 'first' AS run, e AS rows_fetched, ek AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, e - ek AS rows_superseded,
                  ek AS rows_held FROM c
           UNION ALL SELECT 'later', l, nk, lk - nk, l - lk, ek + nk FROM c
           UNION ALL SELECT 'again', l, 0, lk, l - lk, ek + nk FROM c""",
    ),
    "bucketed_sync_events": (
        bucketed_sync_events,
        """SELECT event_id, user_id, event_type, value,
                  CASE WHEN ts <= TIMESTAMP '2024-01-15' THEN props END AS props,
                  CASE WHEN ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-15') OR event_id % 10 = 3 THEN upper(event_type) END AS kind
           FROM events""",
    ),
    "differences_found": (
        differences_found,
        f"""WITH copied AS (
              SELECT * REPLACE (CASE WHEN l_partkey % 499 = 3 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM lineitem WHERE l_orderkey % 997 <> 5
              UNION ALL SELECT * REPLACE (CAST(1000 AS INTEGER) AS l_linenumber) FROM lineitem WHERE l_suppkey % 53 = 2 AND l_linenumber = 1
              UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 1009 = 11),
            a AS (SELECT {_LINE_KEYS}, count(*) AS n, list_sort(list(lineitem)) AS held FROM lineitem GROUP BY ALL),
            b AS (SELECT {_LINE_KEYS}, count(*) AS n, list_sort(list(copied)) AS held FROM copied GROUP BY ALL)
            SELECT {_LINE_KEYS}, CASE WHEN b.n IS NULL THEN 'left only' WHEN a.n IS NULL THEN 'right only' ELSE 'changed' END AS difference,
                   coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows
            FROM a FULL JOIN b USING ({_LINE_KEYS}) WHERE a.held IS DISTINCT FROM b.held""",
    ),
    "silent_streaks": (
        silent_streaks,
        f"""WITH h AS (SELECT run_id, tbl, rows_fetched FROM ({HISTORY_SQL})
                       UNION ALL SELECT run_id, '*', sum(rows_fetched) FROM ({HISTORY_SQL}) GROUP BY run_id),
                 n AS (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY run_id)
                               - row_number() OVER (PARTITION BY tbl, rows_fetched = 0 ORDER BY run_id) AS streak FROM h)
            SELECT tbl AS "table", min(run_id) AS first_run, max(run_id) AS last_run, count(*) AS runs FROM n
            WHERE rows_fetched = 0 GROUP BY tbl, streak""",
    ),
    "repeated_history": (
        repeated_history,
        " UNION ALL ".join(
            f"""SELECT CAST({run} AS BIGINT) AS run_id, o_orderpriority AS "table", count(*) AS rows_fetched
                FROM orders WHERE o_orderkey % {share} = 0 GROUP BY ALL"""
            for run, share in ((1, 3), (2, 11), (3, 7))
        ),
    ),
}
