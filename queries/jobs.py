"""Whole jobs: first and later syncs, many tables, handover, forced re-sync, failures."""

from pyspark.sql import functions as F

import tidemark as tm
from queries.common import KEYS, WATERMARKS, entry, load, plain, ts_text, watermark_sql, work_dir
from tidemark.plans.sync import report_frame, report_totals
from tidemark.sinks.checkpoint import CheckpointStore, listing
from tidemark.sinks.snapshot import SnapshotTarget

CUT = "timestamp_ntz'2000-01-01 00:00:00'"


def _target(spark, out, table):
    return plain(SnapshotTarget(spark, f"{out}/dbo/{table}").read())


def _source(spark, sf, *names, **frames):
    return tm.FrameSource(spark, {f"dbo.{n}": load(spark, sf, n) for n in names} | {f"dbo.{n}": f for n, f in frames.items()})


def _stats(report, spark):
    return report_frame(spark, report.tables).select("table", "rows_fetched", "rows_inserted", "rows_updated", "last_value")


def sync_orders_in_two(spark, sf):
    """Rows up to a day, then the rest through the checkpoint and the merge."""
    out, orders = work_dir(spark), load(spark, sf, "orders")
    tm.sync_tables(_source(spark, sf, orders=orders.where(f"o_orderdate <= {CUT}")), out, [entry("orders")], spark=spark)
    tm.sync_tables(_source(spark, sf, orders=orders), out, [entry("orders")], spark=spark)
    return _target(spark, out, "orders")


def sliced_sync_events(spark, sf):
    """Four runs over a growing source; what was changed since comes again and wins."""
    out, events = work_dir(spark), load(spark, sf, "events")
    for day in ("2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01"):
        seen = events.where(F.col("ts") <= F.lit(day).cast("timestamp_ntz"))
        tm.sync_tables(_source(spark, sf, events=seen), out, [entry("events")], spark=spark)
    return _target(spark, out, "events")


def changed_rows_only(spark, sf):
    """After a full sync some orders change at the source: exactly those are fetched."""
    out, orders = work_dir(spark), load(spark, sf, "orders")
    tm.sync_tables(_source(spark, sf, "orders"), out, [entry("orders")], spark=spark)
    touched = F.col("o_orderpriority") == "1-URGENT"
    later = orders.withColumns(
        {
            "o_totalprice": F.when(touched, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")),
            "o_orderdate": F.when(touched, F.expr("o_orderdate + interval 10 years")).otherwise(F.col("o_orderdate")),
        }
    )
    return _stats(tm.sync_tables(_source(spark, sf, orders=later), out, [entry("orders")], spark=spark), spark)


def no_op_sync(spark, sf):
    out = work_dir(spark)
    tables = [entry("orders"), entry("lineitem"), entry("events")]
    source = _source(spark, sf, "orders", "lineitem", "events")
    tm.sync_tables(source, out, tables, spark=spark)
    return _stats(tm.sync_tables(source, out, tables, spark=spark), spark)


def empty_first_sync(spark, sf):
    """Nothing fetched: the target exists, with its schema and no rows, and no checkpoint."""
    out = work_dir(spark)
    nothing = load(spark, sf, "orders").where("o_orderdate > timestamp_ntz'2100-01-01 00:00:00'")
    tm.sync_tables(_source(spark, sf, orders=nothing), out, [entry("orders")], spark=spark)
    return _target(spark, out, "orders")


def null_watermarks_first_sync(spark, sf):
    """Rows without a watermark come with the first sync and never again."""
    out = work_dir(spark)
    orders = load(spark, sf, "orders").withColumn("closed_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    table = entry("orders", watermark_column="closed_at")
    tm.sync_tables(_source(spark, sf, orders=orders.where(f"o_orderdate <= {CUT}")), out, [table], spark=spark)
    tm.sync_tables(_source(spark, sf, orders=orders), out, [table], spark=spark)
    return _target(spark, out, "orders")


def replay_after_crash(spark, sf):
    """The merge was committed, the checkpoint was not: the next run repeats it, harmlessly."""
    out, orders = work_dir(spark), load(spark, sf, "orders")
    tm.sync_tables(_source(spark, sf, orders=orders.where(f"o_orderdate <= {CUT}")), out, [entry("orders")], spark=spark)
    tm.sync_tables(_source(spark, sf, orders=orders), out, [entry("orders")], spark=spark)
    tm.set_checkpoint(out, entry("orders"), "2000-01-01 00:00:00", spark=spark)
    tm.sync_tables(_source(spark, sf, orders=orders), out, [entry("orders")], spark=spark)
    return _target(spark, out, "orders")


def multi_table_report(spark, sf):
    names = ["customer", "orders", "lineitem", "events"]
    report = tm.sync_tables(_source(spark, sf, *names), work_dir(spark), [entry(n) for n in names], spark=spark)
    return _stats(report, spark)


def parallel_sync_report(spark, sf):
    result = tm.sync_tables_distributed(
        _source(spark, sf, *KEYS), work_dir(spark), [entry(n) for n in KEYS], spark=spark
    )
    return report_frame(spark, result["tables"]).select(
        "table", "rows_fetched", "rows_inserted", F.concat_ws(",", "text_fallback_columns").alias("text_fallback_columns")
    )


def parallel_sync_totals(spark, sf):
    """One table's values contradict their declared type: it alone fails."""
    frames = {f"dbo.{n}": load(spark, sf, n) for n in KEYS}
    source = tm.FrameSource(spark, frames, {"dbo.lineitem": {"l_orderkey": ("int",)}})
    result = tm.sync_tables_distributed(
        source, work_dir(spark), [entry(n) for n in KEYS], spark=spark, raise_on_error=False
    )
    return report_totals(report_frame(spark, [*result["tables"], *result["failures"]]))


def progress_events(spark, sf):
    events, names = [], ["nation", "customer", "orders"]
    tm.sync_tables(
        _source(spark, sf, *names), work_dir(spark), [entry(n) for n in names], spark=spark, progress=events.append
    )
    return spark.createDataFrame(events, "table string, tables_done int, total_tables int, rows_fetched bigint")


def checkpoints_view(spark, sf):
    out, names = work_dir(spark), ["customer", "orders", "lineitem", "events"]
    tm.sync_tables(_source(spark, sf, *names), out, [entry(n) for n in names], spark=spark)
    store = CheckpointStore(spark, f"{out}/_streamer_checkpoints")
    return listing(store.view()).drop("synced_at")


def handover(spark, sf):
    """Watermark first, then a bulk load that already holds newer rows, then the sync."""
    out, orders = work_dir(spark), load(spark, sf, "orders")
    then = orders.where(f"o_orderdate <= {CUT}")
    mark = tm.source_watermark(_source(spark, sf, orders=then), entry("orders"), spark=spark)
    during = orders.where("o_orderdate <= timestamp_ntz'2000-03-01 00:00:00'")
    tm.bulk_load(out, entry("orders"), during.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")))
    tm.set_checkpoint(out, entry("orders"), mark, spark=spark)
    report = tm.sync_tables(_source(spark, sf, orders=orders), out, [entry("orders")], spark=spark)
    return _target(spark, out, "orders").withColumn("rows_fetched", F.lit(report.total_rows_fetched).cast("bigint"))


def forced_resync(spark, sf):
    """The target was damaged; forgetting the checkpoint makes the next run repair it."""
    out, customers = work_dir(spark), load(spark, sf, "customer")
    tm.sync_tables(_source(spark, sf, "customer"), out, [entry("customer")], spark=spark)
    tm.bulk_load(out, entry("customer"), customers.where("c_acctbal > 0").withColumn("c_name", F.lit("?")))
    tm.delete_checkpoint(out, entry("customer"), spark=spark)
    tm.sync_tables(_source(spark, sf, "customer"), out, [entry("customer")], spark=spark)
    return _target(spark, out, "customer")


def rebuild_from_source(spark, sf):
    """Orders that have since been deleted at the source leave the target; the next sync is idle."""
    out, orders = work_dir(spark), load(spark, sf, "orders")
    tm.sync_tables(_source(spark, sf, "orders"), out, [entry("orders")], spark=spark)
    left = _source(spark, sf, orders=orders.where("o_orderstatus <> 'F'"))
    tm.rebuild_table(left, out, entry("orders"), spark=spark)
    later = tm.sync_table(left, out, entry("orders"), spark=spark)
    return _target(spark, out, "orders").withColumn("fetched_later", F.lit(later.rows_fetched).cast("bigint"))


def tables_named_like_folders(spark, sf):
    """Tables called after the folders that hold tables, and one whose name goes on from another's."""
    out, names = work_dir(spark), {"dbo.commits": "nation", "dbo.data": "region", "dbo": "supplier", "dbo.orders": "orders"}
    source = tm.FrameSource(spark, {name: load(spark, sf, table) for name, table in names.items()})
    tables = [entry(table) | {"table": name} for name, table in names.items()]
    tm.sync_tables(source, out, tables, spark=spark)
    tm.vacuum(out, tables, spark=spark)
    store = CheckpointStore(spark, f"{out}/_streamer_checkpoints")
    held = {name: SnapshotTarget(spark, f"{out}/{name.replace('.', '/')}").read().count() for name in names}
    rows = spark.createDataFrame(list(held.items()), "table_name string, held_rows bigint")
    return store.view().drop("synced_at").join(rows, "table_name")


def empty_rebuild(spark, sf):
    """Rebuilding a table that has no target yet from an empty source, then syncing it."""
    out, customers = work_dir(spark), load(spark, sf, "customer")
    nothing = _source(spark, sf, customer=customers.where("false"))
    rebuilt = tm.rebuild_table(nothing, out, entry("customer"), spark=spark)
    tm.sync_table(_source(spark, sf, "customer"), out, entry("customer"), spark=spark)
    return _target(spark, out, "customer").withColumn("rebuilt_rows", F.lit(rebuilt.rows_fetched).cast("bigint"))


def one_missing_table(spark, sf):
    """Of all tables, idle by now, one is gone at the source: the others are still found idle.

    ``commits`` counts what a target has committed: one load, and nothing since.
    """
    out, names = work_dir(spark), list(KEYS)
    tm.sync_tables_distributed(_source(spark, sf, *names), out, [entry(n) for n in names], spark=spark)
    left = [n for n in names if n != "nation"]
    again = tm.sync_tables_distributed(
        _source(spark, sf, *left), out, [entry(n) for n in names], spark=spark, raise_on_error=False
    )
    commits = {f"dbo.{n}": SnapshotTarget(spark, f"{out}/dbo/{n}").current().version + 1 for n in names}
    rows = [(r["table"], r.get("rows_fetched"), commits[r["table"]], r["error"] is not None) for r in [*again["tables"], *again["failures"]]]
    return spark.createDataFrame(rows, '"table" string, rows_fetched bigint, commits int, failed boolean'.replace('"', "`"))


def reconcile_double_mark(spark, sf):
    """A watermark of type double reads the same on both sides."""
    out, part = work_dir(spark), entry("part", watermark_column="p_retailprice")
    tm.sync_tables(_source(spark, sf, "part"), out, [part], spark=spark)
    return tm.reconcile(_source(spark, sf, "part"), out, [part], spark=spark).select("table", "source_rows", "target_rows", "in_step")


ORDERS_SQL = "SELECT * FROM orders"


def _first_sync_sql(table):
    return (
        f"SELECT 'dbo.{table}' AS \"table\", count(*) AS rows_fetched, "
        f"count(DISTINCT ({', '.join(KEYS[table])})) AS rows_inserted, "
        f"CAST(0 AS BIGINT) AS rows_updated, {watermark_sql(table)} AS last_value FROM {table}"
    )


QUERIES = {
    "sync_orders_in_two": (sync_orders_in_two, ORDERS_SQL),
    "sliced_sync_events": (sliced_sync_events, "SELECT * FROM events"),
    "changed_rows_only": (
        changed_rows_only,
        f"""WITH l AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 10 YEAR
                                   ELSE o_orderdate END AS w, (SELECT max(o_orderdate) FROM orders) AS m FROM orders)
            SELECT 'dbo.orders' AS "table", count_if(w > m) AS rows_fetched, CAST(0 AS BIGINT) AS rows_inserted,
                   count_if(w > m) AS rows_updated, {ts_text('max(w)')} AS last_value FROM l""",
    ),
    "no_op_sync": (
        no_op_sync,
        " UNION ALL ".join(
            f"SELECT 'dbo.{t}' AS \"table\", CAST(0 AS BIGINT) AS rows_fetched, CAST(0 AS BIGINT) AS rows_inserted, "
            f"CAST(0 AS BIGINT) AS rows_updated, {watermark_sql(t)} AS last_value"
            for t in ("orders", "lineitem", "events")
        ),
    ),
    "empty_first_sync": (empty_first_sync, "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2100-01-01'"),
    "null_watermarks_first_sync": (
        null_watermarks_first_sync,
        """SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS closed_at FROM orders
           WHERE o_orderdate <= TIMESTAMP '2000-01-01' OR o_orderstatus <> 'P'""",
    ),
    "replay_after_crash": (replay_after_crash, ORDERS_SQL),
    "multi_table_report": (
        multi_table_report, " UNION ALL ".join(_first_sync_sql(t) for t in ("customer", "orders", "lineitem", "events")),
    ),
    "parallel_sync_report": (
        parallel_sync_report,
        " UNION ALL ".join(
            f"SELECT 'dbo.{t}' AS \"table\", count(*) AS rows_fetched, "
            f"count(DISTINCT ({', '.join(KEYS[t])})) AS rows_inserted, "
            f"'{'embedding' if t == 'embeddings' else ''}' AS text_fallback_columns FROM {t}"
            for t in KEYS
        ),
    ),
    "parallel_sync_totals": (
        parallel_sync_totals,
        "SELECT CAST(14 AS BIGINT) AS tables, CAST(1 AS BIGINT) AS failed, n AS total_rows_fetched, n AS total_rows_inserted, "
        "CAST(0 AS BIGINT) AS total_rows_updated FROM (SELECT CAST("
        + " + ".join(f"(SELECT count(*) FROM {t})" for t in KEYS if t != "lineitem")
        + " AS BIGINT) AS n)",
    ),
    "progress_events": (
        progress_events,
        """WITH n AS (SELECT (SELECT count(*) FROM nation) AS a, (SELECT count(*) FROM customer) AS b,
                             (SELECT count(*) FROM orders) AS c)
           SELECT 'dbo.nation' AS "table", 1 AS tables_done, 3 AS total_tables, a AS rows_fetched FROM n
           UNION ALL SELECT 'dbo.customer', 2, 3, a + b FROM n
           UNION ALL SELECT 'dbo.orders', 3, 3, a + b + c FROM n""",
    ),
    "checkpoints_view": (
        checkpoints_view,
        " UNION ALL ".join(
            f"SELECT 'dbo.{t}' AS table_name, '{WATERMARKS[t]}' AS watermark_column, {watermark_sql(t)} AS last_value"
            for t in ("customer", "orders", "lineitem", "events")
        ),
    ),
    "handover": (
        handover,
        "SELECT *, (SELECT count(*) FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01') AS rows_fetched FROM orders",
    ),
    "forced_resync": (forced_resync, "SELECT * FROM customer"),
    "tables_named_like_folders": (
        tables_named_like_folders,
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{WATERMARKS[t]}' AS watermark_column, {watermark_sql(t)} AS last_value, "
            f"(SELECT count(*) FROM {t}) AS held_rows"
            for name, t in {"dbo.commits": "nation", "dbo.data": "region", "dbo": "supplier", "dbo.orders": "orders"}.items()
        ),
    ),
    "empty_rebuild": (empty_rebuild, "SELECT *, CAST(0 AS BIGINT) AS rebuilt_rows FROM customer"),
    "one_missing_table": (
        one_missing_table,
        " UNION ALL ".join(
            f"SELECT 'dbo.{t}' AS \"table\", CAST({'NULL' if t == 'nation' else '0'} AS BIGINT) AS rows_fetched, "
            f"1 AS commits, {'true' if t == 'nation' else 'false'} AS failed"
            for t in KEYS
        ),
    ),
    "reconcile_double_mark": (
        reconcile_double_mark,
        "SELECT 'dbo.part' AS \"table\", count(*) AS source_rows, count(*) AS target_rows, true AS in_step FROM part",
    ),
    "rebuild_from_source": (
        rebuild_from_source,
        "SELECT *, CAST(0 AS BIGINT) AS fetched_later FROM orders WHERE o_orderstatus <> 'F'",
    ),
}
