"""The upsert: matches, inserts, kept rows, NULL keys, ties, replays and counts."""

from pyspark.sql import functions as F

from queries.common import KEYS, load, work_dir
from tidemark.operators.upsert import last_writer, upsert, upsert_metrics
from tidemark.sinks.snapshot import SnapshotTarget

EARLY = "timestamp_ntz'2000-07-01 00:00:00'"
LATE = "timestamp_ntz'1999-12-31 00:00:00'"


def _orders(spark, sf):
    """Orders up to a day, and a delta that overlaps them by half a year with new prices."""
    orders = load(spark, sf, "orders")
    target = orders.where(f"o_orderdate <= {EARLY}")
    delta = orders.where(f"o_orderdate > {LATE}").withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    return target, delta


def _write(spark, target, *deltas, keys, watermark):
    """The same through the table on disk: one load, then one merge per delta."""
    table = SnapshotTarget(spark, work_dir(spark))
    table.publish(target)
    for delta in deltas:
        table.merge(table.stage(delta), keys, watermark)
    return table.read()


def upsert_orders(spark, sf):
    return upsert(*_orders(spark, sf), ["o_orderkey"])


def upsert_orders_table(spark, sf):
    target, delta = _orders(spark, sf)
    return _write(spark, target, delta, keys=["o_orderkey"], watermark="o_orderdate")


def upsert_replay(spark, sf):
    target, delta = _orders(spark, sf)
    return _write(spark, target, delta, delta, keys=["o_orderkey"], watermark="o_orderdate")


def upsert_metrics_orders(spark, sf):
    return upsert_metrics(*_orders(spark, sf), ["o_orderkey"])


def _conversations(spark, sf):
    turns = load(spark, sf, "conversations")
    target = turns.where("turn <= 3")
    delta = turns.where("turn >= 2").withColumn("text", F.concat(F.lit("edited: "), "text"))
    return target, delta


def upsert_composite_key(spark, sf):
    return upsert(*_conversations(spark, sf), KEYS["conversations"])


def upsert_composite_key_table(spark, sf):
    target, delta = _conversations(spark, sf)
    return _write(spark, target, delta, keys=KEYS["conversations"], watermark="turn")


def _null_keys(spark, sf):
    """A third of the orders have no key yet: they match nothing, on either side."""
    orders = load(spark, sf, "orders").withColumn("ref", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")))
    target = orders.where(f"o_orderdate <= {EARLY}")
    return target, orders.where(f"o_orderdate > {LATE}").withColumn("o_totalprice", F.col("o_totalprice") + 1000)


def upsert_null_key(spark, sf):
    return upsert(*_null_keys(spark, sf), ["ref"])


def upsert_null_key_table(spark, sf):
    target, delta = _null_keys(spark, sf)
    return _write(spark, target, delta, keys=["ref"], watermark="o_orderdate")


def upsert_lineitem_table(spark, sf):
    lines = load(spark, sf, "lineitem")
    target = lines.where(f"l_shipdate <= {EARLY}")
    delta = lines.where(f"l_shipdate > {LATE}").withColumn("l_quantity", F.col("l_quantity") + 50)
    return _write(spark, target, delta, keys=KEYS["lineitem"], watermark="l_shipdate")


def upsert_documents_table(spark, sf):
    """Whole texts pass through the merge: the longer documents come back changed."""
    documents = load(spark, sf, "documents")
    delta = documents.where("lang <> 'en'").withColumn("text", F.concat("text", F.lit(" [checked]")))
    return _write(spark, documents, delta, keys=["doc_id"], watermark="doc_id")


def last_writer_events(spark, sf):
    return last_writer(load(spark, sf, "events"), ["user_id"], "ts")


def last_writer_lineitem(spark, sf):
    return last_writer(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


def repeated_keys_in_one_fetch(spark, sf):
    """All events merged by user in one go: the table ends with each user's latest."""
    table = SnapshotTarget(spark, work_dir(spark))
    events = load(spark, sf, "events")
    stats = table.merge(table.stage(events), ["user_id"], "ts")
    return table.read().select("user_id", "event_id", "ts", "event_type", "value").withColumn(
        "rows_superseded", F.lit(stats.rows_superseded).cast("bigint")
    )


def new_source_column(spark, sf):
    """A column that appears at the source is added; rows synced before have NULL there."""
    orders = load(spark, sf, "orders")
    target = orders.where(f"o_orderdate <= {EARLY}").drop("o_orderpriority")
    return _write(spark, target, orders.where(f"o_orderdate > {LATE}"), keys=["o_orderkey"], watermark="o_orderdate")


def dropped_source_column(spark, sf):
    """A column that leaves the source keeps its value in rows already there."""
    orders = load(spark, sf, "orders")
    delta = orders.where(f"o_orderdate > {LATE}").drop("o_orderpriority")
    return _write(spark, orders.where(f"o_orderdate <= {EARLY}"), delta, keys=["o_orderkey"], watermark="o_orderdate")


def merges_by_scattered_keys(spark, sf):
    """A key-ordered table takes three changes of keys from all over it, the first of new ones."""
    lines = load(spark, sf, "orders")
    table = SnapshotTarget(spark, work_dir(spark))
    keys = ["o_orderkey"]
    first = table.stage_by_key(lines.where("o_orderkey % 100 <> 7"), keys)
    table.commit(table.open(lines.schema), lines.schema, first.runs)
    for i in (7, 8, 9):
        delta = lines.where(f"o_orderkey % 100 = {i}").withColumn("o_totalprice", F.col("o_totalprice") + i)
        table.merge(table.stage(delta), keys, "o_orderdate")
    return table.read()


def few_repeated_keys(spark, sf):
    """A first load in which one order in a hundred comes twice, the later row with another price."""
    orders = load(spark, sf, "orders")
    again = orders.where("o_orderkey % 100 = 3").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 5, "o_orderdate": F.expr("o_orderdate + interval 1 day")}
    )
    table = SnapshotTarget(spark, work_dir(spark))
    stats = table.merge(table.stage(orders.unionByName(again)), ["o_orderkey"], "o_orderdate")
    return table.read().withColumn("rows_superseded", F.lit(stats.rows_superseded).cast("bigint"))


def dotted_columns(spark, sf):
    """Column names with a dot, in key, watermark and data, through two merges."""
    names = {"o_orderkey": "order.key", "o_orderdate": "changed.at", "o_totalprice": "price.total"}
    target, delta = _orders(spark, sf)
    dotted = lambda df: df.withColumnsRenamed(names)
    table = SnapshotTarget(spark, work_dir(spark))
    for part in (target, delta.unionByName(delta)):
        table.merge(table.stage(dotted(part)), ["order.key"], "changed.at")
    return table.read().withColumnsRenamed({new: old for old, new in names.items()})


def clean_up(spark, sf):
    """After several merges the clean-up leaves the table as it was. Its files are younger than the
    window, so this shows that nothing is removed too early; what is removed is shown in the tests."""
    target, delta = _orders(spark, sf)
    table = SnapshotTarget(spark, work_dir(spark))
    table.publish(target)
    for _ in range(2):
        table.merge(table.stage(delta), ["o_orderkey"], "o_orderdate")
    table.vacuum()
    return table.read()


def rebuild(spark, sf):
    """A target with rows long gone from the source, replaced as a whole by a full scan."""
    customers = load(spark, sf, "customer")
    table = SnapshotTarget(spark, work_dir(spark))
    table.publish(customers.withColumn("c_custkey", F.col("c_custkey") + 1_000_000))
    table.publish(customers)
    return table.read()


SPLIT_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate > TIMESTAMP '1999-12-31' THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders"""
TURNS_SQL = """
SELECT conv_id, turn, role, CASE WHEN turn >= 2 THEN 'edited: ' || text ELSE text END AS text FROM conversations"""
NULL_KEY_SQL = """
WITH o AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS ref FROM orders),
     t AS (SELECT * FROM o WHERE o_orderdate <= TIMESTAMP '2000-07-01'),
     d AS (SELECT * REPLACE (o_totalprice + 1000 AS o_totalprice) FROM o WHERE o_orderdate > TIMESTAMP '1999-12-31')
SELECT * FROM t WHERE ref IS NULL OR ref NOT IN (SELECT ref FROM d WHERE ref IS NOT NULL)
UNION ALL SELECT * FROM d"""

QUERIES = {
    "upsert_orders": (upsert_orders, SPLIT_SQL),
    "upsert_orders_table": (upsert_orders_table, SPLIT_SQL),
    "upsert_replay": (upsert_replay, SPLIT_SQL),
    "upsert_metrics_orders": (
        upsert_metrics_orders,
        """SELECT count_if(o_orderdate > TIMESTAMP '1999-12-31') AS rows_fetched,
                  count_if(o_orderdate > TIMESTAMP '2000-07-01') AS rows_inserted,
                  count_if(o_orderdate > TIMESTAMP '1999-12-31' AND o_orderdate <= TIMESTAMP '2000-07-01') AS rows_updated,
                  count_if(o_orderdate <= TIMESTAMP '1999-12-31') AS rows_kept
           FROM orders""",
    ),
    "upsert_composite_key": (upsert_composite_key, TURNS_SQL),
    "upsert_composite_key_table": (upsert_composite_key_table, TURNS_SQL),
    "upsert_null_key": (upsert_null_key, NULL_KEY_SQL),
    "upsert_null_key_table": (upsert_null_key_table, NULL_KEY_SQL),
    "upsert_lineitem_table": (
        upsert_lineitem_table,
        """WITH t AS (SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-07-01'),
                d AS (SELECT * REPLACE (l_quantity + 50 AS l_quantity) FROM lineitem WHERE l_shipdate > TIMESTAMP '1999-12-31'
                      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
                                                 ORDER BY l_shipdate DESC, l_quantity DESC) = 1)
           SELECT * FROM t ANTI JOIN d USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
           UNION ALL SELECT d.* FROM t JOIN d USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
           UNION ALL SELECT * FROM d ANTI JOIN t USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)""",
    ),
    "upsert_documents_table": (
        upsert_documents_table,
        "SELECT * REPLACE (CASE WHEN lang <> 'en' THEN text || ' [checked]' ELSE text END AS text) FROM documents",
    ),
    "last_writer_events": (
        last_writer_events,
        "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1",
    ),
    "last_writer_lineitem": (
        last_writer_lineitem,
        """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    ),
    "repeated_keys_in_one_fetch": (
        repeated_keys_in_one_fetch,
        """SELECT user_id, event_id, ts, event_type, value,
                  (SELECT count(*) - count(DISTINCT user_id) FROM events) AS rows_superseded
           FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    ),
    "new_source_column": (
        new_source_column,
        """SELECT * REPLACE (CASE WHEN o_orderdate > TIMESTAMP '1999-12-31' THEN o_orderpriority END AS o_orderpriority)
           FROM orders""",
    ),
    "dropped_source_column": (
        dropped_source_column,
        """SELECT * REPLACE (CASE WHEN o_orderdate <= TIMESTAMP '2000-07-01' THEN o_orderpriority END AS o_orderpriority)
           FROM orders""",
    ),
    "merges_by_scattered_keys": (
        merges_by_scattered_keys,
        """SELECT * REPLACE (o_totalprice + CASE WHEN o_orderkey % 100 IN (7, 8, 9) THEN o_orderkey % 100 ELSE 0 END AS o_totalprice)
           FROM orders""",
    ),
    "few_repeated_keys": (
        few_repeated_keys,
        """SELECT * REPLACE (CASE WHEN o_orderkey % 100 = 3 THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice,
                             CASE WHEN o_orderkey % 100 = 3 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate),
                  (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 3) AS rows_superseded FROM orders""",
    ),
    "dotted_columns": (dotted_columns, SPLIT_SQL),
    "clean_up": (clean_up, SPLIT_SQL),
    "rebuild": (rebuild, "SELECT * FROM customer"),
}
