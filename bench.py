"""Times the headline jobs on the test tables and prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. After one untimed
pass, everything runs $BENCH_PASSES (default 3) times, each into fresh targets; a figure is
the median of its passes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import tidemark as tm  # noqa: E402
from queries import catalogs, monitoring, types, upserts  # noqa: E402
from queries.common import KEYS, entry, load  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession) -> tuple[dict[str, float], dict[str, int]]:
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    out = tempfile.mkdtemp(prefix="tidemark-bench-")
    frames = {f"dbo.{t}": load(spark, SF_DIR, t) for t in KEYS}
    # The test tables are single files of one row group, so full scans are spread over the cores.
    source = tm.FrameSource(spark, frames, spread=True)
    lines, one = frames["dbo.lineitem"], [entry("lineitem")]
    everything = [entry(t) for t in KEYS]

    first = timed("full_load_lineitem", lambda: tm.sync_tables(source, out, one, spark=spark))
    rows["full_load_lineitem"] = first.total_rows_fetched
    timed("no_op_lineitem", lambda: tm.sync_tables(source, out, one, spark=spark))

    # One month of shipments, about one row in a hundred, changes and gets a newer watermark.
    month = F.col("l_shipdate").between("1998-05-01", "1998-05-31")
    changed = lines.withColumns(
        {
            "l_quantity": F.when(month, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")),
            "l_shipdate": F.when(month, F.expr("timestamp_ntz'2002-01-01 00:00:00'")).otherwise(F.col("l_shipdate")),
        }
    )
    later = tm.FrameSource(spark, {"dbo.lineitem": changed})
    rows["delta_upsert_lineitem"] = timed(
        "delta_upsert_lineitem", lambda: tm.sync_tables(later, out, one, spark=spark)
    ).total_rows_fetched

    # One row in a hundred, from all over the table.
    scattered = F.col("l_orderkey") % 100 == 17
    spread_out = changed.withColumn(
        "l_shipdate", F.when(scattered, F.expr("timestamp_ntz'2003-01-01 00:00:00'")).otherwise(F.col("l_shipdate"))
    )
    random_keys = tm.FrameSource(spark, {"dbo.lineitem": spread_out})
    rows["scattered_upsert_lineitem"] = timed(
        "scattered_upsert_lineitem", lambda: tm.sync_tables(random_keys, out, one, spark=spark)
    ).total_rows_fetched

    lake = tempfile.mkdtemp(prefix="tidemark-bench-")
    rows["full_load_all_tables"] = timed(
        "full_load_all_tables", lambda: tm.sync_tables_distributed(source, lake, everything, spark=spark)
    )["total_rows_fetched"]
    timed("no_op_all_tables", lambda: tm.sync_tables_distributed(source, lake, everything, spark=spark))
    missing = tm.FrameSource(spark, {n: f for n, f in frames.items() if n != "dbo.nation"})
    timed(
        "no_op_one_missing",
        lambda: tm.sync_tables_distributed(missing, lake, everything, spark=spark, raise_on_error=False),
    )
    timed("preflight_all_tables", lambda: tm.preflight(source, everything, output_uri=lake, spark=spark))

    timed("reconcile_all_tables", lambda: tm.reconcile(source, lake, everything, spark=spark).collect())

    def drain(query):
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

    for name, query in {
        "upsert_orders": upserts.upsert_orders,
        "last_writer_lineitem": upserts.last_writer_lineitem,
        "conform_decimal_narrow": types.conform_decimal_narrow,
        "render_text_orders": types.render_text_orders,
        "preflight_ready": catalogs.preflight_ready,
        "stalled_checkpoints": monitoring.stalled_checkpoints,
    }.items():
        timed(name, lambda query=query: drain(query))
    return seconds, rows


def main() -> None:
    spark = session()
    run(spark)
    passes = [run(spark) for _ in range(int(os.environ.get("BENCH_PASSES", "3")))]
    rows = passes[0][1]
    seconds = {name: round(statistics.median(p[0][name] for p in passes), 3) for name in passes[0][0]}
    print(
        json.dumps(
            {
                "metric": "total_seconds_warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {name: round(n / seconds[name]) for name, n in rows.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
