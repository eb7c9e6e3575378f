import datetime as dt

import pytest

from tidemark.functions.typemap import resolve
from tidemark.operators.catalog import described_frame, schema_drift, text_fallbacks
from tidemark.plans import monitor
from tidemark.plans.sync import TableSyncStats, report_frame, report_totals

HISTORY = ("run_id long, table string, rows_fetched long, rows_inserted long, rows_updated long, "
           "text_fallback_columns array<string>, last_value string")


def history(spark, **tables):
    """Per table a list of (fetched, last value, fallbacks), one per run."""
    rows = [
        (i, name, fetched, fetched, 0, list(fallbacks), value)
        for name, runs in tables.items()
        for i, (fetched, value, fallbacks) in enumerate(runs, start=1)
    ]
    return spark.createDataFrame(rows, HISTORY)


def runs(values, fetched=None):
    return [(fetched[i] if fetched else 1, v, "") for i, v in enumerate(values)]


def got(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_stalled_checkpoints(spark):
    h = history(spark, a=runs(["1", "1", "1", "2", "2"]), b=runs(["1", "2", "3", "4", "5"]), never=runs([None] * 4))
    assert got(monitor.stalled_checkpoints(h, 2), "table", "run_id") == [("a", 3), ("never", 3), ("never", 4)]


def test_unusual_volume_needs_a_full_window_before_it(spark):
    h = history(spark, a=runs("abcdef", [10, 11, 9, 10, 500, 10]), b=runs("abc", [1, 1, 900]))
    assert got(monitor.unusual_volume(h, 4), "table", "run_id") == [("a", 5)]


def test_silent_runs_need_every_table_silent(spark):
    h = history(spark, a=runs("abcde", [1, 0, 0, 0, 5]), b=runs("abcde", [0, 0, 0, 0, 0]))
    assert got(monitor.silent_runs(h, 2), "run_id", "tables") == [(3, 2), (4, 2)]
    assert got(monitor.silent_runs(h, 3), "run_id") == [(4,)]


def test_new_text_fallbacks(spark):
    h = history(spark, a=[(1, "x", ["p"]), (1, "y", ["p", "q"]), (1, "z", ["q"])])
    assert got(monitor.new_text_fallbacks(h), "run_id", "new_fallbacks") == [(2, ["q"])]


def test_update_heavy_tables(spark):
    h = spark.createDataFrame([(1, "a", 0, 1, 30, [], ""), (1, "b", 0, 9, 30, [], ""), (1, "c", 0, 0, 11, [], "")], HISTORY)
    assert got(monitor.update_heavy_tables(h), "table") == [("a",), ("c",)]


def test_reconcile(spark):
    source = spark.createDataFrame([(1, dt.datetime(2026, 1, 1)), (2, dt.datetime(2026, 1, 2))], "id int, w timestamp_ntz")
    found = monitor.reconcile({"t": (source, source.where("id = 1"), "w"), "u": (source, source, "w")})
    assert got(found, "table", "source_rows", "target_rows", "missing_rows", "in_step") == [
        ("t", 2, 1, 1, False), ("u", 2, 2, 0, True)]


def test_history_grows_by_run(spark, out):
    report = report_frame(spark, [TableSyncStats("t", 3, 2, 1), {"table": "u", "error": "RuntimeError: down"}])
    for run_id in (1, 2):
        monitor.append_history(report, f"{out}/history", run_id)
    kept = spark.read.parquet(f"{out}/history")
    assert got(kept.where("error IS NULL"), "run_id", "table", "rows_fetched") == [(1, "t", 3), (2, "t", 3)]
    totals = report_totals(report).first().asDict()
    assert totals == {"tables": 2, "failed": 1, "total_rows_fetched": 3, "total_rows_inserted": 2, "total_rows_updated": 1}


def test_schema_drift(spark):
    before = described_frame(spark, {"t": [resolve("a", "int"), resolve("b", "int"), resolve("C", "date")]})
    after = described_frame(spark, {"t": [resolve("a", "bigint"), resolve("c", "date"), resolve("d", "decimal", 9, 2)]})
    assert got(schema_drift(before, after), "column_name", "change") == [("a", "retyped"), ("b", "dropped"), ("d", "added")]


@pytest.mark.parametrize("columns, expected", [(["geography", "int", "xml", "sql_variant"], ["c0", "c3"]), (["int"], [])])
def test_text_fallbacks(spark, columns, expected):
    described = described_frame(spark, {"t": [resolve(f"c{i}", c) for i, c in enumerate(columns)]})
    assert text_fallbacks(described).first()["text_fallback_columns"] == expected
