import datetime as dt
import threading
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.config import TableSync
from tidemark.errors import (
    CheckpointMismatchError,
    ColumnNotFoundError,
    InvalidValueError,
    SourceUnavailableError,
    TableNotFoundError,
    TargetError,
)
from tidemark.plans.sync import _Run
from tidemark.sinks import checkpoint
from tidemark.sinks.checkpoint import CheckpointStore, listing
from tidemark.sinks.delta import DeltaTarget
from tidemark.sinks.snapshot import SnapshotTarget
from tidemark.sinks.storage import Storage

CUSTOMERS = "id int, name string, balance decimal(10,2), is_active boolean, updated_at timestamp_ntz"
TABLE = {"table": "dbo.customers", "watermark_column": "updated_at", "primary_key": "id"}


def day(n):
    return dt.datetime(2026, 1, n, 12)


def customers(spark, *extra, n=5):
    from decimal import Decimal

    rows = [(i, f"c{i}", Decimal(i), True, day(i)) for i in range(1, n + 1)]
    return spark.createDataFrame([*rows, *extra], CUSTOMERS)


def sync(spark, out, frame, table=TABLE, **kwargs):
    return tm.sync_table(tm.FrameSource(spark, {table["table"]: frame}), out, table, spark=spark, **kwargs)


def target(spark, out, name="dbo/customers"):
    return SnapshotTarget(spark, f"{out}/{name}").read()


def target_exists(spark, out, name):
    return SnapshotTarget(spark, f"{out}/{name}").exists()


def last_value(spark, out, table=TABLE):
    entry = TableSync.of(table)
    return CheckpointStore(spark, f"{out}/_streamer_checkpoints").read([entry]).get(entry.table)


def test_first_sync_takes_all_and_the_second_nothing(spark, out):
    first = sync(spark, out, customers(spark))
    assert (first.rows_fetched, first.rows_inserted, first.rows_updated) == (5, 5, 0)
    assert first.text_fallback_columns == [] and first.last_value == "2026-01-05 12:00:00"
    version = SnapshotTarget(spark, f"{out}/dbo/customers").current().version
    second = sync(spark, out, customers(spark))
    assert second.rows_fetched == 0 and second.last_value == first.last_value
    assert SnapshotTarget(spark, f"{out}/dbo/customers").current().version == version
    assert target(spark, out).schema["updated_at"].dataType.simpleString() == "timestamp"


def test_one_changed_row_is_the_only_one_fetched(spark, out):
    from decimal import Decimal

    sync(spark, out, customers(spark, (999, "Zed", Decimal("1.00"), True, day(6))))
    changed = customers(spark, (999, "Zed", Decimal("555.55"), True, day(7)))
    stats = sync(spark, out, changed)
    assert (stats.rows_fetched, stats.rows_inserted, stats.rows_updated) == (1, 0, 1)
    assert str(target(spark, out).where("id = 999").first()["balance"]) == "555.55"
    assert sync(spark, out, changed).rows_fetched == 0


def test_the_checkpoint_is_the_sources_maximum(spark, out):
    frame = customers(spark, n=3).withColumn("updated_at", F.expr("updated_at + interval 250 milliseconds"))
    sync(spark, out, frame)
    assert last_value(spark, out) == "2026-01-03 12:00:00.250"
    assert tm.source_watermark(tm.FrameSource(spark, {"dbo.customers": frame}), TABLE, spark=spark) == last_value(spark, out)


def test_a_row_tied_with_the_checkpoint_is_never_fetched(spark, out):
    from decimal import Decimal

    sync(spark, out, customers(spark))
    tied = customers(spark, (6, "late", Decimal(1), True, day(5)))
    assert sync(spark, out, tied).rows_fetched == 0


def test_null_watermarks_come_only_with_a_first_sync(spark, out):
    from decimal import Decimal

    first = sync(spark, out, customers(spark, (6, "none", Decimal(1), True, None)))
    assert first.rows_fetched == 6
    assert sync(spark, out, customers(spark, (7, "none", Decimal(1), True, None))).rows_fetched == 0


def test_only_null_watermarks_leave_no_checkpoint(spark, out):
    frame = customers(spark).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    for _ in range(2):
        assert sync(spark, out, frame).rows_fetched == 5
        assert last_value(spark, out) is None
    assert target(spark, out).count() == 5


def test_no_rows_create_the_target_and_no_checkpoint(spark, out):
    stats = sync(spark, out, customers(spark).where("false"))
    assert stats.rows_fetched == 0 and last_value(spark, out) is None
    assert target(spark, out).count() == 0 and len(target(spark, out).columns) == 5


def test_a_crash_between_merge_and_checkpoint_is_repaired_by_running_again(spark, out, monkeypatch):
    sync(spark, out, customers(spark, n=3))

    def crash(self, table, value):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(checkpoint.CheckpointStore, "advance", crash)
        with pytest.raises(OSError):
            sync(spark, out, customers(spark))
    assert last_value(spark, out) == "2026-01-03 12:00:00"
    assert target(spark, out).count() == 5
    again = sync(spark, out, customers(spark))
    assert (again.rows_fetched, again.rows_inserted, again.rows_updated) == (2, 0, 2)
    assert target(spark, out).count() == 5


def test_a_crash_before_the_commit_changes_nothing(spark, out, monkeypatch):
    sync(spark, out, customers(spark, n=3))

    def crash(self, *a):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(SnapshotTarget, "commit", crash)
        with pytest.raises(OSError):
            sync(spark, out, customers(spark))
    assert target(spark, out).count() == 3 and last_value(spark, out) == "2026-01-03 12:00:00"
    assert sync(spark, out, customers(spark)).rows_inserted == 2


def test_the_first_failing_table_ends_the_run(spark, out):
    good, other = dict(TABLE), dict(TABLE, table="dbo.other")
    bad = dict(TABLE, table="dbo.bad")
    frames = {t["table"]: customers(spark) for t in (good, bad, other)}
    source = tm.FrameSource(spark, frames, {"dbo.bad": {"name": ("int",)}})
    with pytest.raises(InvalidValueError, match="dbo.bad: column name holds something other than int"):
        tm.sync_tables(source, out, [good, bad, other], spark=spark)
    assert target(spark, out).count() == 5 and last_value(spark, out, good)
    assert last_value(spark, out, bad) is None
    assert SnapshotTarget(spark, f"{out}/dbo/other").current() is None


def test_tables_at_once_fail_alone(spark, out):
    names = ["dbo.a", "dbo.bad", "dbo.c", "dbo.gone"]
    tables = [dict(TABLE, table=n) for n in names]
    source = tm.FrameSource(spark, {n: customers(spark) for n in names[:3]}, {"dbo.bad": {"name": ("int",)}})
    result = tm.sync_tables_distributed(source, out, tables, spark=spark, raise_on_error=False)
    assert [t["table"] for t in result["tables"]] == ["dbo.a", "dbo.c"] and result["total_rows_fetched"] == 10
    assert [f["tables"] for f in result["failures"]] == [["dbo.bad"], ["dbo.gone"]]
    with pytest.raises(RuntimeError, match="2 of 4 tables failed"):
        tm.sync_tables_distributed(source, out, tables, spark=spark)
    with pytest.raises(ValueError, match="progress"):
        tm.sync_tables_distributed(source, out, tables, spark=spark, progress=print)
    assert tm.sync_tables_distributed(source, out, [], spark=spark) == {"tables": [], "failures": [], "total_rows_fetched": 0}


def test_progress_is_cumulative_and_can_stop_the_run(spark, out):
    tables = [dict(TABLE, table=f"dbo.t{i}") for i in range(3)]
    source = tm.FrameSource(spark, {t["table"]: customers(spark) for t in tables})
    seen = []

    def stop_after_two(event):
        seen.append(event)
        return len(seen) < 2

    with pytest.raises(KeyboardInterrupt):
        tm.sync_tables(source, out, tables, spark=spark, progress=stop_after_two)
    assert seen[1] == {"table": "dbo.t1", "tables_done": 2, "total_tables": 3, "rows_fetched": 10}
    assert SnapshotTarget(spark, f"{out}/dbo/t2").current() is None

    def fail(event):
        raise LookupError("caller's own")

    with pytest.raises(LookupError):
        tm.sync_tables(source, out, tables, spark=spark, progress=fail)
    assert tm.sync_tables(source, out, [], spark=spark).tables == []


def test_missing_tables_and_columns_are_named(spark, out):
    source = tm.FrameSource(spark, {"dbo.customers": customers(spark)})
    with pytest.raises(TableNotFoundError, match="^dbo.gone"):
        tm.sync_tables(source, out, [dict(TABLE, table="dbo.gone")], spark=spark)
    with pytest.raises(ColumnNotFoundError, match="^dbo.customers: watermark column nope"):
        sync(spark, out, customers(spark), dict(TABLE, watermark_column="nope"))
    with pytest.raises(ColumnNotFoundError, match="primary key column nope"):
        sync(spark, out, customers(spark), dict(TABLE, primary_key=["id", "nope"]))
    with pytest.raises(CheckpointMismatchError, match="binary"):
        sync(spark, out, customers(spark).withColumn("v", F.lit(b"1")), dict(TABLE, watermark_column="v"))


def test_configured_names_match_without_case(spark, out):
    table = dict(TABLE, watermark_column="UPDATED_AT", primary_key=["ID"])
    sync(spark, out, customers(spark, n=3), table)
    assert sync(spark, out, customers(spark), table).rows_fetched == 2


def test_a_checkpoint_of_another_column_is_refused(spark, out):
    sync(spark, out, customers(spark))
    with pytest.raises(CheckpointMismatchError, match="belongs to column updated_at"):
        sync(spark, out, customers(spark), dict(TABLE, watermark_column="id"))


def test_a_checkpoint_that_is_no_value_of_the_column_is_refused_unseen(spark, out):
    tm.set_checkpoint(out, TABLE, "not a time", spark=spark)
    with pytest.raises(CheckpointMismatchError) as caught:
        sync(spark, out, customers(spark))
    assert "not a time" not in str(caught.value)


def test_manual_checkpoints_may_go_back_and_deleting_one_forces_a_full_sync(spark, out):
    sync(spark, out, customers(spark))
    tm.set_checkpoint(out, TABLE, "2026-01-03 12:00:00", spark=spark)
    again = sync(spark, out, customers(spark))
    assert (again.rows_fetched, again.rows_updated) == (2, 2)
    tm.delete_checkpoint(out, TABLE, spark=spark)
    assert last_value(spark, out) is None
    assert sync(spark, out, customers(spark)).rows_fetched == 5
    assert target(spark, out).count() == 5


def test_checkpoints_of_several_tables_read_as_one(spark, out):
    tables = [dict(TABLE, table=n) for n in ("dbo.a", "db.dbo.b", "c")]
    for i, t in enumerate(tables):
        tm.set_checkpoint(out, t, f"v{i}", spark=spark)
    tm.set_checkpoint(out, tables[0], "v9", spark=spark)
    store = CheckpointStore(spark, f"{out}/_streamer_checkpoints")
    entries = [TableSync.of(t) for t in tables]
    assert store.read(entries) == {"dbo.a": "v9", "db.dbo.b": "v1", "c": "v2"}
    assert [r["table_name"] for r in listing(store.view(entries)).collect()] == ["dbo.a", "c", "db.dbo.b"]
    assert store.read([TableSync("dbo.never", "w", "id")]) == {}
    assert sorted(r["table_name"] for r in store.view().collect()) == ["c", "db.dbo.b", "dbo.a"]
    assert CheckpointStore(spark, f"{out}/nowhere").view().count() == 0


def test_an_unreadable_checkpoint_is_an_error_not_a_first_sync(spark, out, monkeypatch):
    sync(spark, out, customers(spark))

    def broken(self, uri):
        raise TargetError("cannot list")

    monkeypatch.setattr(Storage, "list", broken)
    with pytest.raises(TargetError):
        sync(spark, out, customers(spark))


def test_handover_fetches_only_later_rows(spark, out):
    source = tm.FrameSource(spark, {"dbo.customers": customers(spark)})
    mark = tm.source_watermark(source, TABLE, spark=spark)
    tm.bulk_load(out, TABLE, customers(spark).withColumn("updated_at", F.col("updated_at").cast("timestamp")))
    tm.set_checkpoint(out, TABLE, mark, spark=spark)
    assert sync(spark, out, customers(spark)).rows_fetched == 0
    assert sync(spark, out, customers(spark, n=6)).rows_fetched == 1
    assert target(spark, out).count() == 6
    assert tm.source_watermark(tm.FrameSource(spark, {"dbo.customers": customers(spark).where("false")}), TABLE, spark=spark) is None


def test_preflight_reports_and_writes_nothing(spark, out):
    frame = customers(spark).withColumn("place", F.array(F.lit(1)))
    source = tm.FrameSource(spark, {"dbo.customers": frame, "dbo.other": frame})
    tables = [TABLE, dict(TABLE, table="dbo.other", watermark_column="gone", primary_key=["ID", "line"])]
    found = {r["table"]: r for r in tm.preflight(source, tables, output_uri=out, spark=spark)}
    ready, other = found["dbo.customers"], found["dbo.other"]
    assert ready["ready"] and ready["watermark_present"] and ready["last_synced_value"] is None
    assert [c["name"] for c in ready["columns"]] == ["id", "name", "balance", "is_active", "updated_at", "place"]
    assert [(c["source_type"], c["spark_type"], c["recognised"]) for c in ready["columns"][-2:]] == [
        ("datetime2", "timestamp", True), ("array<int>", "string", False)]
    assert not other["ready"] and not other["watermark_present"] and other["missing_primary_key_columns"] == ["line"]
    assert SnapshotTarget(spark, f"{out}/dbo/customers").current() is None
    sync(spark, out, customers(spark))
    assert tm.preflight(source, [TABLE], output_uri=out, spark=spark)[0]["last_synced_value"] == "2026-01-05 12:00:00"
    assert tm.preflight(source, [TABLE], spark=spark)[0]["last_synced_value"] is None
    assert tm.preflight(source, [], spark=spark) == []
    binary = tm.FrameSource(spark, {"dbo.customers": frame.withColumn("rv", F.lit(b"1"))}, {"dbo.customers": {"rv": ("rowversion",)}})
    row = tm.preflight(binary, [dict(TABLE, watermark_column="rv")], spark=spark)[0]
    assert not row["ready"] and "binary" in row["watermark_problem"]
    with pytest.raises(TableNotFoundError):
        tm.preflight(source, [dict(TABLE, table="dbo.gone")], spark=spark)


@pytest.mark.parametrize("expression", ["cast(concat('s3cret', id) as int)", "cast(id * 1234567.5 as decimal(5,1))", "id * 2147483647"])
def test_a_source_expression_that_fails_does_not_show_its_value(spark, out, expression):
    broken = customers(spark).withColumn("name", F.expr(expression))
    with pytest.raises(ValueError, match="^dbo.customers: a source value cannot be converted") as caught:
        sync(spark, out, broken)
    assert "s3cret" not in str(caught.value) and "1234567" not in str(caught.value)


def test_a_rebuild_drops_deleted_rows_and_takes_new_types(spark, out):
    sync(spark, out, customers(spark))
    smaller = customers(spark, n=3).withColumn("name", F.length("name"))
    source = tm.FrameSource(spark, {"dbo.customers": smaller})
    with pytest.raises(ValueError, match="column name is int"):
        tm.delete_checkpoint(out, TABLE, spark=spark)
        tm.sync_table(source, out, TABLE, spark=spark)
    stats = tm.rebuild_table(source, out, TABLE, spark=spark)
    assert (stats.rows_fetched, stats.rows_inserted, stats.rows_updated) == (3, 3, 0)
    assert target(spark, out).count() == 3 and last_value(spark, out) == "2026-01-03 12:00:00"
    assert tm.sync_table(source, out, TABLE, spark=spark).rows_fetched == 0
    nothing = tm.FrameSource(spark, {"dbo.customers": smaller.where("false")})
    tm.rebuild_table(nothing, out, TABLE, spark=spark)
    assert target(spark, out).count() == 0 and last_value(spark, out) is None


def test_clean_up_covers_tables_and_checkpoints(spark, out):
    sync(spark, out, customers(spark, n=3))
    sync(spark, out, customers(spark))
    assert tm.vacuum(out, [TABLE], spark=spark) == 0
    store = CheckpointStore(spark, f"{out}/_streamer_checkpoints").target(TableSync.of(TABLE))
    assert len(store.storage.list(f"{store.uri}/data")) == 2
    assert store._vacuum_before(4_000_000_000) == 1
    assert last_value(spark, out) == "2026-01-05 12:00:00" and target(spark, out).count() == 5


def test_two_writers_of_one_table_never_mix(spark, out):
    """However two runs of the same table interleave, each row ends up there exactly once."""
    sync(spark, out, customers(spark, n=2))
    errors = []

    def run():
        try:
            sync(spark, out, customers(spark))
        except (tm.ConcurrentWriteError, RuntimeError) as e:
            errors.append(e)

    threads = [threading.Thread(target=run) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        sync(spark, out, customers(spark))
    assert sorted(r["id"] for r in target(spark, out).collect()) == [1, 2, 3, 4, 5]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(1, 12)), min_size=1, max_size=12, unique_by=lambda c: c[1]),
       st.sets(st.integers(1, 12), max_size=3))
def test_any_slicing_equals_a_full_sync(spark, tmp_path_factory, changes, cuts):
    """Changes are (key, moment). Whatever the moments of the runs, the result is the same."""
    out = str(tmp_path_factory.mktemp("lake"))
    table = {"table": "t", "watermark_column": "w", "primary_key": "id"}
    for moment in [*sorted(cuts), 12]:
        now = {}
        for key, at in sorted(changes, key=lambda c: c[1]):
            if at <= moment:
                now[key] = at
        frame = spark.createDataFrame([(k, w, f"{k}@{w}") for k, w in now.items()], "id int, w int, v string")
        sync(spark, out, frame, table)
    got = sorted(tuple(r) for r in target(spark, out, "t").collect())
    assert got == sorted((k, w, f"{k}@{w}") for k, w in now.items())


def test_a_path_is_looked_up_for_every_run(spark, out, tmp_path):
    path = str(tmp_path / "source")
    source = tm.FrameSource(spark, {"dbo.customers": path})
    customers(spark, n=2).write.parquet(path)
    assert tm.sync_table(source, out, TABLE, spark=spark).rows_fetched == 2
    customers(spark).where("id > 2").write.mode("append").parquet(path)
    assert tm.sync_table(source, out, TABLE, spark=spark).rows_fetched == 3


def test_a_session_outside_utc_is_refused(spark, out):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            sync(spark, out, customers(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_many_tables_at_once_are_all_asked_for(spark, out, monkeypatch):
    """A request for 100 tables at a time is kept."""
    from tidemark.plans import sync as plans

    seen = []

    class Pool(plans.ThreadPoolExecutor):
        def __init__(self, n):
            seen.append(n)
            super().__init__(4)

    monkeypatch.setattr(plans, "ThreadPoolExecutor", Pool)
    tables = [dict(TABLE, table=f"dbo.t{i}") for i in range(100)]
    source = tm.FrameSource(spark, {})
    tm.sync_tables_distributed(source, out, tables, spark=spark, num_partitions=100, raise_on_error=False)
    assert seen == [100]


def test_one_bad_table_leaves_the_idle_check_to_the_others(spark, out, monkeypatch):
    tables = [dict(TABLE, table=f"dbo.t{i}") for i in range(5)]
    frames = {t["table"]: customers(spark) for t in tables}
    tm.sync_tables(tm.FrameSource(spark, frames), out, tables, spark=spark)
    staged = []
    stage = SnapshotTarget.stage
    monkeypatch.setattr(SnapshotTarget, "stage", lambda self, df: staged.append(self.uri) or stage(self, df))
    del frames["dbo.t2"]
    result = tm.sync_tables_distributed(tm.FrameSource(spark, frames), out, tables, spark=spark, raise_on_error=False)
    assert staged == [] and [f["table"] for f in result["failures"]] == ["dbo.t2"]
    assert [t["rows_fetched"] for t in result["tables"]] == [0] * 4


class OtherTarget:
    """A second target, as plain as can be: one Parquet folder for each version, named in memory."""

    held: dict = {}

    def __init__(self, spark, uri):
        self.spark, self.uri = spark, uri

    def exists(self):
        return self.uri in self.held

    def open(self, schema):
        return schema

    def open_or_create(self, schema):
        if not self.exists():
            self.held[self.uri] = (self.spark.createDataFrame([], schema), schema)

    def read(self):
        return self.held[self.uri][0]

    def stage(self, df):
        return df

    def publish(self, df):
        self.held[self.uri] = (df, df.schema)

    def replace(self, staged, keys, watermark, type_name="", base=None):
        from tidemark.sinks.snapshot import MergeStats, staged_totals

        totals = staged_totals(staged, keys, watermark, type_name)
        self.publish(staged)
        return MergeStats(totals["fetched"], totals["fetched"], 0, 0, totals["newest"])

    merge = replace

    def vacuum(self, retain_hours):
        return 7


def test_the_hand_made_steps_go_through_the_chosen_target(spark, out):
    chosen = {"target_factory": OtherTarget}
    source = tm.FrameSource(spark, {"dbo.customers": customers(spark)})
    assert tm.rebuild_table(source, out, TABLE, spark=spark, **chosen).rows_fetched == 5
    uri = f"{out}/dbo/customers"
    assert OtherTarget.held[uri][0].count() == 5 and not SnapshotTarget(spark, uri).exists()
    [row] = tm.reconcile(source, out, [TABLE], spark=spark, **chosen).collect()
    assert (row["source_rows"], row["target_rows"], row["in_step"]) == (5, 5, True)
    assert tm.vacuum(out, [TABLE], spark=spark, **chosen) == 7
    tm.bulk_load(out, TABLE, customers(spark, n=2), **chosen)
    assert OtherTarget(spark, uri).read().count() == 2 and not SnapshotTarget(spark, uri).exists()


@pytest.mark.parametrize("step, message", [("describe", "looking up its columns"), ("scan", "newest watermark"), ("stage", "fetching rows")])
def test_a_stalled_source_is_told_by_its_step(spark, out, monkeypatch, step, message):
    from pyspark.errors import PySparkException

    from tidemark.errors import SourceUnavailableError

    def stall(*_):
        raise PySparkException("com.microsoft.sqlserver.jdbc.SQLServerException: Read timed out")

    monkeypatch.setattr(SnapshotTarget if step == "stage" else tm.FrameSource, step, stall)
    with pytest.raises(SourceUnavailableError, match=f"^dbo.customers: .*{message}$"):
        sync(spark, out, customers(spark))


class Counted(tm.FrameSource):
    """Counts its questions; fails them all, or those that a table is part of."""

    def __init__(self, *args, error=None, bad=None):
        super().__init__(*args)
        self.asked, self.error, self.bad = 0, error, bad

    def describe(self, tables):
        self.asked += 1
        if self.error is not None and (self.bad is None or any(t.table == self.bad for t in tables)):
            raise self.error
        return super().describe(tables)


def many(spark, n=32):
    frames = {f"dbo.t{i}": spark.range(3).selectExpr("id AS k", "id AS w") for i in range(n)}
    return frames, [{"table": t, "watermark_column": "w", "primary_key": "k"} for t in frames]


def test_an_outage_is_asked_about_once(spark, out):
    frames, tables = many(spark)
    source = Counted(spark, frames, error=SourceUnavailableError("the source is down"))
    with pytest.raises(ConnectionError, match="dbo.t0: the source is down"):
        tm.sync_tables(source, out, tables, spark=spark)
    assert source.asked == 1
    report = tm.sync_tables_distributed(source, out, tables, spark=spark, raise_on_error=False)
    assert source.asked == 2 and len(report["failures"]) == 32 and not report["tables"]
    assert {f["table"] for f in report["failures"]} == set(frames)


def test_one_bad_table_costs_a_few_questions(spark, out):
    frames, tables = many(spark)
    source = Counted(spark, frames, error=TableNotFoundError("the source has no such table"), bad="dbo.t21")
    report = tm.sync_tables_distributed(source, out, tables, spark=spark, raise_on_error=False)
    assert [f["table"] for f in report["failures"]] == ["dbo.t21"] and len(report["tables"]) == 31
    assert source.asked <= 2 * 6 + 1  # 32 tables are halved five times; the table itself asks once more


def test_the_largest_tables_start_first_and_idle_ones_take_no_thread(spark, out, monkeypatch, tmp_path):
    frames, tables = many(spark, 6)
    for i, rows in ((2, 40_000), (4, 400_000)):
        spark.range(rows).selectExpr("id AS k", "id AS w").write.parquet(str(tmp_path / f"t{i}"))
        frames[f"dbo.t{i}"] = spark.read.parquet(str(tmp_path / f"t{i}"))
    started, threads = [], []
    real = _Run.sync

    def noted(self, table):
        started.append(table.table)
        threads.append(threading.current_thread())
        return real(self, table)

    monkeypatch.setattr(_Run, "sync", noted)
    source = tm.FrameSource(spark, frames)
    tm.sync_tables_distributed(source, out, tables, spark=spark, num_partitions=1)
    assert started[:2] == ["dbo.t4", "dbo.t2"] and len(started) == 6
    started.clear(), threads.clear()
    report = tm.sync_tables_distributed(source, out, tables, spark=spark)
    assert report["total_rows_fetched"] == 0 and [t["table"] for t in report["tables"]] == list(frames)
    assert set(threads) == {threading.current_thread()}


def stalled(spark, seconds):
    """Rows that take ``seconds`` to arrive."""

    def wait(batches):
        import time

        for batch in batches:
            time.sleep(seconds)
            yield batch

    return spark.range(0, 3, 1, 1).selectExpr("id AS k", "id AS w").mapInPandas(wait, "k long, w long")


def test_a_table_that_stalls_fails_by_step_and_the_others_go_on(spark, out):
    frames, tables = many(spark, 4)
    slow = {**frames, "dbo.t2": stalled(spark, 120)}
    start = time.monotonic()
    report = tm.sync_tables_distributed(
        tm.FrameSource(spark, slow), out, tables, spark=spark, raise_on_error=False, step_timeout_sec=8
    )
    assert time.monotonic() - start < 60
    [failure] = report["failures"]
    assert failure["table"] == "dbo.t2" and "took more than 8 s while fetching rows" in failure["error"]
    assert [t["rows_fetched"] for t in report["tables"]] == [3, 3, 3]
    assert not target_exists(spark, out, "dbo/t2") and not spark.sparkContext.getJobTags()
    # nothing is lost: the next run fetches it
    assert tm.sync_tables_distributed(tm.FrameSource(spark, frames), out, tables, spark=spark)["total_rows_fetched"] == 3


def test_a_probe_that_stalls_leaves_the_other_tables_to_themselves(spark, out):
    frames, tables = many(spark, 3)
    tm.sync_tables(tm.FrameSource(spark, frames), out, tables, spark=spark)
    slow = {**frames, "dbo.t1": stalled(spark, 120), "dbo.t2": spark.range(5).selectExpr("id AS k", "id AS w")}
    report = tm.sync_tables_distributed(
        tm.FrameSource(spark, slow), out, tables, spark=spark, raise_on_error=False, step_timeout_sec=8
    )
    assert [f["table"] for f in report["failures"]] == ["dbo.t1"]
    assert [t["rows_fetched"] for t in report["tables"]] == [0, 2]


def test_a_limit_of_nothing_is_refused(spark, out):
    frames, tables = many(spark, 1)
    with pytest.raises(ValueError, match="step_timeout_sec"):
        tm.sync_tables(tm.FrameSource(spark, frames), out, tables, spark=spark, step_timeout_sec=0)


@pytest.mark.parametrize("condition, there", [("DELTA_PATH_DOES_NOT_EXIST", False), ("DELTA_SCHEMA_NOT_SET", None)])
def test_a_delta_table_that_cannot_be_read_is_not_a_missing_one(monkeypatch, condition, there):
    class Refused(AnalysisException):
        def getCondition(self):
            return condition

    def refuse(self):
        raise Refused("no")

    monkeypatch.setattr(DeltaTarget, "read", refuse)
    held = DeltaTarget.__new__(DeltaTarget)
    if there is None:
        with pytest.raises(AnalysisException):
            held.exists()
    else:
        assert held.exists() is there
