"""What the physical plans must keep: pushed filters, pruned columns, unshuffled targets."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.scan import above, incremental_scan, union_all
from tidemark.operators.upsert import apply_updates, new_rows, upsert, upsert_metrics
from tidemark.sinks.snapshot import SnapshotTarget, staged_totals


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("big") / "t")
    spark.range(0, 200_000, 1, 4).selectExpr(
        "id", "id % 7 AS v", "repeat('x', 50) AS pad", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id) AS w"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_the_watermark_filter_reaches_the_files(big):
    assert "GreaterThan(w,2024-01-02T00:00)" in plan(incremental_scan(big, "w", "2024-01-02 00:00:00"))
    probe = big.where(above(big, "w", "2024-01-02 00:00:00")).selectExpr("1 AS x").distinct()
    assert re.search(r"ReadSchema: struct<w:timestamp_ntz>", plan(probe))


def test_an_invalid_checkpoint_counts_as_news(big):
    assert big.where(above(big, "w", "soon")).count() == big.count()


def test_a_small_delta_leaves_the_target_unshuffled(spark, big):
    delta = big.limit(5).selectExpr("id", "0L AS v", "'y' AS pad", "w")
    delta = spark.createDataFrame(delta.collect(), delta.schema)
    assert "Exchange hashpartitioning" not in plan(apply_updates(big, delta.coalesce(1).hint("broadcast"), ["id"]))
    inserts = plan(new_rows(delta, big, ["id"]))
    assert "ReadSchema: struct<id:bigint>" in inserts and "pad:string" not in inserts.split("ReadSchema", 1)[1]


def test_finding_touched_files_reads_keys_within_range_only(spark, big, out, monkeypatch):
    table = SnapshotTarget(spark, out)
    table.publish(big)
    seen = []
    read = SnapshotTarget.frame
    monkeypatch.setattr(SnapshotTarget, "frame", lambda self, *a: seen.append(read(self, *a)) or seen[-1])
    staged = table.stage(big.where("id between 60000 and 60010").withColumn("pad", big["v"].cast("string")))
    stats = table.merge(staged, ["id"], "w")
    assert (stats.rows_updated, stats.rows_inserted) == (11, 0)
    partial = table.current().runs
    assert sorted(len(names) for names in partial.values() if names) == [3]  # one file of four was rewritten


def test_a_hot_key_leaves_each_task_as_one_row(spark, out):
    hot = spark.range(0, 90_000, 1, 6).selectExpr("if(id % 3 = 0, null, id % 3) AS k", "id AS w")
    table = SnapshotTarget(spark, out)
    totals = staged_totals(table.stage(hot).frame, ["k"], "w", "bigint")
    assert (totals["fetched"], totals["superseded"], totals["newest"]) == (90_000, 59_998, "89999")
    per_key = plan(hot.groupBy("k").count())
    assert per_key.index("partial_count") > per_key.index("Exchange")  # the partial one runs below the shuffle


def test_union_all_keeps_every_frame(spark):
    for n in (1, 2, 3, 5, 8):
        frames = [spark.range(i, i + 1) for i in range(n)]
        assert sorted(r["id"] for r in union_all(frames).collect()) == list(range(n))


def test_a_merge_reads_and_moves_each_side_once(spark, big):
    delta = big.where("id % 100 = 1")
    for df in (upsert(big, delta, ["id"]), upsert_metrics(big, delta, ["id"])):
        text = plan(df)
        assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning") == 2
        assert "FullOuter" in text


def test_key_ranges_stay_disjoint_over_scattered_merges(spark, big, out):
    table = SnapshotTarget(spark, out)
    first = table.stage_by_key(big, ["id"])
    table.commit(table.open(big.schema), big.schema, first.runs)
    for i in (1, 2):
        delta = big.where(f"id % 100 = {i}").withColumn("w", big["w"])
        table.merge(table.stage(delta), ["id"], "w")
    spans = table.read().groupBy("_metadata.file_path").agg({"id": "min"}).count()
    rows = table.read().selectExpr("id", "_metadata.file_path AS f").groupBy("f").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    ends = sorted((r["a"], r["b"]) for r in rows.collect())
    assert len(ends) == spans > 1 and all(b < a for (_, b), (a, _) in zip(ends, ends[1:]))


def test_a_few_repeated_keys_rewrite_only_their_files(spark, big, out):
    table = SnapshotTarget(spark, out)
    extra = big.where("id IN (10, 11)")
    staged = table.stage(big.unionByName(extra))
    [run] = staged.runs
    before = set(table._names(run))
    stats = table.merge(staged, ["id"], "w")
    assert (stats.rows_inserted, stats.rows_superseded) == (200_000, 2) and table.read().count() == 200_000
    kept = set(table.current().runs[run])
    assert kept < before and len(before) - len(kept) <= 2 + 1


@pytest.mark.parametrize("few", [True, False])
def test_repeated_keys_do_not_move_the_other_rows(spark, out, monkeypatch, few):
    if not few:
        monkeypatch.setattr("tidemark.sinks.snapshot.FEW_REPEATED", 0)
    rows = [(f"v{i}", i % 5, None if i % 50 == 9 else i, "a") for i in range(400)] + [(f"again{i}", 9 - i % 2 * 9, i, "a") for i in range(0, 400, 25)]
    df = spark.createDataFrame(rows, "v string, w int, `the.key` int, part string")  # the key is not the first column
    table, keys, plans = SnapshotTarget(spark, out), ["the.key", "part"], []
    staged = table.stage(df)
    keep = SnapshotTarget.stage
    monkeypatch.setattr(SnapshotTarget, "stage", lambda self, d: plans.append((d.columns, plan(d))) or keep(self, d))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stats = table.merge(staged, keys, "w")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    held = {}
    for r in rows:
        name = (r[2], r[3]) if r[2] is not None else r[0]
        held[name] = max(held.get(name, r), r, key=lambda x: (x[1], x[0]))
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(held.values(), key=str)
    assert stats.rows_superseded == len(rows) - len(held) and stats.rows_inserted == len(held)
    assert len(table.storage.list(f"{out}/data")) == 2  # the run of keys is gone
    assert [columns for columns, _ in plans] == [["the.key", "part"], df.columns]
    written = plans[1][1]
    assert "SortMergeJoin" not in written
    assert written.count("Exchange hashpartitioning") == 1  # of the window, for repeated keys alone if these are few
    assert ("BroadcastHashJoin" in written) == few
