"""Targets in buckets, and differences between two sides."""

import random

import pytest
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.errors import SettingError
from tidemark.plans.compare import _within, compare_tables
from tidemark.sinks.buckets import BucketedTarget, bucket_of, taken_over
from tidemark.sinks.snapshot import SnapshotTarget

SCHEMA = "k long, part string, w int, v string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def changes(seed, runs=4):
    r = random.Random(seed)
    for _ in range(runs):
        yield [
            (r.choice([None, *range(40)]), r.choice(["a", "b", None]) if r.random() < 0.3 else "a", r.randint(0, 5), str(r.randint(0, 9)))
            for _ in range(r.randint(1, 30))
        ]


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_give_what_the_other_target_gives(spark, out, seed):
    bucketed, plain = BucketedTarget(spark, f"{out}/b", 5), SnapshotTarget(spark, f"{out}/p")
    for rows in changes(seed):
        df = spark.createDataFrame(rows, SCHEMA)
        stats = [t.merge(t.stage(df), ["k", "part"], "w") for t in (bucketed, plain)]
        assert stats[0] == stats[1]
        assert rows_of(bucketed.read()) == rows_of(plain.read())


def test_only_buckets_with_a_change_are_read_and_written(spark, out, monkeypatch):
    table = BucketedTarget(spark, out, 16)
    table.merge(table.stage(spark.range(4000).selectExpr("uuid() AS k", "id AS w")), ["k"], "w")
    before = table.live(table.current())
    assert sorted(before) == list(range(16))
    some = table.read().orderBy("w").limit(3)
    hit = {r[0] for r in some.select(bucket_of(some.schema, ["k"], 16)).collect()}
    read, seen = BucketedTarget.frame, []
    monkeypatch.setattr(BucketedTarget, "frame", lambda self, *a: seen.append(read(self, *a)) or seen[-1])
    change = spark.createDataFrame(some.collect(), some.schema)
    stats = table.merge(table.stage(change.withColumn("w", F.col("w") + 10_000)), ["k"], "w")
    monkeypatch.undo()
    assert (stats.rows_inserted, stats.rows_updated) == (0, 3)
    buckets_read = {int(f.split("__bucket=")[1].split("/")[0]) for df in seen for f in df.inputFiles()}
    assert buckets_read == hit
    after = table.live(table.current())
    assert {b for b in after if after[b] != before[b]} == hit
    assert table.read().count() == 4000


def test_a_merge_moves_each_side_once_and_joins_nothing(spark):
    old = spark.range(100).selectExpr("id AS k", "id AS w", "'x' AS only_old", "0 AS __bucket")
    delta = spark.range(50, 150).selectExpr("id AS k", "id AS w", "0 AS __bucket")
    merged = taken_over(old, delta, ["k"])
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "rangepartitioning" not in text
    assert text.count("Exchange hashpartitioning(__bucket") == 1  # these keys cannot be NULL
    got = {r["k"]: r["only_old"] for r in merged.collect()}
    assert got == {k: "x" if k < 100 else None for k in range(150)}


def test_columns_that_come_and_go(spark, out):
    bucketed, plain = BucketedTarget(spark, f"{out}/b", 3), SnapshotTarget(spark, f"{out}/p")
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, None), (None, 1, "n")], "k int, w int, gone string")
    later = spark.createDataFrame([(1, 2, 5), (3, 2, 6)], "k int, w int, `new.col` int")
    for t in (bucketed, plain):
        t.merge(t.stage(first), ["k"], "w")
        t.merge(t.stage(later), ["k"], "w")
    assert rows_of(bucketed.read().select("k", "w", "gone", "`new.col`")) == rows_of(plain.read().select("k", "w", "gone", "`new.col`"))


def test_the_number_of_buckets_and_the_key_stay(spark, out):
    table = BucketedTarget(spark, out, 4)
    df = spark.createDataFrame([(i, "a", 1, "x") for i in range(50)], SCHEMA)
    table.merge(table.stage(df), ["k"], "w")
    other = BucketedTarget(spark, out, 99)
    other.merge(other.stage(df), ["k"], "w")
    assert set(other.live(other.current())) <= set(range(4)) and other.read().count() == 50
    with pytest.raises(SettingError):
        other.merge(other.stage(df), ["v"], "w")
    with pytest.raises(SettingError):
        other.publish(df)
    with pytest.raises(SettingError):
        BucketedTarget(spark, out, 0)
    stats = other.replace(other.stage(df.limit(7)), ["k", "part"], "w")
    assert stats.rows_inserted == 7 and other.read().count() == 7
    assert other._vacuum_before(2e12 / 1000 * 10) >= 1 and other.read().count() == 7


def test_syncs_into_buckets(spark, out):
    source = tm.FrameSource(spark, {"dbo.t": spark.range(30).selectExpr("id AS k", "id AS w")})
    table = {"table": "dbo.t", "watermark_column": "w", "primary_key": "k"}
    factory = BucketedTarget.factory(4)
    assert tm.sync_tables(source, out, [table], spark=spark, target_factory=factory).tables[0].rows_inserted == 30
    assert tm.sync_tables(source, out, [table], spark=spark, target_factory=factory).total_rows_fetched == 0
    assert factory(spark, f"{out}/dbo/t").read().count() == 30


@pytest.mark.parametrize("limits", [{}, {"ROWS_PER_TASK": 5}, {"HOT_ROWS": 1}])
def test_repeated_rows_of_a_change_move_once_with_the_others(spark, out, monkeypatch, limits):
    for name, n in limits.items():
        monkeypatch.setattr(f"tidemark.sinks.buckets.{name}", n)
    bucketed, plain = BucketedTarget(spark, f"{out}/b", 3), SnapshotTarget(spark, f"{out}/p")
    written, write = [], BucketedTarget._write
    monkeypatch.setattr(BucketedTarget, "_write", lambda self, rows: written.append(rows) or write(self, rows))
    first = [(None if i % 9 == 0 else i % 50, "a" if i % 4 else "b", i % 7 if i % 11 else None, f"v{i}", i) for i in range(60)]
    later = [(v, i % 3, i % 30, "a" if i % 4 else None) for i, v in enumerate(f"u{i}" for i in range(40))]  # no column `extra`
    for rows, schema in ((first, "k int, part string, w int, v string, extra int"), (later, "v string, w int, k int, part string")):
        df = spark.createDataFrame(rows, schema)
        stats = [t.merge(t.stage(df), ["k", "part"], "w") for t in (bucketed, plain)]
        assert stats[0] == stats[1] and stats[0].rows_superseded > 0
        names = ["k", "part", "w", "v", "extra"]
        assert rows_of(bucketed.read().select(names)) == rows_of(plain.read().select(names))
    for df in written:
        text = df._jdf.queryExecution().executedPlan().toString()
        # rows with a key, rows without one; only hot keys are reduced first, by key
        assert "HOT_ROWS" in limits or text.count("Exchange ") == 2
        assert ("Exchange hashpartitioning(k" in text) == ("HOT_ROWS" in limits)


def test_a_bucket_of_many_rows_is_dealt_to_several_tasks(spark):
    old = spark.range(4000).selectExpr("id AS k", "id AS w", "CAST(id % 2 AS INT) AS __bucket")
    delta = spark.range(3000, 5000).selectExpr("id AS k", "-id AS w", "CAST(id % 2 AS INT) AS __bucket")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for slices, full in ((1, range(1, 3)), (8, [16])):
            merged = taken_over(old, delta, ["k"], buckets=2, slices=slices)
            assert merged.groupBy(F.spark_partition_id()).count().count() in full
            assert rows_of(merged.select("k", "w", "__bucket")) == sorted(((k, k if k < 3000 else -k, k % 2) for k in range(5000)), key=str)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


# ------------------------------------------------------------------ differences


def plain_differences(left, right):
    held = ({}, {})
    for side, rows in zip(held, (left, right)):
        for k, v in rows:
            side.setdefault(k, []).append(v)
    out = []
    for k in {*held[0], *held[1]}:
        a, b = held[0].get(k, []), held[1].get(k, [])
        if sorted(a, key=str) != sorted(b, key=str):
            out.append((k, "left only" if not b else "right only" if not a else "changed", len(a), len(b)))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout, small, open_ranges", [(64, 100_000, 512), (2, 1, 512), (4, 3, 2)])
def test_differences_are_those_of_a_plain_comparison(spark, out, fanout, small, open_ranges):
    r = random.Random(fanout)
    left = [(r.choice([None, *range(200)]), r.choice([None, 1.5, 0.0, float("nan")])) for _ in range(300)]
    right = [(k, -v if v == 0 else v) for k, v in left]  # -0.0 is 0.0
    r.shuffle(right)
    for _ in range(12):
        i = r.randrange(len(right))
        right[i] = r.choice([(right[i][0], 9.0), (1000 + i, 1.0), (right[i][0], None)])
    right, schema = right[:-3], "k int, v double"
    found = compare_tables(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], folder=out, fanout=fanout, small=small, open_ranges=open_ranges
    )
    want = plain_differences([(k, str(v)) for k, v in left], [(k, str(0.0 if v == 0 else v)) for k, v in right])
    assert rows_of(found.rows) == want


def test_only_ranges_that_differ_are_refined(spark, out):
    left = spark.range(50_000).selectExpr("md5(string(id)) AS k", "id AS v")
    right = left.where("v <> 17").withColumn("v", F.when(F.col("v") == 33_333, -1).otherwise(F.col("v")))
    found = compare_tables(left, right, ["k"], folder=out, fanout=16, small=100)
    assert {(r["difference"], r["left_rows"], r["right_rows"]) for r in found.rows.collect()} == {("left only", 1, 0), ("changed", 1, 1)}
    assert [n <= 2 for _, n in found.levels] == [True] * len(found.levels) and len(found.levels) > 2
    assert all(looked <= 32 for looked, _ in found.levels)


def test_very_many_ranges_are_not_too_deep_for_the_planner(spark):
    ranges = [(10 * i, 10 * i + 2) for i in range(2000)]
    assert spark.range(30_000).withColumnRenamed("id", "__at").where(_within(ranges)).count() == 6000


def test_equal_and_empty_sides(spark, out):
    df = spark.range(100).selectExpr("id AS k", "map('a', id) AS m", "array(id) AS l")
    assert compare_tables(df, df.orderBy(F.desc("k")), ["k"], folder=f"{out}/1").rows.count() == 0
    assert compare_tables(df.limit(0), df.limit(0), ["k"], folder=f"{out}/2").rows.count() == 0
    assert compare_tables(df, df.limit(0), ["k"], folder=f"{out}/3").rows.where("difference = 'left only'").count() == 100
    with pytest.raises(SettingError):
        compare_tables(df, df, ["k"], folder=out, fanout=1)


def test_a_comparison_moves_rows_once_and_joins_nothing(spark, out):
    left = spark.range(0, 3000, 1, 3).selectExpr("id AS k", "id % 7 AS v").unionByName(spark.sql("SELECT -1L AS k, 1L AS v UNION ALL SELECT -1, 2"))
    right = left.withColumn("v", F.when(F.col("k") == -1, F.lit(1)).otherwise(F.col("v"))).where("k <> 5")
    found = compare_tables(left, right, ["k"], folder=out, small=10, open_ranges=4)
    assert rows_of(found.rows) == [(-1, "changed", 2, 2), (5, "left only", 1, 0)]
    wide = compare_tables(left, right.withColumn("v", F.col("v") + 1), ["k"], folder=f"{out}/2", small=10, open_ranges=4)  # all at once
    assert wide.rows.count() == 3001
    for rows in (found.rows, wide.rows):
        text = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    # hashes are written where rows were read, in order within each file
    places = spark.read.parquet(f"{out}/left").selectExpr("__at", "_metadata.file_path AS f", "_metadata.row_index AS i")
    assert places.select("f").distinct().count() == left.rdd.getNumPartitions()
    by_file = {}
    for at, f, _ in sorted(places.collect(), key=lambda r: (r["f"], r["i"])):
        by_file.setdefault(f, []).append(at)
    assert all(ats == sorted(ats) for ats in by_file.values())
