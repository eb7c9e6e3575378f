import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.errors import ConcurrentWriteError, SchemaConflictError, SettingError
from tidemark.operators.upsert import last_writer, upsert, upsert_metrics
from tidemark.sinks import snapshot
from tidemark.sinks.snapshot import SnapshotTarget

PEOPLE = "id int, name string, w int"


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=str)


def merge(table, df, keys=("id",), watermark="w"):
    return table.merge(table.stage(df), list(keys), watermark)


def test_insert_then_update_then_insert(spark, out):
    table = SnapshotTarget(spark, out)
    people = lambda data: spark.createDataFrame(data, PEOPLE)
    first = merge(table, people([(1, "alice", 1), (2, "bob", 1)]))
    assert (first.rows_inserted, first.rows_updated) == (2, 0)
    second = merge(table, people([(1, "alice-v2", 2)]))
    assert (second.rows_inserted, second.rows_updated) == (0, 1)
    third = merge(table, people([(3, "carol", 3)]))
    assert (third.rows_inserted, third.rows_updated, third.newest) == (1, 0, "3")
    assert rows(table.read()) == [(1, "alice-v2", 2), (2, "bob", 1), (3, "carol", 3)]


def test_an_empty_key_is_refused(spark, out):
    df = spark.createDataFrame([(1, "a", 1)], PEOPLE)
    with pytest.raises(SettingError):
        upsert(df, df, [])
    with pytest.raises(SettingError):
        merge(SnapshotTarget(spark, out), df, keys=())


def test_null_keys_match_nothing_and_are_inserted_again(spark, out):
    table = SnapshotTarget(spark, out)
    data = [(1, "a", 1), (None, "b", 1), (None, "b", 1)]
    assert merge(table, spark.createDataFrame(data, PEOPLE)).rows_inserted == 3
    again = merge(table, spark.createDataFrame(data, PEOPLE))
    assert (again.rows_inserted, again.rows_updated, again.rows_superseded) == (2, 1, 0)
    assert rows(table.read()) == [(1, "a", 1)] + [(None, "b", 1)] * 4


def test_a_partly_null_composite_key_matches_nothing(spark):
    schema = "a int, b int, v string"
    target = spark.createDataFrame([(1, 1, "old"), (1, None, "old")], schema)
    delta = spark.createDataFrame([(1, 1, "new"), (1, None, "new")], schema)
    assert rows(upsert(target, delta, ["a", "b"])) == [(1, 1, "new"), (1, None, "new"), (1, None, "old")]


def test_matched_rows_take_nulls_too(spark):
    target = spark.createDataFrame([(1, "a", 1)], PEOPLE)
    delta = spark.createDataFrame([(1, None, 2)], PEOPLE)
    assert rows(upsert(target, delta, ["id"])) == [(1, None, 2)]


def test_a_key_held_twice_by_the_target_is_updated_twice(spark, out):
    table = SnapshotTarget(spark, out)
    table.publish(spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "c", 1)], PEOPLE))
    stats = merge(table, spark.createDataFrame([(1, "z", 2), (3, "n", 2)], PEOPLE))
    assert (stats.rows_inserted, stats.rows_updated) == (1, 2)
    assert rows(table.read()) == [(1, "z", 2), (1, "z", 2), (2, "c", 1), (3, "n", 2)]


def test_the_last_writer_wins_and_ties_have_one_answer(spark):
    data = [(1, "x", 5), (1, "y", 5), (1, "z", 4), (2, "n", None), (2, "m", 1), (None, "p", 1), (None, "q", 1)]
    expected = [(1, "y", 5), (2, "m", 1), (None, "p", 1), (None, "q", 1)]
    for parts in (1, 5):
        got = last_writer(spark.createDataFrame(data, PEOPLE).repartition(parts), ["id"], "w")
        assert rows(got) == sorted(expected, key=str)


def test_losers_are_dropped_before_the_shuffle(spark):
    plan = last_writer(spark.createDataFrame([(1, "x", 5)], PEOPLE), ["id"], "w")._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_metrics(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "c", 1)], PEOPLE)
    delta = spark.createDataFrame([(2, "B", 2), (3, "d", 2), (None, "e", 2)], PEOPLE)
    got = upsert_metrics(target, delta, ["id"]).first().asDict()
    assert got == {"rows_fetched": 3, "rows_inserted": 2, "rows_updated": 1, "rows_kept": 2}


def test_only_touched_files_are_rewritten(spark, out):
    table = SnapshotTarget(spark, out)
    low = spark.range(100).selectExpr("cast(id as int) id", "'a' name", "1 w")
    high = spark.range(100, 200).selectExpr("cast(id as int) id", "'a' name", "1 w")
    merge(table, low.coalesce(1))
    merge(table, high.coalesce(1))
    first, second = table.current().runs
    merge(table, spark.createDataFrame([(150, "new", 2)], PEOPLE))
    runs = table.current().runs
    assert first in runs and runs[first] is None and second not in runs
    assert table.read().where("name = 'new'").count() == 1 and table.read().count() == 200


def test_a_run_of_several_files_loses_only_the_touched_one(spark, out):
    table = SnapshotTarget(spark, out)
    data = spark.range(0, 400, 1, 4).selectExpr("cast(id as int) id", "'a' name", "1 w")
    merge(table, data)
    [run] = table.current().runs
    for i, key in enumerate((10, 250, 10), start=2):
        stats = merge(table, spark.createDataFrame([(key, "new", i), (1000 + i, "ins", i)], PEOPLE))
        assert (stats.rows_inserted, stats.rows_updated) == (1, 1)
    assert len(table.current().runs[run]) == 2
    got = table.read()
    assert got.count() == 403 and rows(got.where("name = 'new'")) == [(10, "new", 4), (250, "new", 3)]


def test_many_runs_are_pruned_by_several_key_ranges(spark, out):
    table = SnapshotTarget(spark, out)
    for start in range(0, 5000, 1000):
        merge(table, spark.range(start, start + 1000).selectExpr("id", "'a' name", f"{start} w").coalesce(1))
    delta = spark.createDataFrame([(-5, "low", 1), (3, "new", 1), (4999, "new", 1), (9000, "high", 1)], "id long, name string, w int")
    before = list(table.current().runs)
    stats = merge(table, delta)
    assert (stats.rows_inserted, stats.rows_updated) == (2, 2)
    assert set(before[1:4]) <= set(table.current().runs) and not {before[0], before[4]} & set(table.current().runs)
    assert table.read().count() == 5002


def test_many_small_runs_are_written_together_when_asked(spark, out):
    table = SnapshotTarget(spark, out)
    for i in range(4):
        merge(table, spark.createDataFrame([(i, f"n{i}", i)], PEOPLE))
    assert len(table.current().runs) == 4
    stats = merge(table, spark.createDataFrame([(0, "again", 9), (9, "new", 9)], PEOPLE))
    assert (stats.rows_inserted, stats.rows_updated) == (1, 1) and len(table.current().runs) == 5
    assert table.compact(["id"]) == 5 and table.compact(["id"]) == 0 and len(table.current().runs) == 1
    assert rows(table.read()) == [(0, "again", 9), (1, "n1", 1), (2, "n2", 2), (3, "n3", 3), (9, "new", 9)]


def test_the_merge_statement_for_a_lakehouse_table_parses(spark):
    from tidemark.sinks.delta import DeltaTarget, merge_sql

    text = merge_sql("delta.`/lake/t`", ["a", "b"]).format(delta="v")
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in parsed
    with pytest.raises(SettingError, match="not configured"):
        DeltaTarget(spark, "/lake/t", "/lake/_staging")


def test_keys_at_both_ends_of_their_type(spark, out):
    table = SnapshotTarget(spark, out)
    ends = [(-(2**63), "low", 1), (2**63 - 1, "high", 1)]
    schema = "id long, name string, w int"
    merge(table, spark.createDataFrame(ends, schema))
    stats = merge(table, spark.createDataFrame([(k, "new", 2) for k, _, _ in ends] + [(0, "mid", 2)], schema))
    assert (stats.rows_inserted, stats.rows_updated) == (1, 2)


def test_a_lost_race_is_reported_and_changes_nothing(spark, out):
    table = SnapshotTarget(spark, out)
    merge(table, spark.createDataFrame([(1, "a", 1)], PEOPLE))
    base = table.current()
    merge(table, spark.createDataFrame([(2, "b", 2)], PEOPLE))
    staged = table.stage(spark.createDataFrame([(3, "c", 3)], PEOPLE))
    with pytest.raises(ConcurrentWriteError) as caught:
        table.merge(staged, ["id"], "w", base=base)
    assert caught.value.table
    assert rows(table.read()) == [(1, "a", 1), (2, "b", 2)]


def test_of_many_writers_at_the_same_moment_one_commits(spark, out):
    table = SnapshotTarget(spark, out)
    base = table.open_or_create(spark.createDataFrame([], PEOPLE).schema)
    start, won, lost = threading.Barrier(8), [], []

    def commit(i):
        start.wait()
        try:
            won.append(table.commit(base, base.schema, {}).version)
        except ConcurrentWriteError:
            lost.append(i)

    for _ in range(5):
        threads = [threading.Thread(target=commit, args=(i,)) for i in range(8)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        base = table.current()
    assert won == [1, 2, 3, 4, 5] and len(lost) == 35
    assert all(n.endswith(".json") for n, _ in table.storage.list(f"{out}/commits"))


@pytest.mark.parametrize("scheme", ["linkless mount", "hadoop"])
def test_other_stores_refuse_a_taken_name_too(spark, out, monkeypatch, scheme):
    table = SnapshotTarget(spark, out)
    if scheme == "hadoop":
        fs, _ = table.storage._fs(out)
        create = lambda name: _through_rename(table.storage, fs, f"{out}/commits", name)
    else:
        monkeypatch.setattr("os.link", lambda *a: (_ for _ in ()).throw(PermissionError()))
        create = lambda name: table.storage.create_json(f"{out}/commits", name, {"a": 1})
    create("1.json")
    with pytest.raises(Exception, match="committed first|already exists|FileAlreadyExists"):
        create("1.json")
    assert [n for n, _ in table.storage.list(f"{out}/commits") if n.endswith(".json")].count("1.json") == 1


def _through_rename(storage, fs, folder, name):
    aside = storage._path(f"{folder}/.{name}.aside")
    fs.create(aside, True).close()
    storage._rename(fs, aside, storage._path(f"{folder}/{name}"))


def test_what_was_never_committed_is_invisible(spark, out):
    table = SnapshotTarget(spark, out)
    merge(table, spark.createDataFrame([(1, "a", 1)], PEOPLE))
    table.stage(spark.createDataFrame([(9, "lost", 9)], PEOPLE))
    assert rows(table.read()) == [(1, "a", 1)]


def test_new_columns_are_added_and_retyped_ones_refused(spark, out):
    table = SnapshotTarget(spark, out)
    merge(table, spark.createDataFrame([(1, "a", 1), (2, "b", 1)], PEOPLE))
    merge(table, spark.createDataFrame([(2, "B", 2, 0.5)], PEOPLE + ", score double"))
    assert rows(table.read()) == [(1, "a", 1, None), (2, "B", 2, 0.5)]
    with pytest.raises(SchemaConflictError, match="name is int"):
        merge(table, spark.createDataFrame([(1, 1, 3)], "id int, name int, w int"))


def test_a_dropped_column_keeps_old_values(spark, out):
    table = SnapshotTarget(spark, out)
    merge(table, spark.createDataFrame([(1, "a", 1)], PEOPLE))
    merge(table, spark.createDataFrame([(1, 2), (2, 2)], "id int, w int"))
    assert rows(table.read()) == [(1, "a", 2), (2, None, 2)]


def test_mixed_case_names(spark, out):
    table = SnapshotTarget(spark, out)
    merge(table, spark.createDataFrame([(1, "a", 1)], "Id int, Name string, W int"), ["Id"], "W")
    merge(table, spark.createDataFrame([(1, "b", 2)], "ID int, name string, w int"), ["ID"], "w")
    assert table.read().columns == ["Id", "Name", "W"]
    assert rows(table.read()) == [(1, "b", 2)]


@pytest.mark.parametrize("kind, a, b", [("string", "k1", "k2"), ("date", None, None), ("decimal(10,2)", None, None)])
def test_other_key_types(spark, out, kind, a, b):
    literal = {"string": "'k{}'", "date": "date'2024-01-0{}'", "decimal(10,2)": "cast({}.5 as decimal(10,2))"}[kind]
    make = lambda i, v: spark.sql(f"SELECT {literal.format(i)} AS id, '{v}' AS name, 1 AS w")
    table = SnapshotTarget(spark, out)
    merge(table, make(1, "a").union(make(2, "a")))
    stats = merge(table, make(2, "b").union(make(3, "b")))
    assert (stats.rows_inserted, stats.rows_updated) == (1, 1)
    assert sorted(r["name"] for r in table.read().collect()) == ["a", "b", "b"]


def test_clean_up_keeps_the_current_version_and_young_files(spark, out):
    table = SnapshotTarget(spark, out)
    data = spark.range(0, 40, 1, 4).selectExpr("cast(id as int) id", "'a' name", "1 w")
    merge(table, data)
    for i in range(2, 5):
        merge(table, spark.createDataFrame([(1, f"v{i}", i)], PEOPLE))
    before = rows(table.read())
    assert table.vacuum() == 0
    with pytest.raises(SettingError):
        table.vacuum(24)
    far = 4_000_000_000
    assert table._vacuum_before(far) > 0
    assert rows(table.read()) == before and len(table.storage.list(f"{out}/commits")) >= 1
    stats = merge(table, spark.createDataFrame([(1, "after", 9)], PEOPLE))
    assert stats.rows_updated == 1 and table.read().count() == 40


keys = st.one_of(st.none(), st.integers(0, 6))
deltas = st.lists(st.lists(st.tuples(keys, st.text("ab", max_size=2), st.integers(0, 3)), max_size=6), min_size=1, max_size=3)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(deltas)
def test_merges_equal_a_model_of_them(spark, tmp_path_factory, batches):
    table = SnapshotTarget(spark, str(tmp_path_factory.mktemp("t")))
    table.open_or_create(spark.createDataFrame([], PEOPLE).schema)
    held, loose = {}, []
    for batch in batches:
        stats = merge(table, spark.createDataFrame(batch, PEOPLE))
        best = {}
        for k, v, w in batch:
            if k is None:
                loose.append((k, v, w))
            elif k not in best or (w, v) > best[k]:
                best[k] = (w, v)
        assert stats.rows_updated == len(best.keys() & held.keys())
        assert stats.rows_inserted == len(best.keys() - held.keys()) + sum(k is None for k, _, _ in batch)
        held |= best
    expected = [(k, v, w) for k, (w, v) in held.items()] + loose
    assert rows(table.read()) == sorted(expected, key=str)


def test_a_local_path_is_refused_on_a_cluster(spark, out, monkeypatch):
    from tidemark.sinks import storage

    rows = spark.createDataFrame([(1, "a", 1)], PEOPLE)
    monkeypatch.setattr(storage, "_in_one_process", lambda _: False)
    with pytest.raises(SettingError, match="local path"):
        SnapshotTarget(spark, out).publish(rows)
    spark.conf.set("spark.tidemark.sharedOutput", "true")
    try:
        SnapshotTarget(spark, out).publish(rows)
    finally:
        spark.conf.unset("spark.tidemark.sharedOutput")
    monkeypatch.setattr(storage, "_shared_folder", lambda _: f"file://{out}-shared")
    SnapshotTarget(spark, f"{out}-shared/t").publish(rows)
