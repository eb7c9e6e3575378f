"""A target whose rows are dealt to buckets by a hash of their key.

``SnapshotTarget`` finds the files of a change by their key ranges, which helps little where changed keys
are scattered: GUIDs, or orders of all ages. Here the key itself says in which bucket a row lies, so a
merge reads and writes the buckets that its change falls in and no others, whatever the order of the keys.

A bucket is a folder ``data/<run>/__bucket=<b>`` written by Spark's own ``partitionBy``; a version names, for
every run, the buckets that are live in it. Both sides of a merge are moved once, by bucket: rows of a key meet
there, and one window takes the newer one, of rows that the change repeats the last writer, and carries over
columns that the change lacks. No join, no sampling, no second read; and how many rows were inserted follows from
the files' row counts. Only a change that mostly repeats itself, or repeats a key very often, is first reduced within
each task. Very large buckets are dealt to several tasks, by another hash of the key.

The number of buckets is fixed when a table is created: choose it so that a bucket is some hundred
megabytes. A first load moves all rows once by bucket, which ``SnapshotTarget`` does not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SettingError
from tidemark.operators.upsert import has_key, last_writer, latest_first, named, require_keys
from tidemark.sinks.snapshot import MAX_ROWS_PER_FILE, Commit, MergeStats, SnapshotTarget, Staged, evolve, staged_totals
from tidemark.sinks.storage import require_shared

#: Buckets of a new table unless told otherwise.
BUCKETS = 64

#: Rows of one key that may meet in a task as they are.
HOT_ROWS = 10_000
#: Rows of a bucket that one task sorts, about.
ROWS_PER_TASK = 2_000_000

_BUCKET, _NEWER, _RANK = "__bucket", "__newer", "__rank"
_FOLDER = f"{_BUCKET}="


def bucket_of(schema: T.StructType, keys: list[str], buckets: int) -> Column:
    """The bucket of a row: by its key, or by all its columns if its key has a NULL, so that such rows spread."""
    hashable = [named(f.name) for f in schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by_key = F.xxhash64(*[named(k) for k in keys])
    return F.pmod(F.when(has_key(keys), by_key).otherwise(F.xxhash64(*hashable)), F.lit(buckets)).cast("int")


class BucketedTarget(SnapshotTarget):
    """``buckets`` counts for a new table only; an existing one keeps its own."""

    def __init__(self, spark: SparkSession, uri: str, buckets: int = BUCKETS):
        if buckets < 1:
            raise SettingError("a table needs at least one bucket")
        super().__init__(spark, uri)
        self.buckets = buckets

    @classmethod
    def factory(cls, buckets: int = BUCKETS):
        """For ``target_factory=`` of the plans."""
        return lambda spark, uri: cls(spark, uri, buckets)

    # ------------------------------------------------------------------ reading

    def frame(self, schema: T.StructType, runs: dict[str, list[str] | None]) -> DataFrame:
        # a whole run is a folder of buckets, whose names would come along as a column
        return super().frame(schema, runs).select(*[named(n) for n in schema.names])

    def live(self, commit: Commit) -> dict[int, list[str]]:
        """For each bucket that has rows, the runs that hold them."""
        found: dict[int, list[str]] = {}
        for run, names in commit.runs.items():
            for name in names or self._buckets_of(run):
                found.setdefault(int(name[len(_FOLDER) :]), []).append(run)
        return found

    def _buckets_of(self, run: str) -> list[str]:
        return [n for n, _ in self.storage.list(self._run_uri(run)) if n.startswith(_FOLDER)]

    def _names(self, run: str) -> list[str]:
        return self._buckets_of(run)

    # ------------------------------------------------------------------ writing

    def publish(self, df: DataFrame) -> Commit:
        raise SettingError("a table in buckets needs its keys: merge or replace instead of publishing a frame")

    def compact(self, keys: list[str], below_bytes: int = 0) -> int:
        """Nothing to do: a merge leaves every bucket it touches in one run."""
        return 0

    def merge(
        self, staged: Staged, keys: list[str], watermark: str, type_name: str = "", base: Commit | None = None
    ) -> MergeStats:
        """Upserts staged rows by key in one commit, reading and writing only buckets with a change."""
        keys = require_keys(keys)
        base = base or self.open(staged.frame.schema)
        schema = evolve(base.schema, staged.frame.schema)
        totals = staged_totals(staged.frame, keys, watermark, type_name)
        fetched, superseded = totals["fetched"], totals["superseded"]
        if not fetched:
            self.discard(staged)
            if base.version < 0:
                self.commit(base, _with_buckets(schema, self.buckets, keys), {})
            return MergeStats(0, 0, 0, 0)
        spelled = {n.lower(): n for n in schema.names}
        keys = [spelled[k.lower()] for k in keys]
        buckets = self._settings(base.schema, keys) or self.buckets
        schema = _with_buckets(schema, buckets, keys)
        delta = staged.frame.toDF(*[spelled[n.lower()] for n in staged.frame.columns])
        dealt = bucket_of(delta.schema, keys, buckets)
        live = self.live(base)
        # the rows of a key lie in one bucket: which ones are superseded does not matter here
        into = {r[0] for r in delta.select(dealt.alias(_BUCKET)).distinct().collect()}  # no more than there are buckets
        hit = sorted(b for b in into if b in live)
        repeats = None
        if superseded and (2 * superseded > fetched or totals["most"] > HOT_ROWS):
            delta = last_writer(delta, keys, spelled[watermark.lower()])
        elif superseded:
            repeats = latest_first(delta.schema, keys, spelled[watermark.lower()])
        delta = delta.withColumn(_BUCKET, dealt)
        touched: dict[str, list[str]] = {}
        for b in hit:
            for run in live[b]:
                touched.setdefault(run, []).append(f"{_FOLDER}{b}")
        old = self.frame(schema, touched)
        held = self._count(schema, touched)
        slices = -(-(fetched + held) // (len(into) * ROWS_PER_TASK))
        merged = taken_over(old.withColumn(_BUCKET, bucket_of(schema, keys, buckets)), delta, keys, repeats, buckets, slices)
        run = self._write(merged.select(*[named(n) for n in schema.names], _BUCKET))
        left = {b: runs for b, runs in live.items() if b not in set(hit)}
        runs: dict[str, list[str] | None] = {run: sorted(self._buckets_of(run))}
        for b in sorted(left):
            for r in left[b]:
                runs.setdefault(r, []).append(f"{_FOLDER}{b}")
        self.commit(base, schema, runs)
        self.discard(staged)
        inserted = self._count(schema, {run: runs[run]}) - held
        return MergeStats(fetched, inserted, fetched - superseded - inserted, superseded, totals["newest"])

    def _settings(self, schema: T.StructType, keys: list[str]) -> int | None:
        """The number of buckets of an existing table; its keys have to be the ones it was dealt by."""
        found = [f.metadata[_BUCKET] for f in schema.fields if _BUCKET in (f.metadata or {})]
        if not found:
            return None
        dealt_by = [f["key"] for f in sorted(found, key=lambda f: f["place"])]
        if [k.lower() for k in dealt_by] != [k.lower() for k in keys]:
            raise SettingError(f"the table at {self.uri} is dealt by {', '.join(dealt_by)}; rebuild it to change its key")
        return found[0]["buckets"]

    def _write(self, rows: DataFrame) -> str:
        """One run with a folder for each bucket; a bucket is one file unless it is very large."""
        require_shared(self.spark, self.uri)
        run = uuid.uuid4().hex
        rows.write.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).partitionBy(_BUCKET).parquet(self._run_uri(run))
        return run

    def _count(self, schema: T.StructType, runs: dict[str, list[str] | None]) -> int:
        """Rows of these folders, from their footers."""
        return self.frame(schema, runs).count() if runs else 0


def taken_over(
    old: DataFrame, delta: DataFrame, keys: list[str], repeats: list[Column] | None = None, buckets: int = 1, slices: int = 1
) -> DataFrame:
    """Rows after the merge, both sides moved once by bucket: of a key the delta's row, else the old one.

    ``delta`` holds each key once, unless ``repeats`` orders the rows of a key. Columns that it lacks keep their old
    value. Rows without a key all stay. With several ``slices`` each of the ``buckets`` is dealt to that many tasks.
    """
    lacking = [c for c in old.columns if c not in delta.columns]
    both = old.withColumn(_NEWER, F.lit(0)).unionByName(delta.withColumn(_NEWER, F.lit(1)), allowMissingColumns=True)
    keyed = both.where(has_key(keys))
    if slices > 1:  # for now the column counts slices, not buckets
        keyed = keyed.withColumn(_BUCKET, F.col(_BUCKET) * slices + F.pmod(F.hash(*[named(k) for k in keys]), F.lit(slices)))
    moved = keyed.repartitionById(buckets * slices, _BUCKET) if slices > 1 else keyed.repartition(_BUCKET)
    of_key = Window.partitionBy(_BUCKET, *[named(k) for k in keys])
    kept = {c: F.first(F.when(F.col(_NEWER) == 0, named(c)), ignorenulls=True).over(of_key) for c in lacking}
    ranked = moved.withColumn(_RANK, F.row_number().over(of_key.orderBy(F.desc(_NEWER), *(repeats or []))))
    newest = ranked.withColumns(kept) if kept else ranked
    newest = newest.where(F.col(_RANK) == 1).drop(_RANK)
    if slices > 1:
        newest = newest.withColumn(_BUCKET, F.expr(f"CAST({_BUCKET} div {slices} AS INT)"))
    nameless = both.where(~has_key(keys)).repartition(_BUCKET)
    return newest.unionByName(nameless).drop(_NEWER)


def _with_buckets(schema: T.StructType, buckets: int, keys: list[str]) -> T.StructType:
    """The schema with the number of buckets noted at its key columns."""
    places = {k.lower(): i for i, k in enumerate(keys)}
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, f.nullable, {_BUCKET: {"buckets": buckets, "key": f.name, "place": places[f.name.lower()]}})
            if f.name.lower() in places
            else f
            for f in schema.fields
        ]
    )
