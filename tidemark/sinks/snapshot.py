"""A Parquet table that changes by atomic commits and rewrites only touched files.

Layout under the table's folder::

    data/<run>/part-*.parquet    immutable files, one folder per write
    commits/<version>.json       schema and content of one version

The commit with the highest version is the table. It names whole runs, and single files
only of a run of which some have been rewritten, so a commit stays small however large the
load was. What no commit names does not exist for readers: a crash at any point leaves the
previous version whole. There is no row level delete, no log to replay and no read of an
older version; where a lakehouse format is available use ``DeltaTarget`` instead.
"""

from __future__ import annotations

import re
import time
import uuid
import zlib
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConcurrentWriteError, SchemaConflictError, SettingError
from tidemark.functions.render import render_text
from tidemark.operators.upsert import apply_updates, has_key, last_writer, named, new_rows, require_keys
from tidemark.sinks.storage import at_once, require_shared, storage

MIN_RETAIN_HOURS = 168  # fixed value: the shortest clean-up window accepted

# One task may write a whole table, read over one connection; files stay small enough to be
# rewritten one by one all the same.
MAX_ROWS_PER_FILE = 5_000_000

# How many intervals describe the keys of a change.
KEY_RANGES = 64

# Repeated rows of a change, and bytes of their keys' files, up to which these keys are sent to every task.
FEW_REPEATED = 1_000_000
FEW_REPEATED_BYTES = 32 * 1024 * 1024

# What compact() takes for a small run unless told otherwise.
SMALL_RUN_BYTES = 64 * 1024 * 1024

_RUN = re.compile("[0-9a-f]{32}")
_COMMIT = re.compile("[0-9]{20}[.]json")

# Key types whose bounds survive the trip through the driver unchanged.
_BOUNDED_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.StringType)


@dataclass(frozen=True)
class Commit:
    """One published version. ``runs`` maps a run to its live files, or to None for all."""

    version: int
    schema: T.StructType
    runs: dict[str, list[str] | None]


@dataclass(frozen=True)
class Staged:
    """Rows written once beneath the table, not yet part of it; runs as in ``Commit``."""

    frame: DataFrame
    runs: dict[str, list[str] | None]


@dataclass(frozen=True)
class MergeStats:
    rows_fetched: int
    rows_inserted: int
    rows_updated: int
    rows_superseded: int
    newest: str | None = None


class SnapshotTarget:
    def __init__(self, spark: SparkSession, uri: str):
        self.spark = spark
        self.uri = uri.rstrip("/")
        self.storage = storage(spark)

    # ------------------------------------------------------------------ reading

    def current(self) -> Commit | None:
        """The latest commit, or None if the table does not exist."""
        version = max((v for v, _ in self._versions()), default=None)
        if version is None:
            return None
        content = self.storage.read_json(self._commit_uri(version))
        return Commit(version, T.StructType.fromJson(content["schema"]), content["runs"])

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self) -> DataFrame:
        commit = self.current()
        if commit is None:
            raise SettingError(f"there is no table at {self.uri}")
        return self.frame(commit.schema, commit.runs)

    def paths(self, runs: dict[str, list[str] | None]) -> list[str]:
        """Folders of whole runs and files of partial ones."""
        return [
            path
            for run, names in runs.items()
            for path in (
                [self._run_uri(run)] if names is None else [f"{self._run_uri(run)}/{name}" for name in names]
            )
        ]

    def frame(self, schema: T.StructType, runs: dict[str, list[str] | None]) -> DataFrame:
        """Runs as a frame of ``schema``; columns a file lacks read as NULL."""
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self.paths(runs))

    # ------------------------------------------------------------------ writing

    def open(self, schema: T.StructType) -> Commit:
        """The current commit, or an unpublished empty one for a table not created yet."""
        return self.current() or Commit(-1, schema, {})

    def open_or_create(self, schema: T.StructType) -> Commit:
        """The current commit; a missing table is created empty."""
        base = self.open(schema)
        return base if base.version >= 0 else self.commit(base, schema, {})

    def stage(self, df: DataFrame) -> Staged:
        """Writes ``df`` once. What follows reads these files, never the source again."""
        require_shared(self.spark, self.uri)
        run = uuid.uuid4().hex
        df.write.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(self._run_uri(run))
        return Staged(self.spark.read.schema(df.schema).parquet(self._run_uri(run)), {run: None})

    def stage_by_key(self, df: DataFrame, keys: list[str]) -> Staged:
        """The same in key order: every file has a key range of its own, so that a later change
        finds few files. Rows without a key are dealt by a hash, not all to one task."""
        columns = [named(k) for k in keys]
        rest = F.xxhash64(*[named(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
        return self.stage(df.repartitionByRange(*columns, rest).sortWithinPartitions(*columns))

    def discard(self, staged: Staged) -> None:
        """Removes staged runs that no commit names."""
        for run in staged.runs:
            self.storage.delete(self._run_uri(run))

    def commit(self, base: Commit, schema: T.StructType, runs: dict[str, list[str] | None]) -> Commit:
        """Publishes the version after ``base``; raises if someone else already did."""
        version = base.version + 1
        content = {"schema": schema.jsonValue(), "runs": runs}
        try:
            self.storage.create_json(f"{self.uri}/commits", f"{version:020d}.json", content)
        except ConcurrentWriteError as e:
            e.table = e.table or self.uri
            raise
        return Commit(version, schema, runs)

    def publish(self, df: DataFrame) -> Commit:
        """Replaces the whole table by ``df``: bulk load, rebuild, checkpoint row."""
        base = self.open(df.schema)
        return self.commit(base, df.schema, self.stage(df).runs)

    def replace(
        self, staged: Staged, keys: list[str], watermark: str, type_name: str = "", base: Commit | None = None
    ) -> MergeStats:
        """Makes the staged rows the whole table, in one commit; a changed schema is accepted."""
        base = Commit((base or self.open(staged.frame.schema)).version, staged.frame.schema, {})
        stats = self.merge(staged, keys, watermark, type_name, base)
        if not stats.rows_fetched and base.version >= 0:  # a first version is published by the merge
            self.commit(base, base.schema, {})
        return stats

    def merge(
        self, staged: Staged, keys: list[str], watermark: str, type_name: str = "", base: Commit | None = None
    ) -> MergeStats:
        """Upserts staged rows by key in one commit, rewriting only files with a match.

        Counts come from aggregates over written files, never from task-side counters, so
        a retried task or a lost executor cannot change them.
        """
        keys = require_keys(keys)
        base = base or self.open(staged.frame.schema)
        schema = evolve(base.schema, staged.frame.schema)
        totals = staged_totals(staged.frame, keys, watermark, type_name)
        fetched, superseded = totals["fetched"], totals["superseded"]
        if not fetched:
            self.discard(staged)
            if base.version < 0:
                self.commit(base, schema, {})
            return MergeStats(0, 0, 0, 0)
        spelled = {n.lower(): n for n in schema.names}
        keys = [spelled[k.lower()] for k in keys]
        rename = lambda df: df.toDF(*[spelled[n.lower()] for n in df.columns])
        if superseded:
            staged = self._settled(staged, rename, keys, spelled[watermark.lower()], superseded)
        delta = rename(staged.frame)
        touched, updated = self._touched(base, delta, keys, totals) if base.runs else ({}, 0)
        if not touched:
            self.commit(base, schema, {**base.runs, **staged.runs})
            return MergeStats(fetched, fetched - superseded, 0, superseded, totals["newest"])

        old = self.frame(schema, touched)
        # A change is mostly far smaller than the files it touches: joined from their side, Spark can
        # broadcast it, and the files' rows move once, into key order.
        merged = apply_updates(old, delta, keys).unionByName(new_rows(delta, old, keys), allowMissingColumns=True)
        written = self.stage_by_key(merged.select(*map(named, schema.names)), keys)
        self.commit(base, schema, {**self._without(base.runs, touched), **written.runs})
        inserted = _rows_gained(old, written.frame)
        self.discard(staged)
        return MergeStats(fetched, inserted, updated, superseded, totals["newest"])

    def _settled(self, staged: Staged, rename, keys: list[str], watermark: str, superseded: int) -> Staged:
        """The staged rows with repeated keys reduced to their last writers.

        Only the files that hold a repeated key are written again. The repeated keys, at most as many as there
        are superseded rows, are written once for all that reads them. If they are few, every task gets them
        and only their rows are moved and go through a window; else all rows of these files do, once.
        """
        columns = [named(k) for k in keys]
        frame = rename(staged.frame)
        names = [named(n) for n in frame.columns]
        found = self.stage(frame.where(has_key(keys)).groupBy(*columns).count().where("count > 1").select(*columns))
        few = superseded <= FEW_REPEATED and sum(self.storage.size(self._run_uri(run)) for run in found.runs) <= FEW_REPEATED_BYTES
        repeated = F.broadcast(found.frame) if few else found.frame
        marked = frame.select(*columns, _file_mark().alias("__file"))
        hits = marked.join(repeated, keys, "left_semi").select("__file").distinct().collect()
        files = self._by_mark(staged.runs, {r["__file"] & 0xFFFFFFFFFFFFFFFF for r in hits})
        rows = rename(self.frame(staged.frame.schema, files))
        if few:
            winners = last_writer(rows.join(repeated, keys, "left_semi").select(*names), keys, watermark)
            settled = rows.join(repeated, keys, "left_anti").select(*names).unionByName(winners)
        else:
            settled = last_writer(rows, keys, watermark)
        written = self.stage(settled.toDF(*staged.frame.columns))
        self.discard(found)
        runs = {**self._without(staged.runs, files), **written.runs}
        return Staged(self.frame(staged.frame.schema, runs), runs)

    def _touched(self, base: Commit, delta: DataFrame, keys: list[str], totals) -> tuple[dict[str, list[str]], int]:
        """Files holding a key of ``delta``, by run, and how many of their rows match.

        Reads only key columns, and only row groups whose key range meets the delta's. A
        file travels as a checksum of its run and name, eight bytes beside each key instead
        of a path; should two files ever share one, a file is rewritten needlessly but
        correctly.
        """
        wanted = has_key(keys)
        for i, key in enumerate(keys):
            if f"low_{i}" in totals:
                wanted = wanted & named(key).between(F.lit(totals[f"low_{i}"]), F.lit(totals[f"high_{i}"]))
        wanted = wanted & _key_ranges(delta, keys[0], totals)
        columns = [named(k) for k in keys]
        held = self.frame(base.schema, base.runs).where(wanted).select(*columns, _file_mark().alias("__file"))
        hits = held.join(delta.select(*columns), keys, "left_semi").groupBy("__file").count().collect()
        touched = self._by_mark(base.runs, {r["__file"] & 0xFFFFFFFFFFFFFFFF for r in hits})
        return touched, sum(r["count"] for r in hits)

    def _by_mark(self, runs: dict, marks: set[int]) -> dict[str, list[str]]:
        """The files of these marks, by run; only runs that have one are listed."""
        run_marks = {m >> 32 for m in marks}
        found = {}
        for run, names in runs.items():
            high = zlib.crc32(run.encode())
            if high in run_marks:
                found[run] = [n for n in names or self._names(run) if (high << 32 | zlib.crc32(n.encode())) in marks]
        return {run: names for run, names in found.items() if names}

    def _without(self, runs: dict, touched: dict[str, list[str]]) -> dict[str, list[str] | None]:
        kept = {}
        for run, names in runs.items():
            if run not in touched:
                kept[run] = names
                continue
            gone = set(touched[run])
            left = [n for n in names or self._names(run) if n not in gone]
            if left:
                kept[run] = left
        return kept

    def _names(self, run: str) -> list[str]:
        return [n for n, _ in self.storage.list(self._run_uri(run)) if n.endswith(".parquet")]

    # -------------------------------------------------------------- maintenance

    def compact(self, keys: list[str], below_bytes: int = SMALL_RUN_BYTES) -> int:
        """Writes the runs of less than ``below_bytes`` together, in key order; returns how many.

        Rows stay the same. To be called when many small changes have left many small runs.
        """
        base = self.current()
        if base is None:
            return 0
        sizes = at_once(self.spark, self.storage.size, [self._run_uri(run) for run in base.runs])
        small = {run: base.runs[run] for run, size in zip(base.runs, sizes) if size < below_bytes}
        if len(small) < 2:
            return 0
        spelled = {n.lower(): n for n in base.schema.names}
        written = self.stage_by_key(self.frame(base.schema, small), [spelled[k.lower()] for k in keys])
        self.commit(base, base.schema, {**{r: n for r, n in base.runs.items() if r not in small}, **written.runs})
        return len(small)

    def vacuum(self, retain_hours: float = MIN_RETAIN_HOURS) -> int:
        """Removes what no version inside the window needs; returns how many files and folders.

        The current version is always kept, and so is every data folder younger than the
        window, which may belong to a write still under way.
        """
        if retain_hours < MIN_RETAIN_HOURS:
            raise SettingError(f"retention must be at least {MIN_RETAIN_HOURS} hours")
        return self._vacuum_before(time.time() - retain_hours * 3600)

    def _vacuum_before(self, horizon: float) -> int:
        commits = sorted(self._versions())
        live: dict[str, set[str] | None] = {}
        # A version stays readable until its successor is older than the window.
        for i, (version, _) in enumerate(commits):
            superseded_at = commits[i + 1][1] / 1000 if i + 1 < len(commits) else None
            if superseded_at is not None and superseded_at < horizon:
                self.storage.delete(self._commit_uri(version))
                continue
            for run, names in self.storage.read_json(self._commit_uri(version))["runs"].items():
                if names is None or live.get(run, set()) is None:
                    live[run] = None
                else:
                    live[run] = live.get(run, set()) | set(names)
        removed = 0
        for run, modified in self.storage.list(f"{self.uri}/data"):
            if not _RUN.fullmatch(run):
                continue  # a folder of another table whose name goes on from this one's
            # A store may not keep a folder's time: the newest file inside tells as well.
            files = self.storage.list(self._run_uri(run))
            if max([modified, *(at for _, at in files)]) / 1000 >= horizon:
                continue
            if run not in live:
                self.storage.delete(self._run_uri(run))
                removed += 1
            elif live[run] is not None:
                for name in set(self._names(run)) - live[run]:
                    self.storage.delete(f"{self._run_uri(run)}/{name}")
                    removed += 1
        return removed

    def _versions(self) -> list[tuple[int, int]]:
        names = self.storage.list(f"{self.uri}/commits")
        return [(int(n[:-5]), modified) for n, modified in names if _COMMIT.fullmatch(n)]

    def _run_uri(self, run: str) -> str:
        return f"{self.uri}/data/{run}"

    def _commit_uri(self, version: int) -> str:
        return f"{self.uri}/commits/{version:020d}.json"


def evolve(current: T.StructType, incoming: T.StructType) -> T.StructType:
    """The target's schema after a merge: new source columns are added, none changes type."""
    known = {f.name.lower(): f for f in current.fields}
    added = []
    for f in incoming.fields:
        old = known.get(f.name.lower())
        if old is None:
            added.append(T.StructField(f.name, f.dataType, True))
        elif old.dataType != f.dataType:
            raise SchemaConflictError(
                f"column {f.name} is {f.dataType.simpleString()} at the source and "
                f"{old.dataType.simpleString()} in the target; re-sync into a fresh path"
            )
    return T.StructType(current.fields + added)


def _file_mark():
    """Run and name of a row's file as two checksums in one number."""
    place = F.substring_index("_metadata.file_path", "/", -2)
    run, name = F.substring_index(place, "/", 1), F.substring_index(place, "/", -1)
    return F.shiftleft(F.crc32(run.cast("binary")), 32).bitwiseOR(F.crc32(name.cast("binary")))


def _key_ranges(delta: DataFrame, key: str, totals):
    """Up to ``KEY_RANGES`` intervals of a whole-number key that hold all of the delta's keys.

    Most changes fall on recent keys and a few on old ones: the gaps in between are row
    groups that need not be read. Other key types are left to their overall bounds.
    """
    low, high = totals["low_0"] if "low_0" in totals else None, totals["high_0"] if "high_0" in totals else None
    if low is None or not isinstance(delta.schema[key].dataType, T.IntegralType) or high - low >= 1 << 62:
        return F.lit(True)
    width = (high - low) // KEY_RANGES + 1
    slot = F.floor((named(key) - F.lit(low)) / F.lit(width))
    rows = delta.where(named(key).isNotNull()).groupBy(slot.alias("slot")).agg(F.min(named(key)), F.max(named(key))).collect()
    return reduce(or_, [named(key).between(F.lit(lo), F.lit(hi)) for _, lo, hi in sorted(rows)])


def _rows_gained(before: DataFrame, after: DataFrame) -> int:
    """How many more rows ``after`` has. Both are files: only their footers are read."""
    counts = after.agg(F.count(F.lit(1)).alias("n")).union(before.agg(-F.count(F.lit(1))))
    return counts.agg(F.sum("n")).first()[0]


def staged_totals(staged: DataFrame, keys: list[str], watermark: str, type_name: str):
    """Row count, superseded rows, most rows of a key, newest watermark as text and key bounds, in one job.

    Grouped by key with map-side partial aggregation: a hot key, NULL included, leaves each
    task as one row.
    """
    per_key = staged.groupBy(*map(named, keys)).agg(F.count(F.lit(1)).alias("__n"), F.max(named(watermark)).alias("__w"))
    keyed = has_key(keys)
    bounds = [
        agg
        for i, k in enumerate(keys)
        if isinstance(staged.schema[k].dataType, _BOUNDED_TYPES)
        for agg in (F.min(F.when(keyed, named(k))).alias(f"low_{i}"), F.max(F.when(keyed, named(k))).alias(f"high_{i}"))
    ]
    newest = render_text(F.max("__w"), staged.schema[watermark].dataType, type_name)
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("fetched"),
        F.coalesce(F.sum(F.when(keyed, F.col("__n") - 1)), F.lit(0)).alias("superseded"),
        F.coalesce(F.max(F.when(keyed, F.col("__n"))), F.lit(0)).alias("most"),
        newest.alias("newest"),
        *bounds,
    ).first()
