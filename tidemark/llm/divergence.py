"""How far each source's words lie from those of the other sources of its language.

An index is built in a single pass over the texts. Every task gathers postings in memory, for each term
of a language its number of documents and its occurrences in each source, until ``block`` entries fill
it; then the block leaves as a run sorted by term and the memory is free again. Runs are dealt to shards by
a hash of language and term, and each shard merges its runs in term order: Spark's sorter keeps sorted
runs on disk and takes the next row from a heap over them. Equal terms then follow each other, and one
streaming pass adds them up to frequencies and drops terms of fewer than ``min_docs`` documents.

With p the smoothed share of a term in a group and q that in another source, the distance of the two is
the sum of f(p, q) over all kept terms of the language. Nearly all terms of a large vocabulary are
missing from nearly all sources, so the sum starts from what it would be if both lacked every term. It is
corrected by the histogram of each source's counts, as if the other lacked those terms, and by
corrections for terms that both have, streamed from the frequencies:
f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), with p0 and q0 the shares of a missing term.

What grows with the texts stays in tables. The table of groups (a row for each language and source) goes
to the driver and to every task; the result has a row for each two groups of a language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, written

#: Shares are whole numbers of this many parts.
PARTS = 1_000_000_000
#: Entries (terms of a language, and their sources) that a task's block holds before it leaves as a run.
BLOCK = 600_000
#: Pairs of sources looked at, or sums held, at one time.
AT_ONCE = 1_000_000

RUNS = "lang string, term binary, docs long, groups array<int>, counts array<long>"
SUMS = "g int, q int, value long"
#: Everything but letters ends a term; A-Z are lower-cased; bytes of other characters stay.
_FOLD = bytes(32 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if b <= 0x5A else b for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def _run(lang: str, docs: Counter, by_group: dict[int, Counter]) -> pa.RecordBatch:
    """One language's part of a block, sorted by term."""
    ordered = sorted(docs)
    place = dict(zip(ordered, range(len(ordered))))
    at = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in by_group.values()])
    group = np.concatenate([np.full(len(c), g, np.int32) for g, c in by_group.items()])
    count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in by_group.values()])
    order = np.argsort(at, kind="stable")
    offsets = pa.array(np.searchsorted(at[order], np.arange(len(ordered) + 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang], pa.string()).take(pa.array(np.zeros(len(ordered), np.int32))),
            pa.array(ordered, pa.binary()),
            pa.array(np.fromiter(map(docs.__getitem__, ordered), np.int64, len(ordered))),
            pa.ListArray.from_arrays(offsets, pa.array(group[order])),
            pa.ListArray.from_arrays(offsets, pa.array(count[order])),
        ],
        ["lang", "term", "docs", "groups", "counts"],
    )


def runs(docs: DataFrame, ids: dict[tuple[str, str], int], block: int = BLOCK) -> DataFrame:
    """Term-sorted runs of every task's blocks. ``docs`` has ``lang, source, text`` without null in the first two."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        found: dict[str, dict[int, Counter]] = {}

        def leave() -> Iterator[pa.RecordBatch]:
            for lang in sorted(seen):
                if seen[lang]:
                    run = _run(lang, seen[lang], {g: c for g, c in found[lang].items() if c})
                    for start in range(0, run.num_rows, 20_000):
                        yield run.slice(start, 20_000)
            seen.clear()
            found.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = terms(text)
                g = ids[lang, source]
                by_lang, by_group = seen.setdefault(lang, Counter()), found.setdefault(lang, {}).setdefault(g, Counter())
                held -= len(by_lang) + len(by_group)
                by_group.update(words)
                by_lang.update(set(words))
                held += len(by_lang) + len(by_group)
                if held >= block:
                    yield from leave()
                    held = 0
        yield from leave()

    return docs.select("lang", "source", "text").mapInArrow(index, RUNS)


def _merged(batch: pa.Table, last: bool, min_docs: int) -> tuple[pa.RecordBatch, pa.Table]:
    """Sums of rows of one term; without ``last`` the rows of the last term are handed back instead."""
    lang, term = batch.column("lang").combine_chunks(), batch.column("term").combine_chunks()
    n = len(term)
    new = np.ones(n, bool)
    if n > 1:
        same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1]))
        new[1:] = ~same.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    whole = n if last else starts[-1]
    rest, batch = batch.slice(whole), batch.slice(0, whole)
    starts = starts[starts < whole]
    docs = np.add.reduceat(batch.column("docs").to_numpy(), starts) if len(starts) else np.zeros(0, np.int64)
    kept = docs >= min_docs
    node = np.cumsum(new[:whole]) - 1
    groups = batch.column("groups").combine_chunks()
    sizes = groups.value_lengths().to_numpy()
    of = np.repeat(node, sizes)
    group, count = groups.flatten().to_numpy(), batch.column("counts").combine_chunks().flatten().to_numpy()
    some = kept[of]
    of, group, count = of[some], group[some].astype(np.int64), count[some]
    order = np.lexsort((group, of))
    of, group, count = of[order], group[order], count[order]
    first = np.ones(len(of), bool)
    first[1:] = (of[1:] != of[:-1]) | (group[1:] != group[:-1])
    at = np.flatnonzero(first)
    count = np.add.reduceat(count, at) if len(at) else count
    chosen = np.flatnonzero(kept)
    offsets = pa.array(np.searchsorted(of[at], np.append(chosen, len(kept))).astype(np.int32))
    rows = pa.array(starts[chosen])
    return (
        pa.RecordBatch.from_arrays(
            [
                lang.take(rows),
                term.take(rows),
                pa.array(docs[chosen]),
                pa.ListArray.from_arrays(offsets, pa.array(group[at].astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(count)),
            ],
            ["lang", "term", "docs", "groups", "counts"],
        ),
        rest,
    )


def frequencies(sorted_runs: DataFrame, min_docs: int = 3) -> DataFrame:
    """Each kept term's documents and its occurrences in each group, from runs dealt to shards."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if left is None else pa.concat_tables([left, rows])
            if rows.num_rows:
                done, left = _merged(rows, False, min_docs)
                yield done
        if left is not None and left.num_rows:
            yield _merged(left, True, min_docs)[0]

    shards = sorted_runs.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return shards.mapInArrow(merge, RUNS)


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(PARTS * count / total), exact for counts up to 9e15: three digits at a time."""
    out, rest = np.zeros_like(count), count
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Totals:
    """Occurrences of kept terms in each group, and number of kept terms and groups of its language."""

    def __init__(self, langs: list[str], occurrences: np.ndarray, vocabulary: dict[str, int]):
        names, self.lang = np.unique(np.array(langs, object), return_inverse=True)  # groups are in order of language
        self.vocabulary = np.array([vocabulary.get(n, 0) for n in names], np.int64)
        self.first = np.searchsorted(self.lang, np.arange(len(names) + 1))
        self.size = occurrences + self.vocabulary[self.lang]
        self.size_of_lang = np.add.reduceat(occurrences, self.first[:-1]) + self.vocabulary
        self.missing = share(np.ones_like(self.size), np.maximum(self.size, 1))


class _Sums:
    """Sums by pair of groups; leave when there are too many."""

    def __init__(self, groups: int):
        self.groups, self.keys, self.values, self.held = groups, [], [], 0

    def add(self, g: np.ndarray, q: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, back = np.unique(g * self.groups + q, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, back, value)
        self.keys.append(keys)
        self.values.append(total)
        self.held += len(keys)
        if self.held > AT_ONCE:
            keys, back = np.unique(np.concatenate(self.keys), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, back, np.concatenate(self.values))
            self.keys, self.values, self.held = [keys], [total], len(keys)
            if self.held > AT_ONCE // 2:
                yield from self.leave()

    def leave(self) -> Iterator[pa.RecordBatch]:
        if self.keys:
            keys, value = np.concatenate(self.keys), np.concatenate(self.values)
            g, q = np.divmod(keys, self.groups)
            yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), pa.array(q.astype(np.int32)), pa.array(value)], ["g", "q", "value"])
        self.keys, self.values, self.held = [], [], 0


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, group and count of every posting of a batch of frequencies."""
    groups = batch.column("groups")
    row = np.repeat(np.arange(batch.num_rows), groups.value_lengths().to_numpy())
    return row, groups.flatten().to_numpy().astype(np.int64), batch.column("counts").flatten().to_numpy()


def shared_terms(freqs: DataFrame, totals: Totals) -> DataFrame:
    """Corrections for terms that two groups both have, summed by pair within each task."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(len(totals.size))
        for batch in batches:
            row, group, count = _entries(batch)
            if not len(row):
                continue
            p, missing = share(count + 1, totals.size[group]), totals.missing[group]
            first = np.searchsorted(row, np.arange(batch.num_rows))
            width = np.bincount(row, minlength=batch.num_rows)
            ends = np.cumsum(width[row])
            start = 0
            while start < len(row):  # entries whose pairs fit at once
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + AT_ONCE)))
                own = np.arange(start, stop)
                a = np.repeat(own, width[row[own]])
                b = np.arange(len(a)) - np.repeat(np.cumsum(width[row[own]]) - width[row[own]], width[row[own]]) + first[row[a]]
                other = a != b
                a, b = a[other], b[other]
                value = distance(p[a], p[b]) - distance(p[a], missing[b]) - distance(missing[a], p[b]) + distance(missing[a], missing[b])
                yield from sums.add(group[a], group[b], value)
                start = stop
        yield from sums.leave()

    return freqs.select("groups", "counts").mapInArrow(stream, SUMS)


def lone_terms(histogram: DataFrame, totals: Totals) -> DataFrame:
    """What each group's own terms add, taken as missing from each other group of the language; both ways.

    ``histogram`` has ``g, count, terms``: how many terms occur so often in the group.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(len(totals.size))
        for batch in batches:
            group, count, times = batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            p = share(count + 1, totals.size[group])
            step = max(1, AT_ONCE // max(1, int(np.diff(totals.first).max())))
            for start in range(0, len(group), step):
                own = np.arange(start, min(start + step, len(group)))
                lang = totals.lang[group[own]]
                width = totals.first[lang + 1] - totals.first[lang]
                a = np.repeat(own, width)
                q = np.arange(len(a)) - np.repeat(np.cumsum(width) - width, width) + totals.first[totals.lang[group[a]]]
                other = q != group[a]
                a, q = a[other], q[other]
                g, m, mq = group[a], totals.missing[group[a]], totals.missing[q]
                yield from sums.add(g, q, times[a] * (distance(p[a], mq) - distance(m, mq)))
                yield from sums.add(q, g, times[a] * (distance(mq, p[a]) - distance(mq, m)))
        yield from sums.leave()

    return histogram.select("g", "count", "terms").mapInArrow(stream, SUMS)


def all_missing(groups: DataFrame, totals: Totals) -> DataFrame:
    """The distance of each two groups of a language if both lacked every term; 0 without kept terms."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in batch.column(0).to_pylist():
                lang = totals.lang[g]
                for start in range(totals.first[lang], totals.first[lang + 1], AT_ONCE):
                    q = np.arange(start, min(start + AT_ONCE, totals.first[lang + 1]))
                    q = q[q != g]
                    value = totals.vocabulary[lang] * distance(totals.missing[g], totals.missing[q])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(q), g, np.int32)), pa.array(q.astype(np.int32)), pa.array(value)], ["g", "q", "value"]
                    )

    return groups.select("g").mapInArrow(stream, SUMS)


def outstanding_terms(freqs: DataFrame, totals: Totals, top: int) -> DataFrame:
    """``g, term, value`` of terms more usual in the group than in its language: all of the ``top``, and some others.

    A task leaves out terms below the ``top`` values that it has already met in the group.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(len(totals.size), -1, np.int64)
        for batch in batches:
            row, group, count = _entries(batch)
            if not len(row):
                continue
            of_lang = np.zeros(batch.num_rows, np.int64)
            np.add.at(of_lang, row, count)
            lang = totals.lang[group]
            p, q = share(count + 1, totals.size[group]), share(of_lang[row] + 1, totals.size_of_lang[lang])
            value = distance(p, q)
            some = np.flatnonzero((p > q) & (value >= least[group]))
            some = some[np.lexsort((-value[some], group[some]))]
            rank = np.arange(len(some)) - np.searchsorted(group[some], group[some])
            last = some[rank == top - 1]
            least[group[last]] = np.maximum(least[group[last]], value[last])
            some = some[value[some] >= least[group[some]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[some].astype(np.int32)), batch.column("term").take(pa.array(row[some])), pa.array(value[some])], ["g", "term", "value"]
            )

    return freqs.select("term", "groups", "counts").mapInArrow(stream, "g int, term binary, value long")


def audit(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    min_docs: int = 3,
    top: int = 200,
    block: int = BLOCK,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of language and source.

    Part ``pair``: every other source of the language and its distance from the group, farthest first. Part
    ``term``: the group's terms that are more usual in it than in the language, the ``top`` by distance. Ties go to the
    item that comes first by UTF-8. Terms are runs of other characters than ASCII ones that are no letter,
    A-Z lower-cased; those in fewer than ``min_docs`` documents (rows: a repeated row is a document of its own) of
    the language do not count. Null text, language and source are read as ''. A group
    without terms has all its pairs; a language without kept terms has pairs of value 0; a group alone in its language
    has no pairs; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(read(lang_column).alias("lang"), read(source_column).alias("source"), F.col(text_column).cast("string").alias("text"))
    named = sorted(tuple(r) for r in rows.select("lang", "source").distinct().collect())
    if not named:
        return spark.createDataFrame([], "lang string, source string, part string, item string, value long, rank int")
    freqs = written(frequencies(runs(rows, {n: i for i, n in enumerate(named)}, block), min_docs), f"{folder}/frequencies")
    vocabulary = {r["lang"]: r["n"] for r in freqs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    postings = freqs.select(F.explode(F.arrays_zip("groups", "counts")).alias("x")).select(F.col("x.groups").alias("g"), F.col("x.counts").alias("count"))
    histogram = written(postings.groupBy("g", "count").agg(F.count(F.lit(1)).alias("terms")), f"{folder}/histogram")
    occurrences = np.zeros(len(named), np.int64)
    for r in histogram.groupBy("g").agg(F.sum(F.col("count") * F.col("terms")).alias("n")).collect():
        occurrences[r["g"]] = r["n"]
    totals = Totals([lang for lang, _ in named], occurrences, vocabulary)
    groups = spark.createDataFrame([(i, lang, source) for i, (lang, source) in enumerate(named)], "g int, lang string, source string")

    # without kept terms all three parts are 0 or empty
    sums = shared_terms(freqs, totals).unionByName(lone_terms(histogram, totals)).unionByName(all_missing(groups, totals))
    others = groups.select(F.col("g").alias("q"), F.col("source").alias("item"))
    pairs = sums.groupBy("g", "q").agg(F.sum("value").alias("value")).join(others, "q").select("g", F.lit("pair").alias("part"), "item", "value")
    found = outstanding_terms(freqs, totals, top).select("g", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    order = Window.partitionBy("g").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    both = ranked(pairs).unionByName(ranked(found).where(F.col("rank") <= top))
    return both.join(groups, "g").select("lang", "source", "part", "item", "value", "rank")


#: The audit of table documents, in DuckDB SQL.
AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
grouped AS (SELECT DISTINCT lang, source FROM d),
found AS (SELECT id, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM grouped LEFT JOIN counted USING (lang, source) GROUP BY ALL),
shares AS MATERIALIZED (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
  1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (s.total + v.v) AS p
  FROM size s JOIN kept k USING (lang) JOIN vocabulary v USING (lang) LEFT JOIN counted c ON (c.lang, c.source, c.term) = (s.lang, s.source, k.term)),
of_lang AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (m + 1) // (sum(m) OVER (PARTITION BY lang) + v) AS p
  FROM (SELECT lang, term, CAST(sum(n) AS BIGINT) AS m FROM counted GROUP BY ALL) JOIN vocabulary USING (lang)),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON (x.lang, x.source) = (a.lang, a.source)
  LEFT JOIN shares y ON (y.lang, y.source, y.term) = (b.lang, b.source, x.term) GROUP BY ALL),
term AS (SELECT s.lang, s.source, 'term' AS part, s.term AS item, (s.p - l.p) * (s.p - l.p) // l.p AS value
  FROM shares s JOIN of_lang l USING (lang, term) WHERE s.n > 0 AND s.p > l.p),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
