"""SimHash near-duplicates by the generalised pigeonhole principle.

If two fingerprints differ in at most ``t`` bits and the bits are dealt to ``m`` partitions with
thresholds that add up to ``t - m + 1``, they differ in some partition by no more than its threshold
(-1: the partition is not looked at). So every fingerprint is filed once under each partition's bits
and probes, in each partition, the values within its threshold there.

* Bits that go together are put in one partition, by their correlation over all fingerprints, so
  that a common pattern makes few partitions unselective instead of all.
* Each fingerprint chooses its own thresholds: dynamic programming finds those of the least
  estimated number of probes and candidates. The estimate comes from counts of the values of
  each group of at most eight bits, over all fingerprints, taken as independent of each other.
* Candidates are verified on all 64 bits within the join.

Equal fingerprints are one node throughout. Only the 64 x 64 bit sums and at most 2048 value counts
reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, written
from tidemark.llm.components import components

#: Bits whose joint counts are held for the estimate of candidates.
GROUP = 8
#: What one probe costs, measured in candidates to verify.
PROBE_COST = 2.0


def shingles(text: str | None, length: int) -> list[bytes]:
    """Runs of ``length`` words, repeats included; all words if there are fewer; none without words.

    Only A-Z are lower-cased, and words end at ASCII white space.
    """
    words = (text or "").encode().lower().split()
    if len(words) <= length:
        return [b" ".join(words)] if words else []
    return [b" ".join(run) for run in zip(*(words[i:] for i in range(length)))]


def fingerprint(text: str | None, length: int = 3) -> int:
    """64 bits: each is 1 if set in over half of the shingles' XXH64 (seed 42). 0 without words."""
    import xxhash

    runs = shingles(text, length)
    if not runs:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(r, 42) for r in runs], np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 3, kept: str | None = None) -> DataFrame:
    """``doc_id, fp`` for every row; fp holds the 64 bits as a signed long. A column of longs can be ``kept`` beside them."""
    beside = [kept] if kept else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, length) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], ["doc_id", "fp", *beside])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), *beside)
    return rows.mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} long" for c in beside))


def _bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_sums(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have bits i and j both set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            bits = _bit_matrix(batch.column(0).to_numpy()).astype(np.float32)
            n += len(bits)
            total += np.rint(bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, 4096), pa.int32()), pa.array([n, *total.ravel().tolist()])], ["cell", "n"])

    rows = fps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = {r["cell"]: r["n"] for r in rows}
    return cells.get(-1, 0), np.array([cells.get(i, 0) for i in range(4096)], float).reshape(64, 64)


def partitions_for(rows: int, distance: int) -> int:
    """The number of partitions that costs least for so many fingerprints, thresholds spread evenly."""

    def cost(m: int) -> float:
        spare, total = distance - m + 1, 0.0
        for i in range(m):
            width = 64 // m + (i < 64 % m)
            radius = spare // m + (i < spare % m)
            ball = sum(comb(width, k) for k in range(radius + 1))
            total += ball * (PROBE_COST + rows / 2.0**width)
        return total

    return min(range(1, distance + 2), key=cost)


def correlated_partitions(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """Deals the 64 bits to m partitions: each starts with the bit most bound to those left and
    takes, one by one, the bit most correlated with the bits it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    bound = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(bound, 0)
    left, parts = list(range(64)), []
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        part = [max(left, key=lambda b: bound[b, left].sum())]
        left.remove(part[0])
        while len(part) < width:
            part.append(max(left, key=lambda b: bound[b, part].sum()))
            left.remove(part[-1])
        parts.append(sorted(part))
    return parts


def _groups(parts: list[list[int]]) -> list[list[list[int]]]:
    """Each partition's bits in groups of at most GROUP."""
    return [[part[i : i + GROUP] for i in range(0, len(part), GROUP)] for part in parts]


def _gather(bits: np.ndarray, chosen: list[int]) -> np.ndarray:
    """The chosen bits as one number for each row, the first bit lowest."""
    out = np.zeros(len(bits), np.int64)
    for i, b in enumerate(chosen):
        out |= bits[:, b].astype(np.int64) << i
    return out


def group_counts(fps: DataFrame, parts: list[list[int]]) -> list[list[np.ndarray]]:
    """How often each value of each group of bits occurs: at most 2^GROUP counts for each of them."""
    groups = _groups(parts)
    flat = [g for part in groups for g in part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(flat), 1 << GROUP), np.int64)
        for batch in batches:
            bits = _bit_matrix(batch.column(0).to_numpy())
            for i, group in enumerate(flat):
                counts[i] += np.bincount(_gather(bits, group), minlength=1 << GROUP)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(counts.ravel()[cells])], ["cell", "n"])

    counts = np.zeros(len(flat) << GROUP)
    for r in fps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    rows = iter(counts.reshape(len(flat), -1))
    return [[next(rows) for _ in part] for part in groups]


def _within(counts: np.ndarray, width: int, distance: int) -> np.ndarray:
    """For each value of a group: the share of rows at each distance from it up to ``distance``."""
    values = np.arange(1 << width)
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    share = counts[: 1 << width] / max(counts.sum(), 1)
    return np.stack([(share[None, :] * (apart == d)).sum(1) for d in range(distance + 1)], axis=1)


def allocate(bits: np.ndarray, parts: list[list[int]], tables: list[list[np.ndarray]], n: int, distance: int) -> np.ndarray:
    """Thresholds (-1 or more) of each row in each partition, of the least estimated cost.

    Dynamic programming over the partitions, for all rows at once: ``best[:, s]`` is the least cost
    of the partitions so far with ``s`` of the ``distance + 1`` units used, a threshold of r using r + 1.
    """
    rows, units = len(bits), distance + 1
    best = np.full((rows, units + 1), np.inf)
    best[:, 0] = 0
    choices = []
    for part, groups, own in zip(parts, _groups(parts), tables):
        near = np.zeros((rows, units))
        near[:, 0] = 1
        for group, table in zip(groups, own):  # distances in groups add up: a convolution
            each = table[_gather(bits, group)]
            near = np.stack([(near[:, : d + 1] * each[:, d::-1]).sum(1) for d in range(units)], axis=1)
        cost = np.zeros((rows, units + 1))
        balls = np.cumsum([comb(len(part), d) for d in range(units)])
        cost[:, 1:] = np.cumsum(near, axis=1) * n + PROBE_COST * balls
        options = np.stack(
            [np.where(np.arange(units + 1) >= r, np.roll(best, r, axis=1), np.inf) + cost[:, [r]] for r in range(units + 1)], axis=2
        )
        choices.append(options.argmin(2))
        best = options.min(2)
    left = np.full(rows, units)
    out = np.zeros((rows, len(parts)), np.int64)
    for i in range(len(parts) - 1, -1, -1):
        used = choices[i][np.arange(rows), left]
        out[:, i] = used - 1
        left = left - used
    return out


def _balls(widths: list[int], distance: int) -> list[list[np.ndarray]]:
    """For each partition and radius: the masks of exactly so many bits."""
    from itertools import combinations

    return [[np.array([sum(1 << b for b in c) for c in combinations(range(w), d)], np.int64) for d in range(distance + 1)] for w in widths]


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """All pairs ``u < v`` of distinct fingerprints that differ in 1 to ``distance`` bits.

    ``fps`` holds distinct fingerprints in column ``fp``. Where many fingerprints share a partition's
    value, Spark splits that key's part of the join; the pairs that leave it are verified links.
    """
    n, both = bit_sums(fps)
    parts = correlated_partitions(n, both, partitions_for(n, distance))
    tables = [
        [_within(c, len(g), distance) for g, c in zip(groups, counts)] for groups, counts in zip(_groups(parts), group_counts(fps, parts))
    ]
    masks = _balls([len(p) for p in parts], distance)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            bits = _bit_matrix(fp)
            for i, part in enumerate(parts):
                yield _keyed(np.full(len(fp), i, np.int32), _gather(bits, part), fp)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            bits = _bit_matrix(fp)
            thresholds = allocate(bits, parts, tables, n, distance)
            for i, part in enumerate(parts):
                value = _gather(bits, part)
                for d in range(distance + 1):
                    rows = np.flatnonzero(thresholds[:, i] >= d)
                    step = max(1, 200_000 // max(len(masks[i][d]), 1))
                    for start in range(0, len(rows), step):
                        some = rows[start : start + step]
                        keys = (value[some][:, None] ^ masks[i][d][None, :]).ravel()
                        yield _keyed(np.full(len(keys), i, np.int32), keys, np.repeat(fp[some], len(masks[i][d])))

    schema = "part int, value long, fp long"
    filed = fps.select("fp").mapInArrow(file, schema).withColumnRenamed("fp", "other")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance
    found = fps.select("fp").mapInArrow(probe, schema).join(filed, ["part", "value"]).where(near & (F.col("fp") != F.col("other")))
    return found.select(F.least("fp", "other").alias("u"), F.greatest("fp", "other").alias("v")).distinct()


def _keyed(part: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part), pa.array(value), pa.array(fp)], ["part", "value", "fp"])


def hex_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 3, distance: int = 3) -> DataFrame:
    """Each document's fingerprint and the smallest document id reachable over near fingerprints.

    Returns ``doc_id, fingerprint, component_id``, one row for each input row. Null, empty and blank
    texts have fingerprint zero and are linked like any other. A null id stays and cannot be the
    smallest; a component of null ids alone has a null id. An empty table gives no rows. Other
    columns are ignored.
    """
    folder = scratch(docs.sparkSession)
    rows = written(fingerprints(docs, id_column, text_column, length), f"{folder}/fingerprints")
    labels = groups(rows, folder, distance).select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", hex_text(F.col("fp")).alias("fingerprint"), "component_id")


def groups(rows: DataFrame, folder: str, distance: int = 3) -> DataFrame:
    """``fp, root, component_id`` for each fingerprint of ``doc_id, fp``: those of one root are one group."""
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), f"{folder}/nodes")
    roots = components(links(nodes, distance), folder).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = rooted.join(roots.select("root").distinct(), "root", "left_semi")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component"))
    return rooted.join(smallest, "root", "left").select("fp", "root", F.coalesce("component", "first").alias("component_id"))
