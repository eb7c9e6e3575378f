"""Approximate nearest neighbours by cosine: a hash-prefix forest.

A tree gives each vector a long string of bits, the sides of random planes it lies on, and keeps
them as a sorted array. A query descends to the rows that share the longest prefix with its own
string; the range of rows that share a prefix of any length is found by binary search. All trees
then ascend together, one bit at a time, until the rows met in any tree number enough. Those are scored
with their exact cosines.

The rows are dealt to blocks by a hash of their id, each block grows the forest over its own rows,
and the query set meets every block; a query's nearest of all blocks are its nearest. So no bucket
is shuffled, a hot region of space is spread over all blocks, and the rows a task holds are bounded.
Equal vectors give equal strings and equal scores, so of each only the ``k + 1`` smallest ids are
indexed: no other can be among the k nearest, since ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT = "query_id long, rank int, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, v``: the rows that take part, as doubles; of rows that repeat an id, the smallest vector."""
    v = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("id"), v.alias("v"))
    return rows.where(F.col("id").isNotNull() & usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def planes(dimensions: int, trees: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimensions, trees * bits))


def strings(rows: np.ndarray, normal: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Each row's bit string in each tree, as a number whose highest bit comes first."""
    out = np.zeros((len(rows), trees), np.uint64)
    sides = (rows @ normal > 0).reshape(len(rows), trees, bits)
    for i in range(bits):
        out = out << np.uint64(1) | sides[:, :, i].astype(np.uint64)
    return out


class Forest:
    """Sorted bit strings of one block's rows in every tree."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, normal: np.ndarray, trees: int, bits: int):
        self.ids, self.trees, self.bits, self.normal = ids, trees, bits, normal
        self.rows = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        found = strings(self.rows, normal, trees, bits)
        self.order = np.argsort(found, axis=0, kind="stable")
        self.sorted = np.take_along_axis(found, self.order, axis=0)

    def ranges(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query, length of prefix (0 to bits) and tree: the sorted rows that share it."""
        low = np.zeros((len(own), self.bits + 1, self.trees), np.int64)
        high = np.full_like(low, len(self.ids))
        for length in range(1, self.bits + 1):
            rest = np.uint64(self.bits - length)
            first = own >> rest << rest
            last = first | ((np.uint64(1) << rest) - np.uint64(1))
            for t in range(self.trees):
                low[:, length, t] = np.searchsorted(self.sorted[:, t], first[:, t], "left")
                high[:, length, t] = np.searchsorted(self.sorted[:, t], last[:, t], "right")
        return low, high

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, candidates: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Each query's k best of the block: their ids and cosines."""
        units = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        low, high = self.ranges(strings(units, self.normal, self.trees, self.bits))
        met = (high - low).sum(2)  # by length of prefix, with repeats
        out = []
        for i, (own, unit) in enumerate(zip(query_ids, units)):
            length = self.bits
            while True:  # ascend together until enough different rows are met
                while length and met[i, length] < candidates:
                    length -= 1
                rows = np.unique(np.concatenate([self.order[a:b, t] for t, (a, b) in enumerate(zip(low[i, length], high[i, length]))]))
                if not length or len(rows) >= candidates:
                    break
                length -= 1
            rows = rows[self.ids[rows] != own]
            cosines = self.rows[rows] @ unit
            if len(rows) > k:  # all that tie with the k-th stay, so that ids decide
                rows = rows[near := cosines >= np.partition(cosines, -k)[-k] - 1e-9]
                cosines = cosines[near]
            out.append((int(own), self.ids[rows], cosines))
        return out


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows with one vector, in double precision on the original values."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum()))


def nearest(
    table: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 5,
    trees: int = 48,
    bits: int = 24,
    share: float = 0.45,
    block_rows: int = 16384,
    query_rows: int = 2048,
    seed: int = 7,
) -> DataFrame:
    """Each query's k nearest rows found, other than itself: ``query_id, rank, vec_id, score``.

    ``queries`` are rows of ``table``. A query meets at least ``share`` of each block's rows. A task
    holds about ``block_rows`` rows and ``query_rows`` queries. Vectors that are null, empty, zero or
    hold null or non-finite components take no part, nor do rows without an id. Rows that repeat an id
    count once, with their smallest vector. All vectors need one length. Ties go to the smaller id; with fewer than k
    candidates all are returned; empty tables give no rows; other columns are ignored.
    """
    nonzero = F.exists("v", lambda x: x != 0)
    rows = vectors(table, id_column, vector_column).where(nonzero)
    asked = vectors(queries, id_column, vector_column).where(nonzero)
    copies = Window.partitionBy("v").orderBy("id")
    indexed = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("id", "v")
    n, m = table.count(), queries.count()
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        all_rows = pa.Table.from_batches(read).combine_chunks()
        cells = all_rows.column("cell").to_numpy()
        is_query = all_rows.column("asked").to_numpy(zero_copy_only=False)
        ids, values = all_rows.column("id").to_numpy(), matrix(all_rows.column("v").combine_chunks())
        normal = planes(values.shape[1], trees, bits, seed)
        for cell in np.unique(cells):
            here, wanted = np.flatnonzero((cells == cell) & ~is_query), np.flatnonzero((cells == cell) & is_query)
            if not len(here) or not len(wanted):
                continue
            forest = Forest(ids[here], values[here], normal, trees, bits)
            at = {int(i): r for i, r in zip(ids[here], here)}
            for start in range(0, len(wanted), 256):
                some = wanted[start : start + 256]
                out: list[tuple] = []
                for q, (own, found, _) in zip(some, forest.search(ids[some], values[some], k, max(8 * k, int(share * len(here))))):
                    exact = cosine(values[[at[int(i)] for i in found]], values[q])
                    best = np.lexsort((found, -exact))[:k]
                    out += [(own, int(found[j]), float(exact[j])) for j in best]
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["query_id", "vec_id", "score"])

    # cell = (block of rows, block of queries); each row goes to its block's cells, each query to its own
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts))
    filed = indexed.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"), block.alias("b"), "id", "v", F.lit(False).alias("asked"))
    sent = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), part.alias("p"), "id", "v", F.lit(True).alias("asked"))
    cells = filed.unionByName(sent).withColumn("cell", (F.col("b") * parts + F.col("p")).cast("int")).drop("b", "p")
    found = cells.repartitionById(blocks * parts, "cell").mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
