"""Exact top-k by inner product of whole numbers, with multi-resolution segment statistics.

A segment of w components with mean m and deviation s (root of the mean squared distance from m)
bounds distances from below: the squared distance of two segments is at least
``w * ((m1 - m2)^2 + (s1 - s2)^2)``. With |q - x|^2 = |q|^2 + |x|^2 - 2 q.x, adding up over segments bounds
the product from above by ``sum of w * (m1 * m2 + s1 * s2)``. Few long segments bound loosely and cost
little, more and shorter ones bound closer. So each query goes from coarse to fine, keeps at every step
only rows whose bound reaches its k-th best exact score so far, and computes exact scores of the survivors.

Bounds are close where segments are nearly constant or short. So vectors are first turned to the principal axes of a
bounded sample, which leaves products as they are and puts most of them into the first components; these are segments of
their own, and segments further on are ever longer. The axes change the work, never a result: exact scores
are of the original whole numbers.

The rows are dealt to blocks by a hash of their id and the query set meets every block, a task for each block
of rows and block of queries; each gives a query's k best there, and those of all blocks are ranked once more. Of equal vectors only the k + 1
smallest ids are kept, since ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.ann_forest import matrix, usable

#: How many first components are segments of their own, coarse to fine. Later segments double in length.
RESOLUTIONS = (1, 4, 16)

#: From this share of pairs left on, one matrix product is cheaper than picking pairs (about ten times a pair).
DENSE = 0.1

#: Pairs multiplied at a time where they are picked.
PAIRS_AT_ONCE = 1 << 16


def segment_ends(dimensions: int, single: int) -> list[int]:
    """0, 1, ... single, 2 * single, 4 * single, ... dimensions; those of a finer resolution hold the coarser ones'."""
    ends = list(range(min(single, dimensions) + 1))
    while ends[-1] < dimensions:
        ends.append(min(2 * ends[-1], dimensions))
    return ends


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Directions of the sample's vectors as columns, those that hold most of their length first."""
    distinct = np.unique(sample, axis=0)
    scaled = distinct / max(np.abs(distinct).max(), 1e-300)
    return np.linalg.eigh(scaled.T @ scaled)[1][:, ::-1]


def statistics(rows: np.ndarray, single: int) -> np.ndarray:
    """Means and deviations of each row's segments, scaled so that their products bound scores."""
    ends = segment_ends(rows.shape[1], single)
    parts = [rows[:, a:b] for a, b in zip(ends, ends[1:])]
    means = [p.mean(1) * np.sqrt(p.shape[1]) for p in parts]
    deviations = [p.std(1) * np.sqrt(p.shape[1]) for p in parts if p.shape[1] > 1]
    return np.stack(means + deviations, axis=1)


def _floor(bounds: np.ndarray, queries: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The k-th best exact score among each query's rows of the highest bounds."""
    n = min(4 * k, bounds.shape[1])
    some = np.argpartition(-bounds, n - 1, axis=1)[:, :n]
    scores = np.einsum("qd,qnd->qn", queries, rows[some])
    scores[np.isneginf(np.take_along_axis(bounds, some, axis=1))] = -np.inf
    return np.partition(scores, -k, axis=1)[:, -k] if n >= k else np.full(len(queries), -np.inf)


class Block:
    """Rows of one block with what bounds their products: statistics on the axes at each resolution."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, axes: np.ndarray):
        self.ids, self.rows, self.axes = ids, rows, axes
        self.of_rows = [statistics(rows @ axes, single) for single in RESOLUTIONS]
        self.length = np.linalg.norm(rows, axis=1)
        self.bounded, self.multiplied = 0, 0  # pairs looked at, and those of them that got an exact product

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every query's k best rows other than itself: query ids, row ids, scores.

        ``rows`` and ``queries`` are whole numbers, exact in float64 (products stay below 2^53). Bounds get a slack
        for rounding, and a row whose bound ties with the k-th best stays, so that ids decide. A resolution looks
        at the rows that the one before left to any query of the call.
        """
        left = np.arange(len(self.ids))
        alive = query_ids[:, None] != self.ids[None, :]
        floor = np.full(len(queries), -np.inf)
        turned, length = queries @ self.axes, np.linalg.norm(queries, axis=1)
        self.bounded += alive.size
        for single, own in zip(RESOLUTIONS, self.of_rows):
            bounds = statistics(turned, single) @ own[left].T
            bounds = np.where(alive, bounds + 1e-6 + 1e-9 * length[:, None] * self.length[left], -np.inf)
            floor = np.maximum(floor, _floor(bounds, queries, self.rows[left], k))
            self.multiplied += len(queries) * min(4 * k, len(left))
            alive = alive & (bounds >= floor[:, None])
            some = alive.any(0)
            left, alive = left[some], alive[:, some]
        q, r = np.nonzero(alive)
        score = self._products(queries, left, q, r, alive.size)
        # by query, best first, ties to the smaller id
        found = self.ids[left[r]]
        near = score >= floor[q]
        q, found, score = q[near], found[near], score[near]
        order = np.lexsort((found, -score, q))
        rank = np.arange(len(order)) - np.searchsorted(q[order], q[order])
        order = order[rank < k]
        return query_ids[q[order]], found[order], score[order]

    def _products(self, queries: np.ndarray, left: np.ndarray, q: np.ndarray, r: np.ndarray, pairs: int) -> np.ndarray:
        if len(q) > DENSE * pairs:
            self.multiplied += pairs
            return (queries @ self.rows[left].T)[q, r]
        self.multiplied += len(q)
        score = np.empty(len(q))
        for a in range(0, len(q), PAIRS_AT_ONCE):
            b = a + PAIRS_AT_ONCE
            score[a:b] = np.einsum("nd,nd->n", queries[q[a:b]], self.rows[left[r[a:b]]])
        return score


def quantised(table: DataFrame, id_column: str, vector_column: str, factor: float) -> DataFrame:
    """``id, v``: rows that take part, components as floor(factor * x); of repeated ids the smallest vector."""
    v = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    # beyond this a sum of products might not be exact in float64
    most = F.sqrt(F.lit(2.0**53) / F.size("v"))
    fits = F.forall("v", lambda x: F.abs(F.floor(x.cast("double") * factor).cast("double")) <= most)
    error = F.raise_error(F.lit(f"{vector_column}: a component times {factor} is too large for exact products")).cast("array<bigint>")
    whole = F.transform("v", lambda x: F.floor(x * factor).cast("long"))
    return rows.select("id", F.when(fits, whole).otherwise(error).alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def top_k(
    table: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 20,
    factor: float = 64,
    block_rows: int = 8192,
    query_rows: int = 1024,
    sample_rows: int = 1024,
) -> DataFrame:
    """Each query's k rows of the largest inner product, other than itself: ``query_id, rank, vec_id, score``.

    Components become ``floor(factor * x)`` first. ``queries`` are rows of ``table``. A task holds about
    ``block_rows`` rows and ``query_rows`` queries. The axes are fitted on at most ``sample_rows`` rows, those whose
    ids hash lowest, and every task gets them: the square of a vector's length in doubles. Null or empty vectors, those with null or non-finite
    components and rows without an id take no part; zero vectors do. Rows that repeat an id count
    once, with their smallest vector. Vectors of unequal length, and components so large that a sum of products
    may pass 2^53, raise an error. Ties go to the smaller id; with fewer than k candidates all are
    returned; empty tables give no rows; other columns are ignored.
    """
    rows = quantised(table, id_column, vector_column, factor)
    asked = quantised(queries, id_column, vector_column, factor)
    copies = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("id", "v")
    length = F.when(usable(F.col(vector_column).cast("array<double>")), F.size(vector_column))
    sizes = table.agg(F.count(F.lit(1)).alias("rows"), F.min(length).alias("least"), F.max(length).alias("most")).first()
    if sizes["least"] != sizes["most"]:
        raise ValueError(f"{vector_column}: vectors of {sizes['least']} to {sizes['most']} components")
    n, m = sizes["rows"], queries.count()
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))
    values = F.col(vector_column).cast("array<double>")
    drawn = table.where(F.col(id_column).isNotNull() & usable(values)).select(values.alias("v"), F.xxhash64(id_column).alias("h"))
    sample = drawn.orderBy("h", "v").limit(sample_rows).select("v").toArrow().column("v").combine_chunks()
    turn = table.sparkSession.sparkContext.broadcast(principal_axes(matrix(sample)) if len(sample) else None)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        all_rows = pa.Table.from_batches(read).combine_chunks()
        cells = all_rows.column("cell").to_numpy()
        is_query = all_rows.column("asked").to_numpy(zero_copy_only=False)
        ids, values = all_rows.column("id").to_numpy(), matrix(all_rows.column("v").combine_chunks()).astype(np.float64)
        for cell in np.unique(cells):
            here, wanted = np.flatnonzero((cells == cell) & ~is_query), np.flatnonzero((cells == cell) & is_query)
            if not len(here) or not len(wanted):
                continue
            block_here = Block(ids[here], values[here], turn.value)
            for start in range(0, len(wanted), 64):
                some = wanted[start : start + 64]
                q, found, score = block_here.best(ids[some], values[some], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array(found, pa.int64()), pa.array(score.astype(np.int64))], ["query_id", "vec_id", "score"]
                )

    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts))
    filed = kept.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"), block.alias("b"), "id", "v", F.lit(False).alias("asked"))
    sent = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), part.alias("p"), "id", "v", F.lit(True).alias("asked"))
    cells = filed.unionByName(sent).withColumn("cell", (F.col("b") * parts + F.col("p")).cast("int")).drop("b", "p")
    found = cells.repartitionById(blocks * parts, "cell").mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The search of every twentieth row of table embeddings by all others, in DuckDB SQL.
TOP_K_SQL = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
