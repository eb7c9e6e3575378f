"""Vector codes by product quantisation in whole numbers, assigned over a trie of distinct parts.

Vectors are cut into equal consecutive parts, each with a codebook of its own. Many vectors share parts
and, in sorted order, the first dimensions of parts: the distinct parts of a position, sorted, are a
trie whose levels are dimensions. A depth-first walk meets them in just that order. Each node adds its
dimension's squared differences to the distances, to all entries at once, that its parent holds, so a
common prefix is added up once for all parts below it; a leaf takes the nearest entry and weighs it by
how often the part occurs.

The distinct parts are counted once and written in that order, in ranges of equal size, so that a vector
or a part that very many rows hold is one row. A round reads them, and only sums and counts of each entry
(position x entries x dimensions) reach the driver, which sends the next codebooks of that same size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, written

#: Components are refused beyond this size: squared distances and their sums have to fit 64 bits.
LARGEST = 1 << 28
#: Parts of one walk: its deepest level holds that many rows of distances.
WALK = 16_384
_SHIFT = 1 << 31

CODES = "vec_id long, label string, code string, error long"


def walk(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each part; ``parts`` are sorted, ties go to the lower entry.

    Level by level in the order of the walk: ``node`` says which prefix of the level each part hangs on.
    """
    first = np.ones(len(parts), bool)  # whether a part begins a new prefix at this level
    first[1:] = False
    apart = np.zeros((1, len(book)), np.int64)
    node = np.zeros(len(parts), np.int64)
    for level in range(parts.shape[1]):
        values = parts[:, level]
        first[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(first)
        apart = apart[node[starts]] + (values[starts, None] - book[None, :, level]) ** 2
        node = np.cumsum(first) - 1
    best = apart.argmin(1)
    return best[node], apart[np.arange(len(apart)), best][node]


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    """A list column as rows of whole numbers, all of this length."""
    if (column.value_lengths().to_numpy() != length).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy().reshape(len(column), length)


def _packed(parts: np.ndarray) -> np.ndarray:
    """Rows as bytes whose order is that of the rows."""
    raw = np.ascontiguousarray((parts + _SHIFT).astype(">u4"))
    return raw.view(f"S{4 * parts.shape[1]}").ravel()


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, width)
    return raw.astype(np.int64) - _SHIFT


def whole_vectors(table: DataFrame, id_column: str, vector_column: str, label_column: str | None, factor: int, parts: int) -> DataFrame:
    """``vec_id, label, v``: rows that take part, components as floor(factor * x)."""
    v = F.col(vector_column).cast("array<double>")
    label = F.col(label_column).cast("string") if label_column else F.lit(None).cast("string")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), label.alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.where((F.size("v") > 0) & finite)
    fits = (F.size("v") % parts == 0) & F.forall("v", lambda x: F.abs(x * factor) <= LARGEST)
    whole = F.transform("v", lambda x: F.floor(x * factor).cast("long"))
    message = f"vectors need a length that {parts} divides and components of at most {LARGEST} after the factor"
    return kept.select("vec_id", "label", F.when(fits, whole).otherwise(F.raise_error(F.lit(message)).cast("array<bigint>")).alias("v"))


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The parts of the smallest ids' vectors, one entry each; of an id's rows the smallest vector. None without rows."""
    ids = rows.where("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(entries)  # so few: broadcast
    low = rows.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").collect()
    if not low:  # ids are null throughout: the smallest vectors stand in
        low = rows.select("v").distinct().orderBy("v").limit(entries).collect()
    if not low:
        return None
    if len({len(r["v"]) for r in low}) > 1:
        raise ValueError("vectors differ in length")
    return np.array([r["v"] for r in low], np.int64).reshape(len(low), parts, -1).transpose(1, 0, 2).copy()


def distinct_parts(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """``position, part, weight``: how many vectors hold each part; counted within tasks first."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column(0), parts * width).reshape(-1, parts, width)
            for p in range(parts):
                values, counts = np.unique(_packed(vectors[:, p]), return_counts=True)
                # numpy drops zero bytes at the end of such strings
                filled = [v.ljust(4 * width, b"\0") for v in values.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), p, np.int32)), pa.array(filled, pa.binary()), pa.array(counts.astype(np.int64))],
                    ["position", "part", "weight"],
                )

    found = rows.select("v").mapInArrow(cut, "position int, part binary, weight long")
    return found.groupBy("position", "part").agg(F.sum("weight").alias("weight"))


def _round(tree: DataFrame, books: np.ndarray) -> np.ndarray:
    """Counts and component sums of the parts nearest to each entry: position x entry x (1 + width)."""
    positions, entries, width = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((positions, entries, 1 + width), np.int64)
        for batch in batches:
            at, weight = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            rows = _unpacked(batch.column(1), width)
            for p in np.unique(at):
                here = np.flatnonzero(at == p)
                for start in range(0, len(here), WALK):
                    some = here[start : start + WALK]
                    best, _ = walk(rows[some], books[p])
                    np.add.at(total[p, :, 0], best, weight[some])
                    np.add.at(total[p, :, 1:], best, rows[some] * weight[some, None])
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total.ravel()[cells])], ["cell", "n"])

    sums = np.zeros(positions * entries * (1 + width), np.int64)
    for r in tree.mapInArrow(add_up, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        sums[r["cell"]] = r["n"]
    return sums.reshape(positions, entries, 1 + width)


def train(rows: DataFrame, folder: str, parts: int = 8, entries: int = 16, rounds: int = 6) -> np.ndarray | None:
    """Codebooks after so many rounds: position x entry x width, whole numbers. None without rows."""
    books = first_books(rows, parts, entries)
    if books is None:
        return None
    counted = written(distinct_parts(rows, parts, books.shape[2]), f"{folder}/parts")
    # sorted ranges: neighbours in the trie are neighbours in a task
    tree = written(counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), f"{folder}/trie")
    for _ in range(rounds):
        sums = _round(tree, books)
        used = sums[:, :, 0] > 0
        books[used] = sums[:, :, 1:][used] // sums[:, :, :1][used]
    return books


def codes(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every row: a walk over the distinct parts of each batch."""
    positions, entries, width = books.shape
    digits = [f"{e:02x}" for e in range(entries)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column(2), positions * width).reshape(-1, positions, width)
            error = np.zeros(len(vectors), np.int64)
            chosen = np.zeros((len(vectors), positions), np.int64)
            for start in range(0, len(vectors), WALK):
                some = slice(start, start + WALK)
                for p in range(positions):
                    _, first, back = np.unique(_packed(vectors[some, p]), return_index=True, return_inverse=True)
                    best, apart = walk(vectors[some, p][first], books[p])
                    chosen[some, p] = best[back]
                    error[some] += apart[back]
            shown = ["".join([digits[e] for e in row]) for row in chosen.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shown), pa.array(error)], ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "v").mapInArrow(assign, CODES)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    table: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str | None = "label",
    factor: int = 4096,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
) -> DataFrame:
    """Each vector's code: ``vec_id, code, error, label_error, codebooks_sha256``.

    One row for each row that takes part: vectors that are null, empty or hold null or non-finite components
    do not. ``code`` has two hex digits for each part, ``error`` is the squared distance to the entries, and
    ``label_error`` its sum over rows of the same label, null labels together. Codebooks begin with the
    parts of the ``entries`` smallest ids (fewer rows: fewer entries); rows without an id are coded but
    begin no entry, unless no row has one. Of rows that repeat an id each is coded, and the smallest vector begins an
    entry. Ties go to the lower entry; an unused entry stays. Vectors of unequal length, of a length ``parts`` does not
    divide, or with components beyond ``LARGEST`` after the factor raise an error. An
    empty table gives no rows; other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    folder = scratch(table.sparkSession)
    rows = whole_vectors(table, id_column, vector_column, label_column, factor, parts)
    books = train(rows, folder, parts, entries, rounds)
    if books is None:
        return table.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = written(codes(rows, books), f"{folder}/codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _sql(factor: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same in DuckDB SQL, a few steps for each round."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
  len(embedding) // {parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * w + 1 : p * w + w] AS part FROM kept, range({parts}) r(p))""",
        f"""b0 AS MATERIALIZED (SELECT p, e, part AS entry FROM (SELECT p, part, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e
  FROM parts) WHERE e < {entries})""",
    ]

    def nearest(i: int) -> str:
        apart = "list_sum(list_transform(range(1, len(part) + 1), lambda j: (part[j] - entry[j]) * (part[j] - entry[j])))"
        return f"""a{i} AS MATERIALIZED (SELECT vec_id, label, p, part, m // {entries} AS d, m % {entries} AS e FROM
  (SELECT vec_id, label, p, part, min(CAST({apart} AS BIGINT) * {entries} + e) AS m FROM parts JOIN b{i} USING (p) GROUP BY ALL))"""

    for i in range(rounds):
        steps.append(nearest(i))
        steps.append(
            f"""m{i} AS MATERIALIZED (SELECT p, e, list(CAST(q AS BIGINT) ORDER BY j) AS entry FROM (SELECT p, e, j,
  (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS q
  FROM (SELECT p, e, unnest(part) AS y, generate_subscripts(part, 1) AS j FROM a{i}) GROUP BY p, e, j) GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.entry, b.entry) AS entry FROM b{i} b LEFT JOIN m{i} m USING (p, e))"""
        )
    steps.append(nearest(rounds))
    steps.append(
        f"""coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label),
digest AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})"""
    )
    return (
        "WITH "
        + ",\n".join(steps)
        + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"
    )


#: The codes of table embeddings, in DuckDB SQL; its ids are taken to be unique.
COMPRESS_SQL = _sql()
