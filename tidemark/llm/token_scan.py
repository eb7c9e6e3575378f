"""Token counts of flat token files by a separator scan.

A token file is nothing but ids of a fixed width, each document's followed by an end-of-document id;
it has no index. Blocks of a file are read anywhere, and each finds its separators with one vectorised
comparison. What a block cannot know is where the document open at its start began. That comes from
a prefix scan over the file's blocks, which hold a few numbers each: the greatest separator position
of the blocks before, and the number of separators before.

``encode`` writes such files for a table of documents, one for each task, into a shared folder. It
returns which document is where; only files named there count, so a task that was lost or ran twice
leaves nothing behind that is read.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, tokenizer_path, written

DEFAULT = "byte_bpe_50k.tiktoken"
#: The id behind each document; the vocabulary leaves it free.
END_OF_DOCUMENT = 50256
WIDTHS = {2: np.dtype("<u2"), 4: np.dtype("<u4")}
_LOADED: dict[str | None, object] = {}


def loaded(path: str | None = None):
    """One encoder for each Python worker, kept between its tasks."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path or tokenizer_path(DEFAULT), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def encode(
    docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = END_OF_DOCUMENT, width: int = 2, path: str | None = None
) -> DataFrame:
    """Writes token files to ``folder`` and returns ``file, ordinal, doc_id``: each document's place.

    A null or empty text has no ids but its separator; a null id is kept; each of several equal
    rows is a document of its own; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        name = f"tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        tokens, kind, ordinal, out = loaded(path), WIDTHS[width], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(place, recursive=True)
                out = store.open_output_stream(f"{place}/{name}")
            for text in batch.column(1).to_pylist():
                out.write(np.array([*tokens.encode_ordinary(text or ""), end_id], kind).tobytes())
            ordinals = np.arange(ordinal, ordinal + batch.num_rows)
            ordinal += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([name] * batch.num_rows), pa.array(ordinals), batch.column(0)], ["file", "ordinal", "doc_id"])
        if out is not None:
            out.close()

    rows = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return rows.mapInArrow(run, "file string, ordinal long, doc_id long")


def document_lengths(files: DataFrame, folder: str, end_id: int = END_OF_DOCUMENT, width: int = 2, block_tokens: int = 1 << 21) -> DataFrame:
    """Every document of the token files named in column ``file``: ``file, ordinal, start, n_tokens, closed``.

    ``start`` counts ids of the file, separators included; ``n_tokens`` leaves the separator out. Ids
    behind the last separator are a document that is not ``closed``. A task holds one block at a time; the
    prefix scan sees three numbers a block, so a file may be as long as storage allows. Files' names are new ones
    at every run of ``encode``, and so are the names and order in results.
    """
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                n = -(-store.get_file_info(f"{place}/{name}").size // (width * block_tokens))
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(np.arange(n))], ["file", "block"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        for batch in batches:
            for name, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{place}/{name}") as f:
                    f.seek(block * block_tokens * width)
                    ids = np.frombuffer(f.read(block_tokens * width), WIDTHS[width])
                ends = np.flatnonzero(ids == end_id) + block * block_tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([block]), pa.array([block * block_tokens + len(ids)]), pa.array([ends], pa.list_(pa.int64()))],
                    ["file", "block", "stop", "ends"],
                )

    listed = files.select("file").distinct().mapInArrow(blocks, "file string, block long").repartition(parts, "file", "block")
    # written, so that files are read once, and the scan sees the few numbers of a block without its separators
    found = written(listed.mapInArrow(search, "file string, block long, stop long, ends array<long>"), f"{scratch(files.sparkSession)}/found")
    in_order = Window.partitionBy("file").orderBy("block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    numbers = found.select("file", "block", F.size("ends").alias("n"), F.array_max("ends").alias("last"))
    prefixes = numbers.select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.max("last").over(before) + 1, F.lit(0)).alias("open"),
        F.lead("block").over(in_order).isNull().alias("is_last"),
    )
    # both sides grow with the files; the join also spreads the blocks, whose arrays become rows next
    scanned = found.join(prefixes.hint("merge"), ["file", "block"])
    # a document starts behind the separator before its own, or where the scan says it is open since
    starts = F.concat(F.array("open"), F.transform("ends", lambda x: x + 1))
    tail = F.when(F.col("is_last") & (F.element_at(starts, -1) < F.col("stop")), F.array("stop")).otherwise(F.array().cast("array<long>"))
    stops = F.concat("ends", tail)
    spans = F.zip_with(F.slice(starts, F.lit(1), F.size(stops)), stops, lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    rows = scanned.select("file", "first", F.size("ends").alias("n"), F.posexplode(spans).alias("i", "span"))
    return rows.select(
        "file",
        (F.col("first") + F.col("i")).alias("ordinal"),
        F.col("span.start").alias("start"),
        (F.col("span.end") - F.col("span.start")).alias("n_tokens"),
        (F.col("i") < F.col("n")).alias("closed"),
    )


def token_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, block_tokens: int = 1 << 21) -> DataFrame:
    """Each document's number of tokens, found in token files written for it: ``doc_id, n_tokens, file, ordinal, start``."""
    spark: SparkSession = docs.sparkSession
    folder = scratch(spark)
    places = written(encode(docs, f"{folder}/tokens", id_column, text_column, path=path), f"{folder}/places")
    lengths = document_lengths(places, f"{folder}/tokens", block_tokens=block_tokens)
    # both sides grow with the documents, though the blocks' rows look small: no broadcast
    return places.join(lengths.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
