"""Harmonic packing: whole documents as token sequences of a fixed capacity, without padding.

A remainder whose length lies in the reciprocal class ``(capacity / (k + 1), capacity / k]`` shares a
sequence with exactly ``k - 1`` others of its class, whatever the other classes hold. What k of them leave
free, less than one more would need, is filled with tokens cut off the front of other documents, so that
few documents are cut and no sequence is padded.

Every task packs its own documents and needs nothing of the others: no shuffle, no counts, no second
pass. A document first fills what is free, if it is longer than a sequence or if many sequences wait; then
whole sequences are cut from it, and its remainder goes to its class. Open sequences are held with their
ids, one for each class and ``WAITING`` that lack filling: some hundred kilobytes. What a task holds in the
end is laid end to end and cut at the capacity; the tokens left over make sequences of powers of two.

Defined results: a null or empty text is one end id; a null document id is kept; each of several
equal rows is a document of its own; very long texts are cut into whole sequences; an empty table gives no
rows; other columns are ignored. Sequences are numbered by task and within it, so a repeated task gives
the same rows again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import word_bpe

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Sequences that may wait for filling before documents of any length are cut for them.
WAITING = 64
#: Sequences one task may number.
PER_TASK = 1 << 40
#: Rows of one batch handed on.
ROWS = 20_000


class Piece:
    """Consecutive ids of a document, not placed yet; ``start`` of its ``tokens`` ids come before."""

    __slots__ = ("doc_id", "start", "tokens", "ids")

    def __init__(self, doc_id: int | None, start: int, tokens: int, ids: bytes | memoryview):
        self.doc_id, self.start, self.tokens, self.ids = doc_id, start, tokens, ids

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, length: int) -> Piece:
        """Takes so many ids off the front."""
        front = Piece(self.doc_id, self.start, self.tokens, self.ids[: 4 * length])
        self.ids = self.ids[4 * length :]
        self.start += length
        return front


class Packer:
    """Packs documents one by one; ``rows`` collects what is placed, as columns of ``PIECES``."""

    def __init__(self, capacity: int, first_sequence: int = 0):
        self.capacity, self.next = capacity, first_sequence
        self.classes: dict[int, list[Piece]] = {}
        self.waiting: list[list[Piece]] = []  # each has its class's documents and lacks filling
        self.free: list[int] = []  # how many ids each of them lacks
        self.rows: list[tuple] = []

    def _place(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            self.rows.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.tokens, self.next, offset))
            offset += len(p)
        self.next += 1

    def _fill(self, piece: Piece) -> None:
        """Cuts the front of the document for waiting sequences, as long as it is enough for one."""
        while self.free and len(piece) >= self.free[-1]:
            filled = self.waiting.pop()
            filled.append(piece.cut(self.free.pop()))
            self._place(filled)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        tokens = len(ids) // 4
        piece = Piece(doc_id, 0, tokens, memoryview(ids) if tokens >= self.capacity else ids)
        if tokens >= self.capacity or len(self.free) >= WAITING:
            self._fill(piece)
        while len(piece) >= self.capacity:
            self._place([piece.cut(self.capacity)])
        if not len(piece):
            return
        piece.ids = bytes(piece.ids)  # the rest of a long document is held without the document
        k = self.capacity // len(piece)
        group = self.classes.setdefault(k, [])
        group.append(piece)
        if len(group) == k:
            del self.classes[k]
            free = self.capacity - sum(map(len, group))
            if free:
                self.waiting.append(group)
                self.free.append(free)
            else:
                self._place(group)

    def finish(self) -> None:
        """Lays what is left end to end: full sequences, then one for each binary digit of the rest."""
        left = [p for group in [*self.waiting, *self.classes.values()] for p in group]
        self.waiting, self.free, self.classes = [], [], {}
        total = sum(map(len, left))
        digits = [1 << b for b in range(self.capacity.bit_length() - 1, -1, -1) if (total % self.capacity) >> b & 1]
        left.reverse()
        for size in [self.capacity] * (total // self.capacity) + digits:
            group = []
            while size:
                piece = left.pop()
                if len(piece) > size:
                    left.append(piece)
                    piece = piece.cut(size)
                group.append(piece)
                size -= len(piece)
            self._place(group)


def pieces(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = 2048, end_id: int = 1, path: str | None = None
) -> DataFrame:
    """Placed pieces of every document, packed within the task that reads it."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity has to be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe.loaded(path)
        end = end_id.to_bytes(4, "little")
        names = [c.split()[0] for c in PIECES.split(", ")]
        packer = Packer(capacity, TaskContext.get().partitionId() * PER_TASK)

        def placed() -> pa.RecordBatch:
            columns = zip(*packer.rows) if packer.rows else [[]] * len(names)
            found = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            packer.rows.clear()
            return found

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packer.add(doc_id, encoder.encode(text) + end)
                if len(packer.rows) >= ROWS:
                    yield placed()
        packer.finish()
        yield placed()

    rows = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return rows.mapInArrow(run, PIECES)


def pack(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = 2048, end_id: int = 1, path: str | None = None
) -> DataFrame:
    """Documents as pieces of gapless sequences.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A sequence holds
    ``capacity`` tokens, or a smaller power of two where a task ends; none needs padding. See above for odd input.
    """
    return pieces(docs, id_column, text_column, capacity, end_id, path)
