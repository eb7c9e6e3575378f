"""SentencePiece BPE by a prefix table: the last token of every prefix, then ids backwards.

The library merges neighbouring symbols by score until no two give a piece. The result for a text's
prefix ends in one certain token, and a token may follow another only if merging the two together
leaves just these two. So the table is filled from the left: among all pieces that end at a position
(found by one automaton over the vocabulary), exactly one is compatible with the last token of the
prefix before it. Following the last tokens from the end gives all ids.

A unit is a run of spaces with the characters up to the next run. No piece holds a space mark behind
another character (checked when a model is loaded), so merges never cross units, and ids of units seen
before are remembered by each worker within a bound.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tokenizer_path

DEFAULT = "piece_bpe_32k.model"
SPACE = "\u2581"
#: Units, parts and pairs of tokens that one worker remembers: twice as many of each at most.
REMEMBERED = 250_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Recent:
    """What was used lately: once the young half is full it becomes the old one, which is dropped."""

    def __init__(self, limit: Callable[[], int] = lambda: REMEMBERED):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit():
            self.old = dict(self.young)
            self.young.clear()  # the same dict stays: callers hold its get
        self.young[key] = value

    def get_old(self, key):
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value


class PieceBpe:
    """Ids of a SentencePiece BPE model with byte fallback and no text normalisation."""

    def __init__(self, path: str | None = None):
        import ahocorasick
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path or tokenizer_path(DEFAULT))
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.vocab_size()) if sp.is_byte(i)}
        special = {i for i in range(sp.vocab_size()) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        pieces = {sp.id_to_piece(i): i for i in range(sp.vocab_size()) if i not in special}
        if len(self.bytes) != 256 or sp.encode("a  \u00b2\tb ") != sp.encode("a  ") [:-1] + sp.encode("a  \u00b2\tb ")[len(sp.encode("a  ")) - 1 :]:
            raise ValueError("only models with byte fallback and without normalisation are supported")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece holds a space mark behind another character")
        self.score = {p: sp.get_score(i) for p, i in pieces.items()}
        self.id = pieces
        self.automaton = ahocorasick.Automaton()
        for p in pieces:
            if self._merged(p) == [p]:  # others never come out of merging
                self.automaton.add_word(p, (len(p), p))
        self.automaton.make_automaton()
        self._fits: dict[tuple[str, str], bool] = {}
        self._shown = [f"{i} " for i in range(sp.vocab_size())]
        #: neighbouring characters that some piece holds; merges cross no other pair
        self.joined = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self._parts, self._units = Recent(), Recent()

    def _merged(self, text: str) -> list[str]:
        """Plain merging, best score first and leftmost among equals; for pieces and pairs of them only."""
        symbols, score = list(text), self.score
        while len(symbols) > 1:
            best, at = max(((score.get(a + b, -1e30), -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))))
            if best == -1e30:
                break
            symbols[-at : -at + 2] = [symbols[-at] + symbols[-at + 1]]
        return symbols

    def _compatible(self, left: str, right: str) -> bool:
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            known = self._fits[left, right] = self._merged(left + right) == [left, right]
        return known

    def prefix_table(self, text: str) -> list[str]:
        """For each position, the last token of the text's ids up to there."""
        last: list[str] = []
        done, fits = 0, self._fits
        for end, (length, piece) in self.automaton.iter(text):
            if end < done:
                continue  # a piece ending here has been found
            if end > done:
                last.extend(text[done:end])  # characters without a piece stand alone, as bytes
                done = end
            if length <= end:
                before = last[end - length]
                known = fits.get((before, piece))
                if not (self._compatible(before, piece) if known is None else known):
                    continue
            last.append(piece)
            done += 1
        last.extend(text[done:])
        return last

    def _encode(self, text: str) -> list[int]:
        last, at, ids = self.prefix_table(text), len(text), []
        while at:
            piece = last[at - 1]
            at -= len(piece)
            found = self.id.get(piece)
            ids.extend([found] if found is not None else [self.bytes[b] for b in reversed(piece.encode())])
        return ids[::-1]

    def _unit(self, unit: str) -> tuple[tuple[int, ...], str]:
        """A unit's ids, from parts between which no piece reaches; parts repeat more often than units."""
        ids: list[int] = []
        start, joined, known = 0, self.joined, self._parts
        for end in range(1, len(unit) + 1):
            if end == len(unit) or unit[end - 1 : end + 1] not in joined:
                part = unit[start:end]
                got = known.young.get(part) or known.get_old(part)
                if got is None:
                    got = self._encode(part)
                    if len(part) <= 64:
                        known.put(part, got)
                ids += got
                start = end
        shown = self._shown
        return tuple(ids), "".join([shown[i] for i in ids])

    def encode(self, text: str | None) -> tuple[list[int], str]:
        """Ids of the whole text, and the same as text with a space behind each."""
        if not text:
            return [], ""
        known = self._units
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            units = text.split(" ")
        else:  # a unit is a run of marks with the characters up to the next; the library puts one mark before the text
            units = re.findall(f"{SPACE}([^{SPACE}]+|{SPACE}+[^{SPACE}]*|$)", SPACE + text.replace(" ", SPACE))
        found = list(map(known.young.get, units))
        if None in found:
            for i, got in enumerate(found):
                if got is None:
                    unit = units[i]
                    new = known.get_old(unit)
                    if new is None:
                        new = self._unit(SPACE + unit)
                        if len(unit) <= 64:
                            known.put(unit, new)
                    found[i] = new
        return list(chain.from_iterable([ids for ids, _ in found])), "".join([shown for _, shown in found])


_LOADED: dict[str | None, PieceBpe] = {}


def loaded(path: str | None = None) -> PieceBpe:
    """One encoder for each Python worker, kept between its tasks."""
    if path not in _LOADED:
        _LOADED[path] = PieceBpe(path)
    return _LOADED[path]


def encoded(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """Each document's ids with the end id, as ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        end = model.library.eos_id()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = model.encode(text)[0] + [end]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """Each document's number of ids, and digests of its ids and of the text decoded from them.

    Null and empty texts have the end id only. Each of several equal rows has a row of its own, a
    null document id is kept, an empty table gives no rows, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        end, decode = model.library.eos_id(), model.library.decode
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, shown = model.encode(text)
                ids.append(end)
                out.append(
                    (
                        doc_id,
                        len(ids),
                        hashlib.sha256(f"{shown}{end}".encode()).hexdigest(),
                        hashlib.sha256(decode(ids).encode()).hexdigest(),
                    )
                )
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(run, SCHEMA)
