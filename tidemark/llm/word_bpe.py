"""Ids of the word-end BPE vocabulary, word by word.

White space separates words before any other rule of this vocabulary applies, so a text's ids are
its words' ids in a row. Words repeat, so each Python worker remembers the ids of those it has seen,
as bytes: a text's ids are then one ``bytes.join``. A plain word (Latin letters, digits, ASCII marks)
is cut by the vocabulary's own pattern and merged through tiktoken, whose merges go by rank as well:
the word end becomes the byte 0xff, which UTF-8 never holds. Any other word goes to the tokenizers
library itself.
"""

from __future__ import annotations

import json
import re
from array import array
from itertools import repeat

from tidemark.llm.common import tokenizer_path
from tidemark.llm.piece_bpe import Recent

DEFAULT = "word_bpe_49k.json"
#: Words that one worker remembers, and parts of words: twice as many of each at most.
REMEMBERED = 250_000

_PLAIN = re.compile(r"[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff!#-&(-;=?@\[-`{-~]+")
_PART = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]{1,64}")
_PARTS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^0-9a-z\u00df-\u00f6\u00f8-\u00ff]+")
_END = b"\xff"


def _byte_of_character() -> dict[str, int]:
    """The usual byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class WordBpe:
    """Encodes texts to little-endian unsigned ids of ``width`` bytes (2 or 4)."""

    def __init__(self, path: str | None = None, width: int = 4):
        import tiktoken
        from tokenizers import Tokenizer

        path = path or tokenizer_path(DEFAULT)
        self.width = width
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        byte = _byte_of_character()
        ranks = {}
        for token, rank in vocabulary.items():
            end = token.endswith("</w>") and token != "</w>"
            body = token[:-4] if end else token
            if all(c in byte for c in body):
                ranks[bytes(byte[c] for c in body) + (_END if end else b"")] = rank
        self._type = {2: "H", 4: "I"}[width]  # native order, which is little-endian where Spark runs
        specials = {t.content for t in self.library.get_added_tokens_decoder().values()}
        ranks = {b: r for b, r in ranks.items() if b.decode("utf-8", "replace") not in specials}
        self._merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self._known = Recent(lambda: REMEMBERED)

    def _merged(self, part: str) -> bytes:
        return array(self._type, self._merge(part.encode() + _END)).tobytes()

    def _find(self, word: str) -> bytes:
        """Ids of a word or part that is not among the young ones.

        A word of several parts is remembered only if its parts have been met before: most words that
        occur once do not take the place of others.
        """
        found = self._known.get_old(word)
        if found is not None:
            return found
        if _PART.fullmatch(word):
            found = self._merged(word)
        elif not _PLAIN.fullmatch(word):
            found = array(self._type, self.library.encode(word, add_special_tokens=False).ids).tobytes()
            if len(word) > 64:
                return found
        else:
            parts = _PARTS.findall(word.lower())
            ids = list(map(self._known.young.get, parts))
            new = None in ids
            if new:
                ids = [(self._known.get_old(p) or self._remembered(p)) if found is None else found for p, found in zip(parts, ids)]
            found = b"".join(ids)
            if new or len(word) > 64:
                return found
        self._known.put(word, found)
        return found

    def _remembered(self, part: str) -> bytes:
        found = self._merged(part)
        if len(part) <= 64:
            self._known.put(part, found)
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text; none for null and empty texts."""
        words = (text or "").replace("\n", " ").split(" ")
        ids = list(map(self._known.young.get, words, repeat(b"")))
        if b"" in ids:
            find = self._find
            for i, word in enumerate(words):
                if word and not ids[i]:
                    ids[i] = find(word)
        return b"".join(ids)


_LOADED: dict[tuple, WordBpe] = {}


def loaded(path: str | None = None, width: int = 4) -> WordBpe:
    """One encoder for each Python worker, kept between its tasks."""
    key = (path, width)
    if key not in _LOADED:
        _LOADED[key] = WordBpe(path, width)
    return _LOADED[key]
