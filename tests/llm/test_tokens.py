"""Token operators against the libraries themselves, and packing against its rules."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import packing, piece_bpe, token_scan, word_bpe

ALPHABET = "aAbé'sStTñß.,!?<|>/endoftext \n\t\r\u00a0\u3000\u2581İΣσς中́e\u0301²½0189_-\"\\`~{}[]()É×ÿ\u200b\x00\x85🙂'll're"


def texts(n, seed):
    r = random.Random(seed)
    yield from ["", " ", "  ", "\n", "a" * 500, "aaaa  aaaa " * 40, "<|endoftext|>", "x<|startoftext|>y"]
    for _ in range(n):
        yield "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40)))


def test_word_ids_are_the_librarys():
    encoder = word_bpe.WordBpe()
    for text in texts(3000, 1):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def test_piece_ids_are_the_librarys():
    model = piece_bpe.PieceBpe()
    for text in texts(3000, 2):
        ids, shown = model.encode(text)
        assert ids == model.library.encode(text)
        assert shown == "".join(f"{i} " for i in ids)


def test_a_prefix_has_one_last_token():
    model = piece_bpe.PieceBpe()
    text = "\u2581unbelievable"
    last = model.prefix_table(text)
    for i in range(1, len(text) + 1):
        assert model.library.id_to_piece(model.library.encode(text[1:i])[-1]) == last[i - 1] if i > 1 else True


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 3)
    monkeypatch.setattr(word_bpe, "REMEMBERED", 3)
    model, words = piece_bpe.PieceBpe(), word_bpe.WordBpe()
    for text in texts(200, 3):
        assert model.encode(text)[0] == model.library.encode(text)
        assert np.frombuffer(words.encode(text), "<u4").tolist() == words.library.encode(text, add_special_tokens=False).ids


def test_piece_digests(odd_docs, no_docs):
    sp = piece_bpe.PieceBpe().library

    def row(doc_id, text):
        ids = sp.encode(text or "") + [sp.eos_id()]
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return doc_id, len(ids), digest(" ".join(map(str, ids))), digest(sp.decode(ids))

    want = sorted((row(r["doc_id"], r["text"]) for r in odd_docs.collect()), key=str)
    assert sorted((tuple(r) for r in piece_bpe.digests(odd_docs).collect()), key=str) == want
    assert piece_bpe.digests(no_docs).count() == 0
    ids = {(r["doc_id"], tuple(r["ids"])) for r in piece_bpe.encoded(odd_docs).collect()}
    assert (4, (sp.eos_id(),)) in ids


def check_packing(docs, capacity):
    library = word_bpe.WordBpe().library
    rows = packing.pack(docs, capacity=capacity).toPandas()
    want = []
    for r in docs.collect():
        want.append((r["doc_id"], [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]))
    # every id of every document is in exactly one piece: pieces of equal documents are told apart by nothing else
    held, copies = {}, {}
    for doc_id, ids in want:
        key = (doc_id, np.array(ids, "<u4").tobytes())
        copies[key] = copies.get(key, 0) + 1
        held.setdefault((doc_id, len(ids)), []).append(key[1])
    covered = {}
    for r in rows.itertuples():
        doc_id = None if r.doc_id != r.doc_id else int(r.doc_id)
        part = [t for t in held[doc_id, r.doc_tokens] if zlib.crc32(t[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32]
        assert part and r.length > 0
        count = covered.setdefault((doc_id, part[0]), np.zeros(r.doc_tokens, int))
        count[r.start : r.start + r.length] += 1
    assert covered.keys() == copies.keys()
    assert all((covered[key] == n).all() for key, n in copies.items())
    for _, seq in rows.sort_values("offset").groupby("sequence_id"):
        assert (seq.length.cumsum() - seq.length == seq.offset).all()
        total = int(seq.length.sum())
        assert total <= capacity and total & (total - 1) == 0
    full = (rows.groupby("sequence_id").length.sum() == capacity).sum()
    tokens = sum(len(ids) for _, ids in want)
    assert rows.sequence_id.nunique() - full <= capacity.bit_length() * docs.rdd.getNumPartitions() and full * capacity <= tokens


def test_classes_are_filled_by_count():
    """Each full sequence holds k documents' rests of class k, and at most one piece cut off another document."""
    r = random.Random(8)
    packer, lengths = packing.Packer(2048), [min(1 + int(r.expovariate(1 / 700)), 9000) for _ in range(5000)]
    for i, n in enumerate(lengths):
        packer.add(i, b"abcd" * n)
        assert len(packer.waiting) <= packing.WAITING + 100
    before = len(packer.rows)
    sequences = {}
    for doc_id, start, length, _, tokens, sequence, offset in packer.rows:
        sequences.setdefault(sequence, []).append((offset, start, length, tokens))
    for pieces in sequences.values():
        assert sum(length for _, _, length, _ in pieces) == 2048
        rests = [length for _, start, length, tokens in pieces if start + length == tokens and length < 2048]
        k = 2048 // max(rests) if rests else 0
        assert len(pieces) in (1, k, k + 1)
    packer.finish()
    assert sum(row[2] for row in packer.rows) == sum(lengths)
    assert len(packer.rows) - before < 1000 and len(packer.rows) < 2 * len(lengths)


@pytest.mark.parametrize("capacity", [1, 64, 2048])
def test_packing_odd(odd_docs, capacity):
    check_packing(odd_docs if capacity > 1 else odd_docs.where("doc_id <> 7"), capacity)


def test_packing_real(real_docs):
    check_packing(real_docs.repartition(5), 2048)


def test_packing_empty(no_docs):
    assert packing.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(no_docs, capacity=100)


def test_packing_adds_up_over_tasks(spark):
    docs = spark.range(0, 3000, 1, 30).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 40).cast("int")).alias("text"))
    check_packing(docs, 64)


@pytest.mark.parametrize("block_tokens", [1, 7, 1000, 1 << 21])
def test_token_counts(odd_docs, block_tokens):
    docs = odd_docs if block_tokens > 7 else odd_docs.where("doc_id IS NULL OR doc_id <> 7")
    encoder = token_scan.loaded()
    want = sorted(((r["doc_id"], len(encoder.encode_ordinary(r["text"] or ""))) for r in docs.collect()), key=str)
    got = token_scan.token_counts(docs, block_tokens=block_tokens)
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got.collect()), key=str) == want


def test_token_counts_empty(no_docs):
    assert token_scan.token_counts(no_docs).count() == 0


@pytest.mark.parametrize("block_tokens", [1, 2, 3, 5, 100])
def test_stitching(spark, tmp_path, block_tokens):
    """Separators at block ends, blocks without one, and ids behind the last one."""
    files = {"a.bin": [9, 1, 1, 9, 9, 1, 1, 1, 1, 1, 1, 9, 1], "b.bin": [1, 9], "c.bin": [1, 1, 1], "d.bin": [9]}
    want = set()
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u4").tobytes())
        start = ordinal = 0
        for i, x in enumerate(ids):
            if x == 9:
                want.add((name, ordinal, start, i - start, True))
                start, ordinal = i + 1, ordinal + 1
        if start < len(ids):
            want.add((name, ordinal, start, len(ids) - start, False))
    names = spark.createDataFrame([(n,) for n in files], "file string")
    got = token_scan.document_lengths(names, str(tmp_path), end_id=9, width=4, block_tokens=block_tokens)
    assert {tuple(r) for r in got.select("file", "ordinal", "start", "n_tokens", "closed").collect()} == want


def test_the_prefix_scan_moves_no_separators(spark, tmp_path):
    np.array([1, 9, 2, 9], "<u4").tofile(tmp_path / "a.bin")
    got = token_scan.document_lengths(spark.createDataFrame([("a.bin",)], "file string"), str(tmp_path), end_id=9, width=4, block_tokens=2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    cut = next(line for line in plan[plan.index("Window [") :].split("\n") if "Project [" in line)
    assert "size(ends" in cut and ", ends#" not in cut and "[ends#" not in cut
    assert sorted(tuple(r) for r in got.collect()) == [("a.bin", 0, 0, 1, True), ("a.bin", 1, 2, 1, True)]
