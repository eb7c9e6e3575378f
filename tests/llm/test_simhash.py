"""SimHash near-duplicates against all pairs, and the parts of the pigeonhole search."""

import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=3):
    """rows: (id, fingerprint); by all pairs."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= distance:
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(i)] = min(ids.get(root(i), doc_id), doc_id)
    return sorted(((d, f"{f:016x}", ids.get(root(i))) for i, (d, f) in enumerate(rows)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_odd_texts(odd_docs):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in odd_docs.collect()]
    assert result(simhash.near_duplicates(odd_docs)) == plain_components(rows)


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_real(real_docs):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in real_docs.collect()]
    assert result(simhash.near_duplicates(real_docs)) == plain_components(rows)


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_links_find_every_pair(spark, distance):
    """Clusters with a hot common pattern: some partitions' values are shared by most rows."""
    r = random.Random(distance)
    base = r.getrandbits(64)
    fps = {base ^ sum(1 << b for b in r.sample(range(20), r.randint(0, 4))) for _ in range(150)}
    fps |= {r.getrandbits(64) for _ in range(300)}
    fps |= {f ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for f in list(fps)[:100]}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {(a, b) for a, b in simhash.links(df, distance).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= distance}
    assert got == want


def test_thresholds_add_up_and_cost_least():
    r = np.random.default_rng(5)
    fps = r.integers(-(1 << 62), 1 << 62, 50)
    bits = simhash._bit_matrix(fps)
    parts = [list(range(i, 64, 4)) for i in range(4)]
    near = simhash._within
    tables = [[near(r.integers(1, 50, 256).astype(float), 8, 3) for _ in range(2)] for _ in parts]
    got = simhash.allocate(bits, parts, tables, 10_000, 3)
    assert (got >= -1).all() and ((got + 1).sum(1) == 4).all()


def test_correlated_bits_share_a_partition():
    both = np.eye(64) * 50 + (1 - np.eye(64)) * 25
    for i in range(0, 8):
        for j in range(0, 8):
            both[i, j] = 50  # these eight bits are always equal
    parts = simhash.correlated_partitions(100, both, 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any(set(range(8)) <= set(p) for p in parts)


def test_components_of_a_chain(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7)], "u long, v long")
    got = dict(tuple(r) for r in components(edges, str(tmp_path)).collect())
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}
