"""Divergence, Jaccard links and trie codes against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, jaccard_join, trie_codes

# ------------------------------------------------------------------ divergence


def plain_audit(rows, min_docs=3, top=200):
    """rows: (lang, source, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [(a or "", b or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(lower))) for a, b, t in rows]
    out = []
    for lang in {a for a, _, _ in words}:
        docs = Counter(w for a, _, ws in words if a == lang for w in set(ws))
        kept = {w for w, n in docs.items() if n >= min_docs}
        counts = {}
        for a, b, ws in words:
            if a == lang:
                counts.setdefault(b, Counter()).update(w for w in ws if w in kept)
        whole = sum(counts.values(), Counter())
        p = lambda c, w: 1 + 1_000_000_000 * (c[w] + 1) // (sum(c.values()) + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for source, own in counts.items():
            pairs = [(sum(f(p(own, w), p(c, w)) for w in kept), s) for s, c in counts.items() if s != source]
            terms = [(f(p(own, w), p(whole, w)), w) for w in kept if own[w] and p(own, w) > p(whole, w)]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def audited(df, **settings):
    return sorted(tuple(r) for r in divergence.audit(df, **settings).select("lang", "source", "part", "item", "value", "rank").collect())


def letters(seed, rows=120):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdéß中") for _ in range(r.randint(1, 3))) for _ in range(80)]
    for _ in range(rows):
        words = r.choices(vocabulary, weights=range(1, 81), k=r.randint(0, 30))
        yield r.choice(["en", "de", None]), r.choice(["a", "b", "c", "Ä", "", None]), r.choice([" ", "-", "7", "\x00"]).join(words).title()


@pytest.mark.parametrize("block", [1, 40, 600_000])
def test_audit_is_the_plain_one(spark, block):
    rows = [*letters(block), ("fr", "only", "un deux trois"), ("xx", "p", "a b"), ("xx", "q", None)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    assert audited(df, block=block) == plain_audit(rows)


def test_audit_keeps_the_top_terms_and_ties(spark):
    rows = [("en", s, " ".join(f"{s}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40))) for s in "ab" for _ in range(3)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    assert audited(df, top=7) == plain_audit(rows, top=7)


def test_audit_of_odd_texts(odd_docs, no_docs):
    odd = odd_docs.withColumns({"source": F.lit(None).cast("string"), "lang": F.when(F.col("doc_id") > 5, "en"), "term": F.lit(1), "g": F.lit("x")})
    rows = [(r["lang"], r["source"], r["text"]) for r in odd.collect()]
    assert audited(odd) == plain_audit(rows)
    assert audited(no_docs.withColumn("source", F.lit("s"))) == []


def test_shares_are_exact():
    r = random.Random(1)
    total = np.array([r.randint(1, 9 * 10**15) for _ in range(2000)])
    count = np.array([r.randint(0, int(t)) for t in total])
    assert divergence.share(count, total).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(count, total)]


# --------------------------------------------------------------- Jaccard links


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset([b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else [])


def plain_links(rows, percent=90):
    """rows: (id, text); by all pairs."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and both:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def found_links(df, **settings):
    return sorted((tuple(r) for r in jaccard_join.linked(df, **settings).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(seed, groups=6, size=25, changes=4):
    """Groups around one text each, with up to ``changes`` words replaced: some pairs linked, some just not."""
    r = random.Random(seed)
    common = [f"c{i}" for i in range(12)]
    rows = []
    for g in range(groups):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([4, 10, 30, 60, 120]))]
        for _ in range(size):
            words = list(base)
            for _ in range(r.randint(0, changes)):
                words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
            if r.random() < 0.5:
                words = words + common
            rows.append(" ".join(words[: len(words) - r.randint(0, 2)]))
    rows += ["", None, "one", "One", "one two", "a b c", "A  b\nc", "a b c d"]
    r.shuffle(rows)
    return [(i if i % 17 else None, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, block, short", [(1, 1024, 32), (2, 4, 2), (3, 1, 1)])
def test_links_are_those_of_all_pairs(spark, seed, block, short):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found_links(df, block=block, short=short) == plain_links(rows)


def test_a_large_group_of_near_copies(spark):
    """Chains in a cluster: members link to some others only, and one component spans them."""
    rows = near_copies(9, groups=1, size=300, changes=3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found_links(df, block=8, short=4) == plain_links(rows)


def test_other_thresholds(spark):
    rows = near_copies(4, groups=4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (70, 100):
        assert found_links(df, percent=percent) == plain_links(rows, percent)
    with pytest.raises(ValueError):
        jaccard_join.linked(df, percent=40)


def test_links_of_odd_texts(odd_docs, no_docs):
    odd = odd_docs.withColumns({"nid": F.lit("x"), "token": F.lit(2), "n": F.lit(0.5)})
    assert found_links(odd) == plain_links([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert found_links(no_docs) == []


def test_no_bound_is_too_tight():
    """Signatures and positions never rule out a linked pair."""
    r = random.Random(6)
    for _ in range(300):
        words = [str(r.randrange(50)) for _ in range(r.randint(3, 60))]
        other = list(words)
        other[r.randrange(len(other))] = "new"
        a, b = (jaccard_join.tokens(" ".join(w)) for w in (words, other))
        apart = sum((int(x) ^ int(y)).bit_count() for x, y in zip(jaccard_join._signature(a).view(np.uint64), jaccard_join._signature(b).view(np.uint64)))
        both = len(np.intersect1d(a, b))
        assert apart <= len(a) + len(b) - 2 * both
        assert jaccard_join.wide_apart(jaccard_join._wide(a), jaccard_join._wide(b)) <= len(a) + len(b) - 2 * both
        if 100 * both >= 90 * (len(a) + len(b) - both):
            first = lambda x: x[: len(x) - -(-90 * len(x) // 100) + 1]
            shared = np.intersect1d(first(a), first(b))
            assert len(shared)
            one = {"root": np.array([1]), "leader": np.array([1]), "n": np.array([len(a)]), "pos": np.flatnonzero(a == shared[0])}
            two = {"root": np.array([2]), "leader": np.array([2]), "n": np.array([len(b)]), "pos": np.flatnonzero(b == shared[0])}
            assert jaccard_join._possible(one, two, 90).all()


# ------------------------------------------------------------------ trie codes


def plain_codes(rows, factor=4096, parts=8, entries=16, rounds=6):
    """rows: (id, vector, label) with unique ids."""
    kept = [(i, [math.floor(factor * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted((k for k in kept if k[0] is not None), key=lambda k: k[0])[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min((apart(part, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in kept:
                held.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for e, some in held.items():
                books[p][e] = [sum(c) // len(some) for c in zip(*some)]
    coded = []
    for i, v, label in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    of_label = Counter()
    for _, _, error, label in coded:
        of_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, code, error, of_label[label], digest) for i, code, error, label in coded), key=str)


def found_codes(df, **settings):
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in trie_codes.compress(df, **settings).select(*columns).collect()), key=str)


VECTORS = "vec_id long, embedding array<double>, label int, code string, part int"


@pytest.mark.parametrize("rows", [3, 40, 400])
def test_codes_are_the_plain_ones(spark, rows):
    r = random.Random(rows)
    data = [(i * 3 - 20, [r.choice([-0.5, 0.25, 0.0, r.uniform(-1, 1)]) for _ in range(16)], r.choice([0, 1, None]), "x", 1) for i in range(rows)]
    data += [(10_000 + i, data[0][1], 7, "x", 1) for i in range(rows)]  # one vector in half of the rows
    data += [(None, data[1][1], None, None, None), (5, None, 1, "x", 1), (6, [0.0] * 15 + [None], 1, "x", 1), (7, [float("nan")] * 16, 1, "x", 1)]
    data += [(8, [float("inf")] * 16, 1, "x", 1), (9, [], 1, "x", 1)]
    df = spark.createDataFrame(data, VECTORS).repartition(5)
    assert found_codes(df) == plain_codes([d[:3] for d in data])
    assert found_codes(df, parts=2, entries=3, rounds=2, factor=10) == plain_codes([d[:3] for d in data], 10, 2, 3, 2)


def test_codes_without_rows_ids_or_fitting_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert found_codes(empty) == []
    nameless = spark.createDataFrame([(None, [0.5] * 8, 1, "x", 1)] * 3, VECTORS)
    assert [r[1:4] for r in found_codes(nameless)] == [("00" * 8, 0, 0)] * 3
    for bad in ([0.5] * 9, [1e300] * 8):
        with pytest.raises(Exception, match="length|components"):
            found_codes(spark.createDataFrame([(1, [0.5] * 8, 1, "x", 1), (2, bad, 1, "x", 1)], VECTORS))


def test_a_walk_adds_up_each_prefix_once():
    r = np.random.default_rng(3)
    parts = r.integers(-3, 3, (500, 4))
    parts = parts[np.lexsort(parts.T[::-1])]
    book = r.integers(-3, 3, (5, 4))
    best, apart = trie_codes.walk(parts, book)
    every = ((parts[:, None, :] - book[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (apart == every.min(1)).all()
    packed = trie_codes._packed(parts)
    assert (np.sort(packed) == packed).all()
