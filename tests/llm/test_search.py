"""Vector searches against brute force."""

import math

import numpy as np
import pytest

from tidemark.llm import ann_forest, exact_topk


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, 3) for i, v in rows], "vec_id long, embedding array<double>, id int, score double, rank int")


ODD = [
    (0, [1.0, 0.0, 2.0]),
    (1, [1.0, 0.0, 2.0]),
    (2, [1.0, 0.0, 2.0]),
    (3, None),
    (4, []),
    (5, [0.0, 0.0, 0.0]),
    (6, [1.0, None, 2.0]),
    (7, [math.nan, 1.0, 1.0]),
    (8, [math.inf, 1.0, 1.0]),
    (None, [1.0, 1.0, 1.0]),
    (9, [-1.0, 0.5, 0.25]),
    (9, [-1.0, 0.5, 0.25]),
    (10, [0.3, -0.7, 0.1]),
]


def plain(rows, is_query, k, score, usable):
    rows = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and usable(v)}
    out = []
    for q in rows:
        if is_query(q):
            best = sorted((-score(rows[q], v), i) for i, v in rows.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def rounded(rows):
    return sorted((q, r, i, round(s, 9)) for q, r, i, s in rows)


def cosine(a, b):
    return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))


def product(a, b):
    return int(np.floor(64 * a) @ np.floor(64 * b))


@pytest.mark.parametrize("k", [1, 2, 5])
def test_odd_rows(spark, k):
    t = table(spark, ODD)
    got = ann_forest.nearest(t, t.where("vec_id % 2 = 0 OR vec_id IS NULL"), k=k)
    assert rounded(map(tuple, got.collect())) == rounded(plain(ODD, lambda i: i % 2 == 0, k, cosine, any))
    got = exact_topk.top_k(t, t.where("vec_id % 2 = 0"), k=k)
    assert sorted(map(tuple, got.collect())) == plain(ODD, lambda i: i % 2 == 0, k, product, lambda v: True)


def test_empty(spark):
    t = table(spark, [])
    assert ann_forest.nearest(t, t).count() == 0
    assert exact_topk.top_k(t, t).count() == 0


@pytest.fixture(scope="module")
def many():
    r = np.random.default_rng(3)
    hot = r.standard_normal(32)
    rows = [(i, r.standard_normal(32).tolist()) for i in range(900)]
    rows += [(i, hot.tolist()) for i in range(900, 1300)]  # a third of all rows is one vector
    return rows + [(i, (hot + 0.05 * r.standard_normal(32)).tolist()) for i in range(1300, 1500)]


def test_exact_over_blocks(spark, many):
    t = table(spark, many)
    got = exact_topk.top_k(t, t.where("vec_id % 20 = 0"), k=20, block_rows=200, query_rows=16)
    assert sorted(map(tuple, got.collect())) == plain(many, lambda i: i % 20 == 0, 20, product, lambda v: True)


def test_exact_or_refused(spark):
    large = table(spark, [(0, [1.0, 2.0**40]), (1, [0.5, 1.0])])
    with pytest.raises(Exception, match="too large for exact products"):
        exact_topk.top_k(large, large).collect()
    uneven = table(spark, [(0, [1.0, 2.0]), (1, [0.5]), (2, None)])
    with pytest.raises(ValueError, match="vectors of 1 to 2 components"):
        exact_topk.top_k(uneven, uneven)


def test_bounds_hold():
    r = np.random.default_rng(4)
    a, b = np.floor(r.standard_normal((40, 50)) * 64), np.floor(r.standard_normal((60, 50)) * 64)
    last = np.full((40, 60), np.inf)
    for segments in exact_topk.RESOLUTIONS:
        bound = exact_topk.statistics(a, segments) @ exact_topk.statistics(b, segments).T
        assert (bound >= a @ b.T - 1e-6).all()
        assert bound.mean() <= last.mean()
        last = bound


def test_axes_do_not_change_products_and_bounds_on_them_hold():
    r = np.random.default_rng(5)
    rows = np.floor((r.standard_normal((300, 5)) @ r.standard_normal((5, 32)) + 0.1 * r.standard_normal((300, 32))) * 64)
    axes = exact_topk.principal_axes(rows[:100])
    turned = rows @ axes
    assert np.allclose(turned @ turned.T, rows @ rows.T)
    assert (np.square(turned).mean(0)[:5].sum() > 0.95 * np.square(turned).mean(0).sum())
    for single in exact_topk.RESOLUTIONS:
        own = exact_topk.statistics(turned, single)
        assert (own @ own.T >= rows @ rows.T - 1e-6 - 1e-9 * np.abs(rows @ rows.T).max()).all()
    assert exact_topk.segment_ends(64, 4) == [0, 1, 2, 3, 4, 8, 16, 32, 64] and exact_topk.segment_ends(3, 16) == [0, 1, 2, 3]


@pytest.mark.parametrize("k", [1, 20, 500])
def test_few_products_where_vectors_cluster(k):
    r = np.random.default_rng(6)
    centres = r.standard_normal((40, 64))
    rows = np.floor((centres[r.integers(0, 40, 4000)] + 0.1 * r.standard_normal((4000, 64))) * 64)
    ids = r.permutation(4000)
    block = exact_topk.Block(ids, rows, exact_topk.principal_axes(rows[:512]))
    q, found, score = block.best(ids[:64], rows[:64], k)
    for i in range(0, 64, 9):
        exact = rows @ rows[i]
        order = [j for j in np.lexsort((ids, -exact)) if j != i][:k]
        assert found[q == ids[i]].tolist() == ids[order].tolist() and score[q == ids[i]].tolist() == exact[order].tolist()
    if k == 20:
        assert block.multiplied < 0.15 * block.bounded


def test_recall(spark, many):
    t = table(spark, many)
    got = [tuple(r) for r in ann_forest.nearest(t, t.where("vec_id % 10 = 0"), k=5, block_rows=400, query_rows=40).collect()]
    want = plain(many, lambda i: i % 10 == 0, 5, cosine, any)
    found = {(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}
    assert len(got) == len(want) and len(found) >= 0.9 * len(want)
    scores = {(q, i): s for q, _, i, s in plain(many, lambda i: i % 10 == 0, 2000, cosine, any)}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, _, i, s in got)


def test_prefix_ranges():
    r = np.random.default_rng(1)
    rows = r.standard_normal((200, 16))
    forest = ann_forest.Forest(np.arange(200), rows, ann_forest.planes(16, 3, 10, 1), 3, 10)
    own = ann_forest.strings(rows, forest.normal, 3, 10)
    low, high = forest.ranges(own[:5])
    for q in range(5):
        for length in range(11):
            for t in range(3):
                same = {i for i in range(200) if own[i, t] >> np.uint64(10 - length) == own[q, t] >> np.uint64(10 - length)}
                assert set(forest.order[low[q, length, t] : high[q, length, t], t]) == same
