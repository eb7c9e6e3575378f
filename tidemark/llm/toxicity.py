"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts carry a label that is used (P); all texts, their labels unread (U), hold clean
and toxic ones. With the share ``prior`` of toxic texts, the risk of a linear scorer g under the logistic loss is

    prior * R+(P)  +  max(0, R-(U) - prior * R-(P))

since clean texts' risk is that of all texts less that of the toxic share. Where the estimate in the
bracket falls below zero the scorer has started to learn U by heart: that step then climbs instead.

Features are a text's distinct lower-cased words and their first four, five and six letters, hashed; a
beginning counts once for each word that has it. Only features that at least LEAST confirmed texts hold, and
more often than all texts do by CHANCE standard errors, bear weight. The sum is divided by the square root of
1 + words / LENGTH, since a long text meets more of them by chance. Training and scoring share all this. The
three values were chosen on a validation third of the training fold of table sf0.1. Copies and near copies are one piece
of evidence, in the sample of confirmed texts as in that of all: else the rare words of a toxic text that was copied a dozen
times would pass for signs of toxicity. The sample for training is bounded by ``positives`` and ``unlabelled`` (rows whose id
hashes lowest); the prior is the share of toxic rows among all labelled rows that are not held out.

Defined results: null and empty texts score what the bias alone gives; without a confirmed toxic text
every score is 0; a null id is never held out nor trained on; a document labelled more than once is
toxic if any row says so; each of several equal rows gets a row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, scratch, written

#: Hash bins of the features.
BINS = 1 << 18
#: Confirmed texts that have to hold a feature, and standard errors by which their share has to exceed the usual one.
LEAST, CHANCE = 4, 4.0
#: Distinct words from which on a text's length lowers what one of them counts.
LENGTH = 200
#: Least values of a text's words under as many hashes, in bands of that many; texts that agree in at least half of them
#: (about half of the words they have together are common to both) are near copies.
SIGNATURE, BAND, ALIKE = 32, 4, 0.5
#: Texts of fewer distinct words may have the same ones without being copies: only equal texts count as such.
FEW = 20
#: Words whose weight one worker remembers before it starts afresh.
REMEMBERED = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def bins_of(word: str) -> list[int]:
    """Where a word and its beginnings fall."""
    parts = {f"={word}"} | {word[:n] for n in (4, 5, 6) if len(word) >= n}
    return [zlib.crc32(p.encode()) % BINS for p in parts]


def features(found: set[str]) -> np.ndarray:
    """The sorted bins of a text's words; one is repeated if several words have it."""
    return np.sort(np.array([b for w in found for b in bins_of(w)], np.int32))


def signature(found: set[str], text: str) -> np.ndarray:
    """Least values of the words under SIGNATURE hashes; with fewer than FEW words, numbers drawn by the whole text."""
    if len(found) < FEW:
        seed = hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=16).digest()
        return np.random.default_rng(int.from_bytes(seed, "little")).integers(0, (1 << 31) - 1, SIGNATURE, np.int32)
    r = np.random.default_rng(11)
    factor, shift = r.integers(1, 1 << 31, SIGNATURE) | 1, r.integers(0, 1 << 31, SIGNATURE)
    values = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in found], np.int64)[:, None]
    return ((values * factor + shift) % ((1 << 61) - 1) % ((1 << 31) - 1)).min(0).astype(np.int32)


def copies(signatures: list[np.ndarray]) -> list[bool]:
    """Whether each text is a near copy of an earlier one that is none itself."""
    kept: dict[tuple, list[np.ndarray]] = {}
    out = []
    for own in signatures:
        bands = [(i, own[i : i + BAND].tobytes()) for i in range(0, SIGNATURE, BAND)]
        out.append(any((own == other).mean() >= ALIKE for band in bands for other in kept.get(band, ())))
        if not out[-1]:
            for band in bands:
                kept.setdefault(band, []).append(own)
    return out


def _damping(n_words):
    return (1 + n_words / LENGTH) ** -0.5


def supported(p: np.ndarray, u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """Whether a feature may bear weight, from the numbers of confirmed and of other texts that hold it."""
    usual = (u + 1) / (n_u + 1)
    error = np.sqrt(np.maximum(usual * (1 - usual), 1e-9) / max(n_p, 1))
    return (p >= LEAST) & (p / max(n_p, 1) - usual >= CHANCE * error)


def holders(rows: list[np.ndarray]) -> np.ndarray:
    """How many rows hold each bin."""
    return sum((np.bincount(np.unique(r), minlength=BINS) for r in rows), np.zeros(BINS, np.int64))


class _Rows:
    """Sparse rows; each value is its row's damping."""

    def __init__(self, rows: list[np.ndarray], n_words: np.ndarray):
        self.bins = np.concatenate([*rows, np.empty(0, np.int32)])
        self.of = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
        self.n = len(rows)
        self.value = _damping(np.asarray(n_words, float))[self.of]

    def score(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, weights=w[self.bins] * self.value, minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.bins, weights=g[self.of] * self.value, minlength=BINS)


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    @classmethod
    def fit(
        cls,
        positive: list[np.ndarray],
        unlabelled: list[np.ndarray],
        prior: float,
        n_words: tuple[list[int], list[int]] | None = None,
        rounds: int = 120,
        step: float = 0.2,
        sparsity: float = 1e-4,
        slack: float = 0.02,
        depth: float = 0.5,
    ) -> ToxicityModel | None:
        """Minimises the corrected risk by adaptive gradient steps over all given rows.

        Weights are evidence for toxicity: none is negative, and ``sparsity`` holds back weak ones.
        ``n_words`` are the rows' numbers of distinct words, else their lengths. The bias stays within ``depth`` below the prior's
        log odds: else texts with much evidence would let it sink until one sure word no longer tells.
        """
        if not positive or not unlabelled:
            return None
        prior = min(max(prior, 1e-3), 0.9)
        bearing = supported(holders(positive), holders(unlabelled), len(positive), len(unlabelled))
        if n_words is None:
            n_words = [len(r) for r in positive], [len(r) for r in unlabelled]
        p, u = (_Rows([r[bearing[r]] for r in rows], np.array(n)) for rows, n in zip((positive, unlabelled), n_words))
        top = float(np.log(prior / (1 - prior)))
        w, b = np.zeros(BINS), top
        mean, square = np.zeros(BINS + 1), np.zeros(BINS + 1)
        last_w, last_b, n = np.zeros(BINS), 0.0, 0
        sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for t in range(1, rounds + 1):
            sp, su = sigmoid(p.score(w) + b), sigmoid(u.score(w) + b)
            clean_risk = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
            up, uu = sp / p.n * -prior, su / u.n  # of the clean texts' risk
            if clean_risk >= -slack:
                gp, gu = prior * (sp - 1) / p.n + up, uu
            else:
                gp, gu = -up, -uu
            g = np.append(p.back(gp) + u.back(gu) + sparsity, gp.sum() + gu.sum())
            mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
            move = step * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-6)
            w, b = np.maximum(w - move[:-1], 0), float(np.clip(b - move[-1], top - depth, top))
            if t > rounds * 2 // 3:  # the mean of the last steps is steadier than the last
                last_w, last_b, n = last_w + w, last_b + b, n + 1
        return cls(np.where(bearing, last_w / n, 0).astype(np.float32), last_b / n)

    def scorer(self):
        """text -> score, remembering the weights of words."""
        known: dict[str, float] = {}
        weights, bias = self.weights, self.bias

        def of(word: str) -> float:
            got = known.get(word)
            if got is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                got = known[word] = float(weights[bins_of(word)].sum())
            return got

        def score(text: str | None) -> float:
            found = words(text)
            z = bias + sum(map(of, found)) * _damping(len(found))
            return 1 / (1 + exp(-min(max(z, -30.0), 30.0)))

        return score


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    positives: int = 3000,
    unlabelled: int = 6000,
    prior: float | None = None,
) -> ToxicityModel | None:
    """Fits a scorer on the bounded sample. ``labels`` has the documents' ids and 0, 1 or null.

    The sample is chosen by ids alone; its features are computed and counted on the executors. The
    unlabelled rows are drawn from all rows that are not held out, their labels unread: the risk takes them for all texts.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("id"))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        share = known.agg(F.avg("toxic").alias("share")).first()["share"]
        prior = share or 0.0
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.where(F.col("id").isNotNull() & ~held_out("id"))
    keys = rows.select("id", F.xxhash64("id").alias("h")).distinct()
    lowest = lambda ids, n: [r["id"] for r in ids.orderBy("h", "id").limit(n).collect()]
    p_ids = lowest(keys.join(known.where("toxic = 1"), "id", "left_semi"), positives)
    u_ids = lowest(keys, unlabelled)
    if not p_ids or not u_ids:
        return None

    kind = rows.schema["id"].dataType.simpleString()
    confirmed, others = set(p_ids), set(u_ids)
    wanted = [(i, i in confirmed, i in others) for i in sorted(confirmed | others)]
    wanted = F.broadcast(docs.sparkSession.createDataFrame(wanted, f"id {kind}, p boolean, u boolean"))
    # of rows that repeat an id the text that hashes lowest; reduced in the tasks that read them
    texts = rows.join(wanted, "id").groupBy("id", "p", "u").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    texts = texts.select("p", "u", "text", F.xxhash64("id", "text").alias("row"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [t or "" for t in batch.column("text").to_pylist()]
            found = [words(t) for t in held]
            bins, signed = [features(w).tobytes() for w in found], [signature(w, t).tobytes() for w, t in zip(found, held)]
            columns = [*(batch.column(c) for c in ("row", "p", "u")), pa.array(map(len, found), pa.int32()), pa.array(bins, pa.binary()), pa.array(signed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "p", "u", "n", "bins", "signed"])

    sample = written(texts.mapInArrow(vectors, "row long, p boolean, u boolean, n int, bins binary, signed binary"), f"{scratch(docs.sparkSession)}/sample")

    # signatures of the bounded sample, 128 bytes each
    signed = sorted((r["row"], r["p"], r["u"], bytes(r["signed"])) for r in sample.select("row", "p", "u", "signed").collect())
    one_each = []
    for which in (1, 2):
        mine = [r for r in signed if r[which]]
        alike = copies([np.frombuffer(r[3], np.int32) for r in mine])
        one_each.append({r[0] for r, again in zip(mine, alike) if not again})

    def evidence(batch: pa.RecordBatch) -> list[tuple[bool, bool, int, np.ndarray]]:
        columns = (batch.column(c).to_pylist() for c in ("row", "n", "bins"))
        return [(row in one_each[0], row in one_each[1], n, np.frombuffer(bins, np.int32)) for row, n, bins in zip(*columns)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS), np.int64)
        for batch in batches:
            for p, u, _, bins in evidence(batch):
                some = np.unique(bins)
                counts[0, some] += p
                counts[1, some] += u
        some = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[0, some]), pa.array(counts[1, some])], ["bin", "p", "u"])

    held = sample.mapInArrow(counted, "bin int, p long, u long").groupBy("bin").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    held = held.where(F.col("p") >= LEAST).toArrow()  # at most BINS rows
    mine = supported(held.column("p").to_numpy(), held.column("u").to_numpy(), len(one_each[0]), len(one_each[1]))
    bearing = np.zeros(BINS, bool)
    bearing[held.column("bin").to_numpy()[mine]] = True

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, u, n, bins = zip(*evidence(batch)) if batch.num_rows else ((),) * 4
            few = pa.array([b[bearing[b]].tobytes() for b in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.bool_()), pa.array(u, pa.bool_()), pa.array(n, pa.int32()), few], ["p", "u", "n", "bins"])

    # what reaches the driver are the few bins that can bear weight
    got = [(r["p"], r["u"], r["n"], np.frombuffer(bytes(r["bins"]), np.int32)) for r in sample.mapInArrow(reduced, "p boolean, u boolean, n int, bins binary").collect()]
    got.sort(key=lambda r: (r[2], r[3].tobytes()))
    chosen = [[(n, bins) for *which, n, bins in got if which[i]] for i in (0, 1)]
    return ToxicityModel.fit([b for _, b in chosen[0]], [b for _, b in chosen[1]], prior, ([n for n, _ in chosen[0]], [n for n, _ in chosen[1]]))


def toxicity(model: ToxicityModel | None, text: Column) -> Column:
    """Score of a text column, 0 to 1."""
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer()
        for series in texts:
            yield series.map(score).astype(float)

    return run(text.cast("string"))


def scored(
    model: ToxicityModel | None, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.7
) -> DataFrame:
    """Each document's id, whether it is held out, its score and whether that reaches the threshold."""
    rows = docs.select(F.col(id_column).alias("doc_id"), toxicity(model, F.col(text_column)).alias("score"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
