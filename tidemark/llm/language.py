"""Language of a text by hierarchical discrimination: the family first, then pairs within it.

Features are hashed counts of one to three neighbouring UTF-8 bytes of the whole lower-cased text,
damped by a square root and brought to length one. A linear support vector machine for each family of
languages (one against the rest) picks the family; within it, one machine for each pair of languages
votes. Families group languages by descent; a language outside the list is a family of its own.

Training takes a bounded, documented sample of every language: at most ``per_language`` texts of each,
those whose id hashes lowest, from rows that are not held out. Where there are so many languages that this
would exceed ``sample`` texts, each gets its share of them, LEAST at least. Of rows that repeat an id and
language one counts. Everything else reads all rows.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and if nothing could be
learned; a null id is never held out nor trained on; each of several equal rows gets a row; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held_out

UNKNOWN = "und"
#: Hash bins of the features.
BINS = 1 << 12
#: Training texts that a language gets however many languages there are.
LEAST = 20
# Branches of descent by ISO 639-1 code.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "fo", "af", "lb", "fy", "yi"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "mk", "bg"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "ky", "uz", "tk", "tt"],
    "indic": ["hi", "bn", "ur", "mr", "ne", "gu", "pa", "si"],
    "semitic": ["ar", "he", "mt", "am"],
    "sinitic": ["zh", "yue"],
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}
# ASCII marks, digits and controls count as a space
_LETTERS = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def features(text: str) -> np.ndarray:
    """Hashed counts of byte n-grams of the whole text, of length one."""
    b = _LETTERS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
    b = b[keep]
    two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA6B)
    three = two[:-1] * np.uint32(0xC2B2AE35) + b[2:] * np.uint32(0x27D4EB2F)
    counts = np.bincount(two >> np.uint32(20), minlength=BINS) + np.bincount(three >> np.uint32(20), minlength=BINS)
    counts[:256] += np.bincount(b, minlength=256)
    x = np.sqrt(counts.astype(np.float32))
    return x / max(float(np.linalg.norm(x)), 1e-9)


def _margin_machine(x: np.ndarray, y: np.ndarray, rounds: int = 150, ridge: float = 1e-4) -> np.ndarray:
    """A linear machine on the squared hinge, classes weighted alike; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, speed = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for _ in range(rounds):
        ahead = w + 0.9 * speed
        gap = np.maximum(0, 1 - y * (x @ ahead))
        speed = 0.9 * speed + 0.5 * (x.T @ (weight * gap * y) - ridge * ahead)
        w = w + speed
    return w


@dataclass
class LanguageModel:
    """Weights of the family machines and of each pair of languages within a family."""

    families: dict[str, list[str]] = field(default_factory=dict)
    family_weights: np.ndarray | None = None
    pair_weights: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)
    sharpness: float = 4.0

    @classmethod
    def fit(cls, x: np.ndarray, languages: list[str]) -> LanguageModel:
        if not languages:
            return cls()
        labels = np.array(languages)
        families: dict[str, list[str]] = {}
        for code in sorted(set(languages)):
            families.setdefault(_FAMILY.get(code, code), []).append(code)
        of = np.array([_FAMILY.get(code, code) for code in languages])
        signs = [np.where(of == name, 1, -1).astype(np.float32) for name in families]
        model = cls(families, np.stack([_margin_machine(x, y) for y in signs]) if len(families) > 1 else None)
        for codes in families.values():
            for a, b in combinations(codes, 2):
                rows = (labels == a) | (labels == b)
                model.pair_weights[a, b] = _margin_machine(x[rows], np.where(labels[rows] == a, 1, -1).astype(np.float32))
        return model

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        x = np.append(features(text), np.float32(1))
        names, score = list(self.families), 1.0
        chosen = 0
        if self.family_weights is not None:
            margins = self.sharpness * (self.family_weights @ x)
            chosen = int(np.argmax(margins))
            score = float(1 / np.exp(margins - margins[chosen]).sum())
        codes = self.families[names[chosen]]
        if len(codes) == 1:
            return codes[0], score
        votes = dict.fromkeys(codes, 0.0)
        for a, b in combinations(codes, 2):
            first = float(1 / (1 + np.exp(-2 * self.sharpness * (self.pair_weights[a, b] @ x))))
            votes[a] += first
            votes[b] += 1 - first
        best = max(codes, key=lambda c: votes[c])
        return best, score * votes[best] / (len(codes) - 1)


def train(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", per_language: int = 400, sample: int = 12_000
) -> LanguageModel:
    """Fits the machines on the bounded sample of every language; its features are computed on the executors.

    The sample is chosen by ids and languages alone, so choosing it moves no text.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    usable = F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out("id")
    keys = rows.where(usable).select("id", "lang", F.xxhash64("id").alias("h")).distinct()
    sizes = {r["lang"]: r["count"] for r in keys.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return LanguageModel()
    each = min(per_language, max(LEAST, sample // len(sizes)))
    # hashes are spread evenly: those that can be among the lowest lie below four times the expected bound
    bounds = [(lang, min(1.0, 4 * each / n) * 2.0**64 - 2.0**63) for lang, n in sorted(sizes.items())]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound double"))
    lowest = Window.partitionBy("lang").orderBy("h", "id")
    near = keys.join(bounds, "lang").where(F.col("h").cast("double") <= F.col("bound"))
    chosen = near.withColumn("rank", F.row_number().over(lowest)).where(F.col("rank") <= each).select("id", "lang").collect()
    kind = rows.schema["id"].dataType.simpleString()
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(r["id"], r["lang"]) for r in chosen], f"id {kind}, lang string"))
    # of rows that repeat an id and language the text that hashes lowest; reduced in the tasks that read them
    texts = rows.where(usable).join(wanted, ["id", "lang"], "left_semi").groupBy("id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(lang, features(text)) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if has_letter(text)]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs]), pa.array([p[1].astype(np.float16).tobytes() for p in pairs])], ["lang", "x"])

    got = sorted((r["lang"], bytes(r["x"])) for r in texts.select("lang", "text").mapInArrow(vectors, "lang string, x binary").collect())
    if not got:
        return LanguageModel()
    return LanguageModel.fit(np.stack([np.frombuffer(x, np.float16) for _, x in got]).astype(np.float32), [lang for lang, _ in got])


def lettered(text: Column) -> Column:
    """Whether a text has a letter, by the same rule as the predictions."""

    @F.pandas_udf("boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield series.map(has_letter).astype(bool)

    return run(text.cast("string"))


def prediction(model: LanguageModel, text: Column) -> Column:
    """``lang_pred`` and ``score`` of a text column, as a struct."""

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            yield pd.DataFrame([model.predict(t) for t in series], columns=["lang_pred", "score"])

    return run(text.cast("string"))


def identify(model: LanguageModel, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each document's id, whether it is held out, its language and how sure that is."""
    rows = docs.select(F.col(id_column).alias("doc_id"), prediction(model, F.col(text_column)).alias("p"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "p.lang_pred", "p.score")
