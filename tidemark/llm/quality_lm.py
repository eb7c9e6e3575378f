"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Symbols are UTF-8 bytes, so the model knows every text and an n-gram of up to seven is one number. The
counts of the longest n-grams are raw, those of shorter ones are numbers of different left neighbours.
Each length has three discounts from its own counts of counts. All of that is joins and sums of count
tables that Spark partitions by n-gram or context; the discounts alone reach the driver.

To score, the model is dealt to shards by the last two bytes of the context: an n-gram, its shorter
forms and their contexts are then in one shard (those of at most two bytes, 65,792 rows at most, are in
all). The number of shards follows from a bound on a shard's rows, so what a task holds is bounded
whatever the model's size. Each shard scores the positions that fall to it, over whole texts; a
document's perplexity comes from the sum. No document text is shuffled.

A document is kept if its adjusted perplexity is at most its language's threshold: a quantile over the
trusted texts of that language which were held out from training, or of all languages where there are none.
Adjusted means as if SHORT more bytes of that language's usual text stood beside it, so that a few odd bytes
neither set a threshold nor fail it. SHORT and the quantile were chosen on a validation third of the training
fold of table sf0.1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, scratch, written

#: Bytes of text that one step of a task looks at.
STEP = 1 << 20
#: Bytes of usual text that stand beside each text when it is compared with a threshold.
SHORT = 50


def grams(text: bytes, order: int) -> np.ndarray:
    """The n-gram that ends at each byte, as a number; zero bytes stand before the text."""
    symbols = np.frombuffer(bytes(order - 1) + text, np.uint8).astype(np.int64)
    out = np.zeros(len(text), np.int64)
    for i in range(order):
        out = out << 8 | symbols[i : i + len(text)]
    return out


def counts(texts: DataFrame, order: int) -> DataFrame:
    """``gram, n``: how often each n-gram of the full length occurs in column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held])
            found, place = np.unique(keys, return_inverse=True)
            return found, np.bincount(place, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        def pieces() -> Iterator[np.ndarray]:
            for batch in batches:
                step: list[np.ndarray] = []
                for text in batch.column(0).to_pylist():
                    step.append(grams((text or "").encode(), order))
                    if sum(map(len, step)) >= STEP:
                        yield np.concatenate(step)
                        step = []
                if step:
                    yield np.concatenate(step)

        for piece in pieces():
            held.append(np.unique(piece, return_counts=True))
            if len(held) == 16:
                held[:] = [merged()]
                if len(held[0][0]) > 2 * STEP:  # memory stays bounded; the sum below joins the parts
                    yield _two(*held.pop())
        if held:
            yield _two(*merged())

    return texts.select(F.col("text").cast("string")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _two(gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], ["gram", "n"])


def _discounts(table: DataFrame) -> list[float]:
    """The discounts of counts 1, 2 and 3 or more, from the counts of counts."""
    row = table.agg(*[F.sum(F.when(F.col("n") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n = [float(row[f"n{i}"] or 0) for i in (1, 2, 3, 4)]
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.9]  # too little text for estimates
    y = n[0] / (n[0] + 2 * n[1])
    found = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0.0 for i in range(3)]
    return [min(max(d, 0.1), i + 0.95) for i, d in enumerate(found)]


def _discount(n: Column, d: list[float]) -> Column:
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def estimate(full: DataFrame, order: int, folder: str) -> DataFrame:
    """The model as a table: ``size, gram, logp`` and, for contexts, ``size, gram, back``.

    A row of kind ``p`` holds log P of a gram's last byte behind the others; one of kind ``b`` the log of
    the weight that a context of ``size - 1`` bytes leaves to shorter ones.
    """
    tables = {order: full}
    for size in range(order - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1))
        tables[size] = written(tables[size + 1].select(shorter.alias("gram")).groupBy("gram").agg(F.count("*").alias("n")), f"{folder}/counts-{size}")
    rows, below = None, None
    for size in range(1, order + 1):
        d = _discounts(tables[size])
        seen = tables[size].withColumn("context", F.shiftright("gram", 8))
        contexts = seen.groupBy("context").agg(F.sum("n").alias("total"), F.sum(_discount(F.col("n"), d)).alias("left"))
        contexts = contexts.select("context", "total", (F.col("left") / F.col("total")).alias("weight"))
        joined = seen.join(contexts, "context")
        own = (F.col("n") - _discount(F.col("n"), d)) / F.col("total")
        if below is None:
            p = joined.select("gram", (own + F.col("weight") / 256).alias("p"))
        else:
            shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1)).alias("shorter")
            p = joined.select("gram", own.alias("own"), "weight", shorter).join(below, "shorter")
            p = p.select("gram", (F.col("own") + F.col("weight") * F.col("q")).alias("p"))
        p = written(p, f"{folder}/p-{size}")
        below = p.select(F.col("gram").alias("shorter"), F.col("p").alias("q"))
        part = p.select(F.lit(size).alias("size"), F.lit("p").alias("kind"), "gram", F.log("p").alias("value"))
        part = part.unionByName(contexts.select(F.lit(size).alias("size"), F.lit("b").alias("kind"), F.col("context").alias("gram"), F.log("weight").alias("value")))
        rows = part if rows is None else rows.unionByName(part)
    return written(rows, f"{folder}/model")


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


class Lookup:
    """Numbers to values: an open hash table in two arrays, searched for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.float32)
        left, slot = np.arange(len(keys)), _slot(keys, self.bits)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]  # of several the last stays
            won = self.keys[slot] == keys[left]
            self.values[slot[won]] = values[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and whether each key is there."""
        slot = _slot(keys, self.bits)
        at = self.keys[slot]
        out, there = self.values[slot], at == keys
        left = np.flatnonzero(~there & (at != -1))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot]
            hit = at == keys[left]
            out[left[hit]], there[left[hit]] = self.values[slot[hit]], True
            on = ~hit & (at != -1)
            left, slot = left[on], slot[on]
        return out, there


@dataclass
class Shard:
    """One shard's tables: of grams and of contexts, by size."""

    order: int
    number: int
    shards: int
    grams: dict[int, Lookup]
    contexts: dict[int, Lookup]

    def score(self, text: bytes) -> float:
        """Sum of log P over the positions of the text that fall to this shard."""
        left = grams(text, self.order)
        if self.shards > 1:
            left = left[_slot(left >> 8 & 0xFFFF, 32) % self.shards == self.number]
        total = 0.0
        for size in range(self.order, 0, -1):
            if not len(left):
                return total
            keys = left & ((1 << 8 * size) - 1)
            value, there = self.grams[size].find(keys)
            total += float(value[there].sum(dtype=np.float64))
            left, keys = left[~there], keys[~there]
            back, known = self.contexts[size].find(keys >> 8)
            total += float(back[known].sum(dtype=np.float64))
        return total - len(left) * log(256)


def shards_of(model: DataFrame, order: int, max_rows: int) -> Iterator[Shard]:
    """The model's shards one after another, each of about ``max_rows`` rows at most.

    Rows are dealt by the last two bytes of their context; the driver holds one shard at a time.
    """
    shards = max(1, -(-model.count() // max_rows))
    context = F.when(F.col("kind") == "p", F.shiftright("gram", 8)).otherwise(F.col("gram"))
    keyed = model.withColumn("key", context.bitwiseAND(F.lit(0xFFFF))) if shards > 1 else model.withColumn("key", F.lit(0))
    for number in range(shards):
        rows = keyed
        if shards > 1:
            every = np.arange(1 << 16)
            mine = every[_slot(every, 32) % shards == number].tolist()
            keys = model.sparkSession.createDataFrame([(k,) for k in mine], "key long")
            rows = keyed.where("size <= 2").unionByName(keyed.where("size > 2").join(keys, "key", "left_semi"))
        table = rows.select("size", "kind", "gram", "value").toArrow()
        size, kind = table.column("size").to_numpy(), table.column("kind").to_numpy()
        gram, value = table.column("gram").to_numpy(), table.column("value").to_numpy()
        pick = lambda k, s: Lookup(gram[(kind == k) & (size == s)], value[(kind == k) & (size == s)])
        sizes = range(1, order + 1)
        yield Shard(order, number, shards, {s: pick("p", s) for s in sizes}, {s: pick("b", s) for s in sizes})


def log_probabilities(model: DataFrame, docs: DataFrame, order: int, max_rows: int) -> DataFrame:
    """``doc_id, lang, n_bytes, logp`` of every row of ``doc_id, lang, text``."""
    context, parts = docs.sparkSession.sparkContext, []
    for shard in shards_of(model, order, max_rows):
        held = context.broadcast(shard)  # at most max_rows rows and those of two bytes

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(3), pa.array(map(len, texts), pa.int64()), pa.array(map(held.value.score, texts), pa.float64())],
                    ["doc_id", "lang", "h", "n_bytes", "logp"],
                )

        rows = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("h"))
        parts.append(rows.mapInArrow(run, "doc_id long, lang string, h long, n_bytes long, logp double"))
    if len(parts) == 1:
        return parts[0].drop("h")
    # equal rows add up alike: their sum is dealt to so many rows again
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    copies = (F.count("*") / len(parts)).cast("int").alias("copies")
    summed = together.groupBy("doc_id", "lang", "h", "n_bytes").agg(F.sum("logp").alias("logp"), copies)
    one = summed.withColumn("logp", F.col("logp") / F.col("copies")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return one.select("doc_id", "lang", "n_bytes", "logp")


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    label_column: str = "quality",
    order: int = 5,
    quantile: float = 0.99,
    max_rows: int = 4_000_000,
) -> DataFrame:
    """Each document's perplexity per byte and whether it is kept: ``doc_id, lang, n_bytes, perplexity, adjusted, threshold, keep``.

    Trusted text is that of the documents labelled 1. Null and empty texts have no perplexity and are
    not kept. A null language takes the threshold of all. A null id has no label; each of several equal
    rows gets a row; without trusted text nothing can be told, so every text is kept with a null
    threshold; an empty table gives no rows; other columns are ignored.
    """
    if not 2 <= order <= 7:
        raise ValueError("order has to lie between 2 and 7")
    folder = scratch(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text")
    )
    trusted = labels.where(F.col(label_column) == 1).select(F.col(id_column).cast("long").alias("doc_id")).distinct()
    # the labels grow with the documents, so their ids are joined by a shuffle at every size
    trained = rows.where(~held_out("doc_id")).join(trusted.hint("merge"), "doc_id", "left_semi")
    full = written(counts(trained, order), f"{folder}/counts-{order}")
    model = estimate(full, order, folder)
    scored = written(log_probabilities(model, rows, order, max_rows), f"{folder}/scored")
    perplexity = F.when(F.col("n_bytes") > 0, F.exp(-F.col("logp") / F.col("n_bytes")))
    scored = scored.select("doc_id", "lang", "n_bytes", "logp", perplexity.alias("perplexity"))
    usual = -F.sum("logp") / F.sum("n_bytes")
    held = scored.where(held_out("doc_id") & F.col("perplexity").isNotNull()).join(trusted, "doc_id", "left_semi")
    learned = bool(full.limit(1).count())
    usual_of_all = held.agg(usual.alias("usual")).first()["usual"] if learned else None
    usual_by_lang = held.where("lang IS NOT NULL").groupBy("lang").agg(usual.alias("usual"))

    def adjusted(rows: DataFrame) -> DataFrame:
        mean = F.coalesce("usual", F.lit(usual_of_all).cast("double"))
        value = F.exp((F.lit(SHORT) * mean - F.col("logp")) / (F.col("n_bytes") + SHORT))
        rows = rows.join(F.broadcast(usual_by_lang), "lang", "left")  # a row a language, so no common one meets in a task
        return rows.withColumn("adjusted", F.when(F.col("perplexity").isNotNull(), F.coalesce(value, "perplexity")))

    held = adjusted(held)
    cut = F.percentile_approx("adjusted", quantile, 10000).alias("threshold")
    by_lang = held.where("lang IS NOT NULL").groupBy("lang").agg(cut)
    of_all = held.agg(cut).first()["threshold"] if learned else None
    joined = adjusted(scored).join(F.broadcast(by_lang), "lang", "left")
    threshold = F.coalesce("threshold", F.lit(of_all).cast("double"))
    keep = F.col("perplexity").isNotNull() & F.coalesce(F.col("adjusted") <= threshold, F.lit(True))
    return joined.select("doc_id", "lang", "n_bytes", "perplexity", "adjusted", threshold.alias("threshold"), keep.alias("keep"))
