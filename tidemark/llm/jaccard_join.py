"""Documents linked by the Jaccard similarity of their word shingles, with skipping by set relations.

Two sets of sizes a and b are linked if 100 times their overlap is at least ``percent`` times their union.
Then they share one of their first tokens in any common order (the prefix filter): rare ones go first, so
that a passage of very many documents stands last. How frequent a token is comes from a table of 2^18
counts over all documents; that estimate only orders the tokens and decides no link.

* **Stars first.** Sets that share one of a few minimal hashes, and about their size, are compared with one leader
  each, the one that a 512-bit signature shows to be nearest. A linked set lies on its leader's star.
* **Blocks of the index lists are skipped.** A token's list is sorted by group, size and position and cut
  into blocks; a block knows its least and greatest size, position and rest behind the token. From these
  follows whether any two sets of two blocks can be linked, and pairs of blocks that cannot are never read.
* **Answers are derived.** Sets of one group already reach each other, so a set takes over all links that
  its leader's star has found; pairs within a group, and pairs of blocks of one group, are skipped. For two
  stars the Jaccard distance of their leaders less both stars' radii bounds the distance of
  all members (it is a metric): one comparison settles all pairs of two stars. Only where it leaves a doubt are
  members compared, first the nearest pair of each two groups, and after joining these what is left.

Signatures hold the parity of the tokens that fall on each bit. Two sets differ in at least as many tokens
as their signatures differ in bits, so nothing linked is lost by them. Pairs that remain are compared by
signatures of as many bits as tokens, and those left then verified on their whole sets, read anew from the texts. Equal sets are one node throughout; a pair is never formed of two
copies. Tokens are 64-bit hashes of shingles, sets 128-bit digests of their tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, written
from tidemark.llm.components import components

#: Counts of the table that orders tokens by frequency.
BUCKETS = 1 << 18
#: Bits of a set's signature, held in longs of 64.
WORDS_OF_BITS = 8
#: Minimal hashes by which sets find a leader.
MINIMA = 4
#: Entries of one block of an index list.
BLOCK = 1024
#: Index lists up to this length are compared at once where they lie whole in a task.
SHORT = 32

_ODD = 0x9E3779B97F4A7C15
_SIGS = [f"s{i}" for i in range(WORDS_OF_BITS)]
_MINS = [f"m{i}" for i in range(MINIMA)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tokens(text: str | None, length: int = 3) -> np.ndarray:
    """Hashes of the text's distinct shingles, ascending: ``length`` words each, or all words if there are fewer.

    A-Z are lower-cased and words end at ASCII white space. A shingle's hash is a sum of its words' hashes,
    each times an odd number of its place.
    """
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(length, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for i, factor in enumerate(np.cumprod(np.full(width, _ODD, np.uint64))):
        total += hashes[i : i + n] * factor
    return np.unique(_mixed(total))


def _signature(found: np.ndarray) -> np.ndarray:
    places = (found >> np.uint64(20)) & np.uint64(64 * WORDS_OF_BITS - 1)
    bits = np.bincount(places.astype(np.int64), minlength=64 * WORDS_OF_BITS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _wide(found: np.ndarray) -> bytes:
    """The same with at least as many bits as tokens: it tells large sets apart too."""
    bits = 1 << max(6, (len(found) - 1).bit_length())
    places = (found >> np.uint64(20)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(places.astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def wide_apart(one: bytes, two: bytes) -> int:
    """In how many bits two wide signatures differ, the longer one folded to the shorter."""
    x, y = sorted((np.frombuffer(s, np.uint8) for s in (one, two)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _digest(found: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(found.tobytes())


_SETS = "doc_id long, key long, digest binary, n int, " + "".join(f"{c} long, " for c in [*_SIGS, *_MINS]) + "wide binary, bucket int, count long"


def sets(rows: DataFrame, length: int) -> DataFrame:
    """A row for each document, and a row for each count of a task's tokens by bucket (``bucket`` is not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        names = [c.split()[0] for c in _SETS.split(", ")]
        for batch in batches:
            n = batch.num_rows
            digests, wide, sizes, held = [], [], np.zeros(n, np.int32), []
            longs = np.zeros((n, WORDS_OF_BITS + MINIMA), np.int64)
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = tokens(text, length)
                sizes[i] = len(found)
                digests.append(_digest(found))
                wide.append(_wide(found))
                if len(found):
                    held.append((found & np.uint64(BUCKETS - 1)).astype(np.int32))
                    longs[i, :WORDS_OF_BITS] = _signature(found)
                    longs[i, WORDS_OF_BITS:] = np.resize(found[:MINIMA], MINIMA).view(np.int64)
                if len(held) >= 1000:
                    counts += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held = []
            if held:
                counts += np.bincount(np.concatenate(held), minlength=BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(sizes)]
                + [pa.array(longs[:, i].copy()) for i in range(longs.shape[1])]
                + [pa.array(wide, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                names,
            )
        used = np.flatnonzero(counts)
        empty = [pa.nulls(len(used), t) for t in [pa.int64(), pa.int64(), pa.binary(), pa.int32()] + [pa.int64()] * (WORDS_OF_BITS + MINIMA) + [pa.binary()]]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(used.astype(np.int32)), pa.array(counts[used])], names)

    return rows.select("doc_id", "key", "text").mapInArrow(run, _SETS)


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """How many tokens sets of these sizes share at least, if they are linked."""
    return F.ceil((a + b) * percent / F.lit(100 + percent) - 1e-9)


def _apart(left: str, right: str) -> Column:
    """In how many bits two signatures differ."""
    total = F.lit(0)
    for s in _SIGS:
        total = total + F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}")))
    return total


def _linkable(a: Column, b: Column, apart: Column, percent: int) -> Column:
    """False only for two sets that sizes and signatures show not to be linked."""
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (apart <= a + b - 2 * least_overlap(a, b, percent))


def not_far(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``x, y`` of nodes that wide signatures do not show to be unlinked."""
    used = pairs.select(F.col("x").alias("nid")).union(pairs.select("y")).distinct()
    seen = nodes.select("nid", "digest", "n").join(used, "nid", "left_semi").join(rows.select("digest", "wide"), "digest")
    seen = seen.select("nid", "n", "wide").dropDuplicates(["nid"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            apart = np.array([wide_apart(s, t) for s, t in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())], np.int64)
            near = apart <= size - 2 * -(-percent * size // (100 + percent))
            yield batch.select(["x", "y"]).filter(pa.array(near))

    joined = pairs.join(seen.toDF("x", "n", "one"), "x").join(seen.toDF("y", "m", "two"), "y")
    return joined.select("x", "y", "n", "m", "one", "two").mapInArrow(compare, "x long, y long")


def verified(
    pairs: DataFrame, nodes: DataFrame, rows: DataFrame, texts: DataFrame, folder: str, name: str, length: int, percent: int
) -> DataFrame:
    """Those of the pairs ``x, y`` of nodes that are linked, with the overlap of their whole sets.

    Only the texts that the pairs need are read again and make the way to other tasks.
    """
    pairs = written(not_far(pairs, nodes, rows, percent), f"{folder}/{name}-near")
    used = pairs.select(F.col("x").alias("nid")).union(pairs.select("y")).distinct()
    wanted = written(nodes.join(used, "nid", "left_semi").select("key"), f"{folder}/{name}-wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()  # copies within a task are read once
        for batch in batches:
            digests, held, size = [], [], 0
            for text in batch.column(0).to_pylist():
                found = tokens(text, length)
                digest = _digest(found)
                if digest in done:
                    continue
                done.add(digest)
                digests.append(digest)
                held.append(found.tobytes())
                size += len(held[-1])
                if size > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(held, pa.binary())], ["digest", "tokens"])
                    digests, held, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(held, pa.binary())], ["digest", "tokens"])

    read = texts.join(wanted.distinct(), "key", "left_semi").select("text").mapInArrow(cut, "digest binary, tokens binary")
    named = nodes.select("nid", "digest").join(used, "nid", "left_semi")
    found = written(read.dropDuplicates(["digest"]).join(named, "digest").select("nid", "tokens"), f"{folder}/{name}-sets")

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, a, b = (c.to_pylist() for c in batch.columns)
            out = []
            for s, t in zip(a, b):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(s) + len(t) - len(np.union1d(s, t))
                out.append((len(s), len(t), both))
            size, other, both = np.array(out, np.int64).reshape(-1, 3).T
            linked = 100 * both >= percent * (size + other - both)
            columns = [pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(both), pa.array(size + other - both)]
            yield pa.RecordBatch.from_arrays(columns, ["x", "y", "shared", "total"]).filter(pa.array(linked))

    one, two = found.toDF("x", "a"), found.toDF("y", "b")
    joined = pairs.select("x", "y").join(one, "x").join(two, "y").select("x", "y", "a", "b")
    return written(joined.mapInArrow(overlap, "x long, y long, shared long, total long"), f"{folder}/{name}")


def _grouped(nodes: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """``nid, root``: the smallest node that each node reaches over the links."""
    roots = components(links.select(F.col("x").alias("u"), F.col("y").alias("v")), folder).toDF("nid", "root")
    return nodes.select("nid").join(roots, "nid", "left").select("nid", F.coalesce("root", "nid").alias("root"))


def stars(nodes: DataFrame, rows: DataFrame, texts: DataFrame, folder: str, length: int, percent: int) -> DataFrame:
    """``nid, leader, radius``: the nearest leader of each set that is linked with one; others lead themselves."""
    keyed = nodes.select("nid", F.array_distinct(F.array(*_MINS)).alias("m"), F.floor(F.log("n") * 10).alias("band"))
    keyed = keyed.select("nid", F.explode("m").alias("m"), "band")
    first = keyed.groupBy("m", "band").agg(F.min(F.struct(F.xxhash64("nid", "m").alias("h"), "nid")).alias("f"), F.count(F.lit(1)).alias("c"))
    first = first.where("c > 1").select("m", "band", F.col("f.nid").alias("y"))
    pairs = keyed.join(first, ["m", "band"]).where("nid <> y").select(F.col("nid").alias("x"), "y").distinct()
    seen = nodes.select("nid", "n", *_SIGS)
    apart = _apart("a", "b")
    near = (
        pairs.join(seen.alias("a"), F.col("x") == F.col("a.nid"))
        .join(seen.alias("b"), F.col("y") == F.col("b.nid"))
        .where(_linkable(F.col("a.n"), F.col("b.n"), apart, percent))
        .groupBy("x")
        .agg(F.min(F.struct(apart.alias("apart"), "y")).alias("best"))
    )
    chosen = written(near.select("x", F.col("best.y").alias("y")), f"{folder}/leaders")
    return verified(chosen, nodes, rows, texts, folder, "stars", length, percent)


def postings(texts: DataFrame, counts: np.ndarray, length: int, percent: int) -> DataFrame:
    """``digest, n, prefix`` of each set: its first tokens, rarest first; copies within a task leave it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                found = tokens(text, length)
                digest = _digest(found)
                if not len(found) or digest in done:
                    continue
                done.add(digest)
                order = np.lexsort((found, counts[(found & np.uint64(BUCKETS - 1)).astype(np.int64)]))
                size = len(found) - -(-percent * len(found) // 100) + 1
                out.append((digest, len(found), found[order[:size]].tobytes()))
            if out:
                digests, sizes, held = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(held, pa.binary())], ["digest", "n", "prefix"]
                )

    return texts.select("text").mapInArrow(run, "digest binary, n int, prefix binary")


_ENTRY = "token long, root long, n int, pos int, leader long"
_FIELDS = [("root", np.int64), ("n", np.int32), ("pos", np.int32), ("leader", np.int64)]
_LISTED = "x long, y long, token long, root long, n int, pos int, leader long"
#: An entry of a block: a star with one member's size and position, and its leader's size, radius and signature.
_HELD = np.dtype(
    [("id", "<i8"), ("root", "<i8"), ("n", "<i4"), ("pos", "<i4"), ("size", "<i4"), ("radius", "<f8"), ("sig", "<u8", WORDS_OF_BITS)]
)
_BLOCKS = "key long, block string, root long, least int, most int, late int, rest int, held binary"


def _opened(rows: DataFrame) -> DataFrame:
    """One row for each token of a prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            root, leader, n = (batch.column(i).to_numpy() for i in range(3))
            held = batch.column(3).to_pylist()
            start = 0
            while start < len(held):
                stop, size = start, 0
                while stop < len(held) and size < 1 << 21:
                    size += len(held[stop])
                    stop += 1
                width = np.array([len(h) // 8 for h in held[start:stop]], np.int64)
                found = np.frombuffer(b"".join(held[start:stop]), np.int64)
                pos = np.arange(len(found)) - np.repeat(np.cumsum(width) - width, width)
                again = lambda c: pa.array(np.repeat(c[start:stop], width))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), again(root), again(n), pa.array(pos.astype(np.int32)), again(leader)], [c.split()[0] for c in _ENTRY.split(", ")]
                )
                start = stop

    return rows.select("root", "leader", "n", "prefix").mapInArrow(run, _ENTRY)


def _possible(one: dict[str, np.ndarray], two: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Whether entries of one list can be linked, by group, size and what can still follow their positions."""
    a, b = one["n"].astype(np.int64), two["n"].astype(np.int64)
    need = -(-percent * (a + b) // (100 + percent))
    most = np.minimum(one["pos"], two["pos"]) + 1 + np.minimum(a - one["pos"], b - two["pos"]) - 1
    fits = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    return (one["root"] != two["root"]) & (one["leader"] != two["leader"]) & fits & (most >= need)


def _pairs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
    return found[:, 0], found[:, 1]


def listed(entries: DataFrame, percent: int, short: int = SHORT) -> DataFrame:
    """From entries in list order: pairs of stars from short lists, and the entries of all others.

    A list that reaches the edge of a task may go on in the next one, so its entries are handed on too.
    """
    fields, names = [c.split()[0] for c in _ENTRY.split(", ")], [c.split()[0] for c in _LISTED.split(", ")]

    def handed_on(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        none = pa.nulls(len(rows["n"]), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, *[pa.array(rows[f]) for f in fields]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = True, None  # whether the list at the front may have begun in another task
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {f: batch.column(i).to_numpy() for i, f in enumerate(fields)}
            if held is not None:
                rows = {f: np.concatenate([held[f], rows[f]]) for f in fields}
            token = rows["token"]
            starts = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1])
            sizes = np.diff(np.append(starts, len(token)))
            long = sizes > short
            long[0] |= first
            if long[-1]:  # goes on as entries, whatever follows
                first, last = True, len(token)
            else:
                first, last = False, starts[-1]
            some = np.repeat(long, sizes)
            yield handed_on({f: rows[f][some] for f in fields})
            some = ~some
            some[last:] = False
            kept = np.flatnonzero(some)
            xs, ys = [], []
            for step in range(1, short):
                a, b = kept[:-step], kept[step:]
                same = token[a] == token[b]
                if not same.any():
                    break
                a, b = a[same], b[same]
                good = _possible({f: rows[f][a] for f in fields}, {f: rows[f][b] for f in fields}, percent)
                xs.append(rows["leader"][a[good]])
                ys.append(rows["leader"][b[good]])
            if xs:
                x, y = _pairs(np.concatenate(xs), np.concatenate(ys))
                columns = [pa.array(x), pa.array(y), *[pa.nulls(len(x), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())]]
                yield pa.RecordBatch.from_arrays(columns, names)
            held = {f: rows[f][last:] for f in fields}
        if held is not None and len(held["n"]):
            yield handed_on(held)

    return entries.mapInArrow(run, _LISTED)


def blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of one ``key`` each, in the order of the rows. Rows are ``key`` and the fields of an entry.

    Ranges of rows are dealt to tasks, so a key of very many rows is cut among them.
    """
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    fields = ["id", "root", "n", "pos", "size", "radius"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, keys, held = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64), np.zeros(0, _HELD)

        def cut(keys: np.ndarray, held: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            out, start = [], 0
            for end in ends.tolist():
                part = held[start:end]
                n, root = part["n"], part["root"]
                one_root = int(root[0]) if (root == root[0]).all() else None
                number += 1
                rest = int((n - part["pos"]).max()) - 1
                out.append((int(keys[start]), f"{task:08d}-{number:010d}", one_root, int(n.min()), int(n.max()), int(part["pos"].max()), rest, part.tobytes()))
                start = end
            types = [pa.int64(), pa.string(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names)

        for batch in batches:
            new = np.zeros(batch.num_rows, _HELD)
            for i, f in enumerate(fields, 1):
                new[f] = batch.column(i).to_numpy()
            for i in range(WORDS_OF_BITS):
                new["sig"][:, i] = batch.column(7 + i).to_numpy().view(np.uint64)
            keys, held = np.concatenate([keys, batch.column(0).to_numpy()]), np.concatenate([held, new])
            change = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
            within = np.concatenate([np.append(np.arange(a + block, b, block), b) for a, b in zip(np.append(0, change[:-1]), change)])
            ends = within[:-1]  # the last block may go on
            yield cut(keys, held, ends)
            last = ends[-1] if len(ends) else 0
            keys, held = keys[last:], held[last:]
        if len(keys):
            yield cut(keys, held, np.array([len(keys)]))

    in_order = ["key", "root", "n", "pos", "id"]
    chosen = rows.select("key", *fields, *_SIGS).repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    return chosen.mapInArrow(run, _BLOCKS)


def _near(one: np.ndarray, two: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of two blocks of one list whose stars may hold linked members."""
    views = [{"root": e["root"], "leader": e["id"], "n": e["n"], "pos": e["pos"]} for e in (one, two)]
    good = _possible({f: v[:, None] for f, v in views[0].items()}, {f: v[None, :] for f, v in views[1].items()}, percent)
    r, s = np.nonzero(good)
    apart = _bits_apart(one, r, two, s)
    least = 2 * apart / (one["size"][r] + two["size"][s] + apart)
    near = least <= 1 - percent / 100 + one["radius"][r] + two["radius"][s] + 1e-9
    return r[near], s[near]


def _linked_at_most(one: np.ndarray, two: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members of two blocks that may be linked, of different groups, and how far their signatures are apart."""
    a, b = one["n"][:, None].astype(np.int64), two["n"][None, :].astype(np.int64)
    r, s = np.nonzero((one["root"][:, None] != two["root"][None, :]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b)))
    apart = _bits_apart(one, r, two, s)
    both = one["n"][r].astype(np.int64) + two["n"][s]
    near = apart <= both - 2 * -(-percent * both // (100 + percent))
    return r[near], s[near], apart[near]


def _bits_apart(one: np.ndarray, r: np.ndarray, two: np.ndarray, s: np.ndarray) -> np.ndarray:
    out = np.zeros(len(r), np.int64)
    for start in range(0, len(r), 1 << 17):
        some = slice(start, start + (1 << 17))
        out[some] = np.bitwise_count(one["sig"][r[some]] ^ two["sig"][s[some]]).sum(1, dtype=np.int64)
    return out


def list_pairs(cut: DataFrame, percent: int) -> DataFrame:
    """``x, y``: near stars of one list. Pairs of blocks that cannot hold any are skipped."""
    a, b, c = cut.alias("a"), cut.alias("b"), F.col
    fits = (c("a.most") * 100 >= c("b.least") * percent) & (c("b.most") * 100 >= c("a.least") * percent)
    reach = F.least("a.late", "b.late") + 1 + F.least("a.rest", "b.rest")
    joined = a.join(
        b,
        (c("a.key") == c("b.key"))
        & (c("a.block") <= c("b.block"))
        & ~F.coalesce(c("a.root") == c("b.root"), F.lit(False))
        & fits
        & (reach >= least_overlap(c("a.least"), c("b.least"), percent)),
    ).select(c("a.held").alias("one"), c("b.held").alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = (np.frombuffer(batch.column(j)[i].as_py(), _HELD) for j in (0, 1))
                r, s = _near(one, two, percent)
                x, y = _pairs(one["id"][r], two["id"][s])
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    return joined.mapInArrow(run, "x long, y long")


def near_stars(pairs: DataFrame, leads: DataFrame, percent: int) -> DataFrame:
    """Those pairs of stars whose leaders are not too far apart for any two members to be linked."""
    apart = _apart("a", "b")
    least = 2 * apart / (F.col("a.size") + F.col("b.size") + apart)
    joined = pairs.join(leads.alias("a"), F.col("x") == F.col("a.id")).join(leads.alias("b"), F.col("y") == F.col("b.id"))
    return joined.where(least <= 1 - percent / 100 + F.col("a.radius") + F.col("b.radius") + 1e-9).select("x", "y")


_CLOSE = "x long, y long, r long, s long, apart long"


def member_pairs(pairs: DataFrame, members: DataFrame, percent: int, folder: str, name: str, block: int, nearest: bool) -> DataFrame:
    """``x, y, r, s, apart``: members of near stars that may be linked, with their groups r < s, which differ.

    Members are compared block by block; with ``nearest``, two blocks give the nearest pair of each two groups.
    """
    used = pairs.select(F.col("x").alias("key")).union(pairs.select("y")).distinct()
    rows = members.select(F.col("leader").alias("key"), F.col("nid").alias("id"), "root", "n", F.lit(0).alias("pos"), F.col("n").alias("size"), "radius", *_SIGS)
    cut = written(blocks(written(rows.join(used, "key", "left_semi"), f"{folder}/{name}-members"), block), f"{folder}/{name}-blocks")
    one, two = cut.select(F.col("key").alias("x"), F.col("held").alias("one")), cut.select(F.col("key").alias("y"), F.col("held").alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(j)[i].as_py(), _HELD) for j in (0, 1))
                r, s, apart = _linked_at_most(a, b, percent)
                if not len(r):
                    continue
                x, y, rx, ry = a["id"][r], b["id"][s], a["root"][r], b["root"][s]
                found = np.stack([x, y, np.minimum(rx, ry), np.maximum(rx, ry), apart], axis=1)
                if nearest:
                    found = found[np.lexsort((found[:, 1], found[:, 0], found[:, 4], found[:, 3], found[:, 2]))]
                    new = np.append(True, (found[1:, 2:4] != found[:-1, 2:4]).any(1))
                    found = found[new]
                out.append(found)
            rows = np.concatenate(out) if out else np.zeros((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T.copy()], [c.split()[0] for c in _CLOSE.split(", ")])

    return pairs.join(one, "x").join(two, "y").select("one", "two").mapInArrow(run, _CLOSE)


def linked(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 3,
    percent: int = 90,
    block: int = BLOCK,
    short: int = SHORT,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest document id that links lead to, the document's own included. Null, empty
    and blank texts have no shingles and are linked with nothing, so theirs is their own id. A null id stays, its
    text links like any other, and it is never the smallest; a component of null ids alone has a null id.
    Repeated rows are linked by their equal sets. An empty table gives no rows; other columns are ignored.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent has to be above 50 and at most 100")
    spark = docs.sparkSession
    folder = scratch(spark)
    text = F.col(text_column).cast("string")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    first = written(sets(texts, length), f"{folder}/sets")
    rows = first.where("bucket IS NULL")
    counts = np.zeros(BUCKETS, np.int64)
    found = first.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("count").alias("count")).toArrow()  # BUCKETS rows at most
    counts[found.column("bucket").to_numpy()] = found.column("count").to_numpy()

    same = ["n", *_SIGS, *_MINS]  # equal for equal sets
    distinct = rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), *[F.max(c).alias(c) for c in same])
    numbered = written(distinct, f"{folder}/distinct").withColumn("nid", F.monotonically_increasing_id())
    nodes = written(numbered, f"{folder}/nodes")

    on_stars = stars(nodes, rows, texts, folder, length, percent)
    groups = _grouped(nodes, on_stars, f"{folder}/grouped-0")
    led = on_stars.select(F.col("x").alias("nid"), F.col("y").alias("leader"), (1 - F.col("shared") / F.col("total")).alias("radius"))
    members = nodes.join(groups, "nid").join(led, "nid", "left")
    members = members.withColumns({"leader": F.coalesce("leader", "nid"), "radius": F.coalesce("radius", F.lit(0.0))})
    members = written(members.select("nid", "digest", "leader", "root", "radius", "n", *_SIGS), f"{folder}/members")

    prefixes = postings(texts.where(F.col("text").isNotNull()), counts, length, percent).dropDuplicates(["digest"])
    placed = prefixes.drop("n").join(members.select("digest", "leader", "root", "n"), "digest")
    entries = written(_opened(placed), f"{folder}/entries")
    in_order = ["token", "root", "n", "pos", "leader"]
    lists = written(listed(entries.repartitionByRange(*in_order).sortWithinPartitions(*in_order), percent, short), f"{folder}/lists")
    radius = members.groupBy("leader").agg(F.max("radius").alias("radius"))
    leads = members.select(F.col("nid").alias("id"), F.col("n").alias("size"), *_SIGS).join(radius.withColumnRenamed("leader", "id"), "id")
    long_lists = lists.where("x IS NULL").select(F.col("token").alias("key"), "root", "n", "pos", F.col("leader").alias("id"))
    cut = written(blocks(written(long_lists.join(leads, "id"), f"{folder}/long"), block), f"{folder}/blocks")
    short_lists = near_stars(lists.where("x IS NOT NULL").select("x", "y").distinct(), leads, percent)
    near = written(short_lists.unionByName(list_pairs(cut, percent)).distinct(), f"{folder}/near")

    first = member_pairs(near, members, percent, folder, "first", block, True).groupBy("r", "s")
    tried = written(first.agg(F.min(F.struct("apart", "x", "y")).alias("best")).select("best.x", "best.y"), f"{folder}/tried")
    links = on_stars.unionByName(verified(tried, nodes, rows, texts, folder, "more", length, percent))
    groups = _grouped(nodes, links, f"{folder}/grouped-1")
    regrouped = members.drop("root").join(groups, "nid")
    rest = member_pairs(near, regrouped, percent, folder, "second", block, False).select("x", "y").distinct().join(tried, ["x", "y"], "left_anti")
    links = links.unionByName(verified(written(rest, f"{folder}/rest"), nodes, rows, texts, folder, "last", length, percent))
    groups = _grouped(nodes, links, f"{folder}/grouped-2")

    smallest = nodes.join(groups, "nid")
    least = smallest.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = smallest.select("digest", "root").join(least, "root").select("digest", "component_id")
    with_set = rows.where("n > 0").join(labels, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return with_set.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))).withColumn(
        "n_shingles", F.col("n_shingles").cast("long")
    )


#: The join of table documents, in DuckDB SQL; its ids are taken to be unique.
LINKED_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) END)) AS s FROM words),
classes AS MATERIALIZED (SELECT min(doc_id) AS id, s, len(s) AS n FROM shingles WHERE len(s) > 0 GROUP BY s),
tokens AS MATERIALIZED (SELECT id, n, unnest(s) AS token FROM classes),
links AS MATERIALIZED (SELECT a.id AS u, b.id AS v FROM tokens a JOIN tokens b ON a.token = b.token AND a.id <> b.id
    AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached AS (SELECT id, id AS other FROM classes UNION SELECT r.id, l.v FROM reached r JOIN links l ON r.other = l.u),
smallest AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
FROM shingles d LEFT JOIN classes c ON d.s = c.s LEFT JOIN smallest m ON c.id = m.id
"""
