"""Where source and target differ, down to single keys.

Counts and newest marks (``reconcile``) say that two tables differ, not where. Here both sides are dealt to
``fanout`` ranges of a hash of their key, and every range gets a digest that does not depend on the order of
its rows: their number and the sums of two hashes of each row. Ranges with equal digests are settled. The
others are dealt again, finer, and so on, until a range is small enough to compare its keys. Only those ranges'
rows are ever moved, once, by key, and the ranges themselves, a bounded number at a time, are all that the driver sees.

Each level reads the key and row hashes of both sides and filters on ranges that differ. Both sides write
their hashes once, where they were read: every task sorts its own by the key's hash, so that a level reads only
pages of such ranges, and nothing is moved for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SettingError
from tidemark.operators.upsert import named, require_keys

#: Ranges into which a range that differs is cut.
FANOUT = 64
#: Rows of both sides up to which a range's keys are compared.
SMALL = 100_000
#: Ranges that are refined; if more differ, all of them are compared at once, which is then the cheaper way.
OPEN_RANGES = 512

_SPAN = 1 << 62  # key hashes are taken as numbers from 0 to this


@dataclass(frozen=True)
class Comparison:
    """``rows`` has a row for every key that differs: the key columns, ``difference`` and both sides' row counts.

    ``levels`` says for each level how many ranges were looked at and how many differed.
    """

    rows: DataFrame
    levels: list[tuple[int, int]]


def hashed(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The key columns, ``__at`` (the key's place on the hash circle) and two hashes of each row.

    NULL differs from every value, also in a key; a double's NaN equals itself, and 0.0 equals -0.0.
    """

    def plain(name: str) -> Column:
        data_type = df.schema[name].dataType
        if isinstance(data_type, (T.MapType, T.VariantType)):
            return F.to_json(F.struct(F.array_sort(F.map_entries(named(name))).alias("m"))) if isinstance(data_type, T.MapType) else named(name).cast("string")
        if isinstance(data_type, (T.DoubleType, T.FloatType)):
            return F.when(named(name) == 0, F.lit(0).cast(data_type)).otherwise(named(name))
        return named(name)

    def told_apart(names: list[str]) -> list[Column]:
        # hashing skips NULLs, so whether a column is NULL is hashed as well
        return [c for n in names for c in (plain(n), named(n).isNull())]

    at = F.shiftrightunsigned(F.xxhash64(*told_apart(keys)), 2)
    row = told_apart(columns)
    return df.select(
        *[named(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        at.alias("__at"),
        F.xxhash64(*row).alias("__one"),
        F.xxhash64(F.lit(7), *row).alias("__two"),
    )


def _digests(side: DataFrame, ranges: list[tuple[int, int]] | None, width: int) -> DataFrame:
    """Number of rows and sums of their hashes for each range of ``width`` within ``ranges`` (None: everywhere)."""
    some = side if ranges is None else side.where(_within(ranges))
    add = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))  # noqa: E731 - sums of any number of longs
    return some.groupBy(F.expr(f"__at div {width}L").alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), add("__one").alias("one"), add("__two").alias("two")
    )


def _within(ranges: list[tuple[int, int]]) -> Column:
    """Whether a key's place lies in one of the ranges; neighbouring ranges are joined first."""
    joined: list[list[int]] = []
    for low, high in sorted(ranges):
        if joined and joined[-1][1] + 1 >= low:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    terms = [F.col("__at").between(low, high) for low, high in joined]
    while len(terms) > 1:  # in pairs: a chain of hundreds would be too deep for the planner's stack
        terms = [reduce(or_, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


def _differing(a: DataFrame, b: DataFrame, ranges, width: int, limit: int) -> list:
    one, two = _digests(a, ranges, width).alias("a"), _digests(b, ranges, width).alias("b")
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.one") == F.col("b.one")) & (F.col("a.two") == F.col("b.two"))
    joined = one.join(two, F.col("a.slot") == F.col("b.slot"), "full_outer").where(~F.coalesce(same, F.lit(False)))
    rows = F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))
    return joined.select(F.coalesce("a.slot", "b.slot").alias("slot"), rows.alias("n")).limit(limit).collect()


def compare_tables(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    *,
    folder: str,
    fanout: int = FANOUT,
    small: int = SMALL,
    open_ranges: int = OPEN_RANGES,
) -> Comparison:
    """Finds the keys whose rows differ between two tables.

    ``difference`` is ``left only``, ``right only`` or ``changed``; ``left_rows`` and ``right_rows`` count the rows of the
    key. Rows are compared in ``columns`` (all of ``left``'s unless given), whatever their order; of repeated
    keys all rows count together. Keys with NULLs are compared like others. ``folder`` takes the hashes, on storage that
    all executors share. Tables without rows give no differences on either side.
    """
    keys, columns = require_keys(keys), columns or left.columns
    if fanout < 2 or small < 1 or open_ranges < 1:
        raise SettingError("fanout has to be at least 2, small and open_ranges at least 1")
    spark = left.sparkSession
    sides = []
    for name, df in (("left", left), ("right", right)):
        hashed(df, keys, columns).sortWithinPartitions("__at").write.parquet(f"{folder}/{name}")
        sides.append(spark.read.parquet(f"{folder}/{name}"))
    a, b = sides

    levels, done = [], []
    ranges, width = None, -(-_SPAN // fanout)
    while True:
        found = _differing(a, b, ranges, width, open_ranges + 1)
        levels.append((fanout if ranges is None else len(ranges) * fanout, len(found)))
        spans = [(r["slot"] * width, (r["slot"] + 1) * width - 1, r["n"]) for r in found]
        if len(found) > open_ranges:  # differences are everywhere: nothing is left to narrow down
            done = [(0, _SPAN)] if ranges is None else done + ranges
            break
        done += [(low, high) for low, high, n in spans if n <= small or width == 1]
        ranges = [(low, high) for low, high, n in spans if n > small and width > 1]
        if not ranges:
            break
        width = -(-width // fanout)
    return Comparison(_keys_that_differ(a, b, keys, done), levels)


def _keys_that_differ(a: DataFrame, b: DataFrame, keys: list[str], ranges: list[tuple[int, int]]) -> DataFrame:
    """Keys within the ranges whose rows are not the same on both sides.

    Both sides' rows of a key meet in one grouping, the right ones' hashes counted off the left ones': what is equal leaves zero.
    """
    places = [f"__key_{i}" for i in range(len(keys))]

    def side(df: DataFrame, left: bool) -> DataFrame:
        some = df.where(_within(ranges)) if ranges else df.limit(0)
        hashes = {c: F.col(c).cast("decimal(20,0)") for c in ("__one", "__two")}  # sums of any number of longs
        return some.select("__at", *places, F.lit(left).alias("__left"), *[(h if left else -h).alias(c) for c, h in hashes.items()])

    per_key = (
        side(a, True)
        .unionByName(side(b, False))
        .groupBy("__at", *places)
        .agg(
            F.count_if("__left").alias("left_rows"),
            F.count_if(~F.col("__left")).alias("right_rows"),
            F.sum("__one").alias("__one"),
            F.sum("__two").alias("__two"),
        )
    )
    what = (
        F.when(F.col("right_rows") == 0, "left only")
        .when(F.col("left_rows") == 0, "right only")
        .when((F.col("left_rows") != F.col("right_rows")) | (F.col("__one") != 0) | (F.col("__two") != 0), "changed")
    )
    return per_key.select(
        *[F.col(c).alias(k) for c, k in zip(places, keys)], what.alias("difference"), "left_rows", "right_rows"
    ).where(F.col("difference").isNotNull())
