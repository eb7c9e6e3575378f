"""The upsert as plain DataFrame functions: frames in, frames out, nothing is written.

Keys compare with ``=``: a NULL in any key column matches nothing, so such rows are always
inserted and never grouped by their key. Where they pass through a join a hash of their
columns spreads them: a large group of NULL keys would else land in one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SettingError

_NEW = "__new_{}"


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_keys(keys: list[str]) -> list[str]:
    if not keys:
        raise SettingError("an upsert needs at least one key column")
    return list(keys)


def has_key(keys: list[str]) -> Column:
    """True where no key column is NULL."""
    return reduce(and_, [named(k).isNotNull() for k in keys])


def last_writer(df: DataFrame, keys: list[str], watermark: str) -> DataFrame:
    """The row with the greatest watermark for each key; NULL-key rows all stay.

    Ties go to the greatest remaining columns, so that the same input always gives the
    same rows. ``row_number() = 1`` lets Spark drop the losers before the shuffle, one
    survivor per key and task, which is what keeps a hot key from travelling whole.
    """
    keys = require_keys(keys)
    window = Window.partitionBy(*map(named, keys)).orderBy(*latest_first(df.schema, keys, watermark))
    keyed = df.where(has_key(keys)).withColumn("__rank", F.row_number().over(window))
    return keyed.where(F.col("__rank") == 1).drop("__rank").unionByName(df.where(~has_key(keys)))


def latest_first(schema: T.StructType, keys: list[str], watermark: str) -> list[Column]:
    """The order in which the last writer of a key comes first."""
    tie_breakers = [
        named(f.name).desc_nulls_last()
        for f in schema.fields
        if f.name not in keys and f.name != watermark and _orderable(f.dataType)
    ]
    return [named(watermark).desc_nulls_last(), *tie_breakers]


def apply_updates(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Every target row, with all of ``delta``'s columns taken over where the keys match.

    ``delta`` holds each key once. Target columns that ``delta`` lacks keep their value.
    A left join, so that Spark can broadcast a small ``delta`` and leave the target
    unshuffled.
    """
    keys = require_keys(keys)
    incoming = delta.where(has_key(keys)).select(*[named(c).alias(_NEW.format(c)) for c in delta.columns])
    on = reduce(and_, [named(k) == named(_NEW.format(k)) for k in keys])
    joined = target.where(has_key(keys)).join(incoming, on, "left")
    hit = named(_NEW.format(keys[0])).isNotNull()
    merged = joined.select(
        *[
            F.when(hit, named(_NEW.format(c))).otherwise(named(c)).alias(c) if c in delta.columns else named(c)
            for c in target.columns
        ]
    )
    return merged.unionByName(target.where(~has_key(keys)))


def new_rows(delta: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``delta`` whose key the target does not hold, and all NULL-key rows.

    The target is first reduced to the keys that ``delta`` has, key columns only, so the
    anti join meets no more keys than ``delta`` itself holds.
    """
    keys = require_keys(keys)
    keyed = delta.where(has_key(keys))
    columns = [named(k) for k in keys]
    known = target.select(*columns).where(has_key(keys)).join(keyed.select(*columns), keys, "left_semi")
    return keyed.join(known, keys, "left_anti").unionByName(delta.where(~has_key(keys)))


def side_by_side(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides' rows in one full join: columns ``t<i>`` of the target, ``d<i>`` of the delta by
    position, and ``in_target``, ``in_delta``, true where that side has a row.

    Each side is read once and moved by its key once. Rows without a key match nothing; a hash of
    their columns stands beside the key, so that they are spread over all tasks.
    """
    keys = require_keys(keys)

    def side(df: DataFrame, letter: str) -> DataFrame:
        spread = F.when(has_key(keys), F.lit(0)).otherwise(F.xxhash64(*[named(c) for c in df.columns if _hashable(df.schema[c].dataType)]))
        columns = [named(c).alias(f"{letter}{i}") for i, c in enumerate(df.columns)]
        return df.select(*columns, spread.alias(f"{letter}_spread"), F.lit(True).alias(f"in_{'target' if letter == 't' else 'delta'}"))

    on = [F.col(f"t{target.columns.index(k)}") == F.col(f"d{delta.columns.index(k)}") for k in keys]
    on.append(F.col("t_spread") == F.col("d_spread"))
    joined = side(target, "t").join(side(delta, "d"), reduce(and_, on), "full_outer")
    return joined.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_target", "in_delta")}).drop("t_spread", "d_spread")


def upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Target after the merge: matched rows replaced, others kept, unmatched inserted.

    ``delta`` holds each key once. Columns that only the target has keep their value in matched rows
    and are NULL in inserted ones.
    """
    joined = side_by_side(target, delta, keys)

    def merged(i: int, name: str) -> Column:
        old = F.col(f"t{i}")
        if name in delta.columns:
            return F.when(F.col("in_delta"), F.col(f"d{delta.columns.index(name)}")).otherwise(old).alias(name)
        return old.alias(name)

    return joined.select(*[merged(i, name) for i, name in enumerate(target.columns)])


def upsert_metrics(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows_fetched, rows_inserted, rows_updated, rows_kept; from one join of the keys."""
    columns = [named(k) for k in require_keys(keys)]
    joined = side_by_side(target.select(*columns), delta.select(*columns), keys)
    old, new = F.col("in_target"), F.col("in_delta")
    return joined.agg(
        F.count_if(new).alias("rows_fetched"),
        F.count_if(new & ~old).alias("rows_inserted"),
        F.count_if(new & old).alias("rows_updated"),
        F.count_if(old & ~new).alias("rows_kept"),
    )


def _hashable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    return True
