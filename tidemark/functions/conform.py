"""Raw source columns to the declared target types, exactly or not at all.

One projection of built-in expressions. NULL passes in any column; a non-NULL value of the
wrong type, or a decimal that would lose a digit, fails the job with a message that names
the column and the expected type and never the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import INVALID_VALUE
from tidemark.functions.render import render_text
from tidemark.functions.typemap import ColumnSpec

# Raw Spark types that each target type accepts. Nothing else is coerced.
_ACCEPTED = {
    T.ShortType: (T.ByteType, T.ShortType),
    T.IntegerType: (T.IntegerType,),
    T.LongType: (T.LongType,),
    T.DoubleType: (T.FloatType, T.DoubleType),
    T.BooleanType: (T.BooleanType,),
    T.DateType: (T.DateType,),
    T.TimestampType: (T.TimestampType, T.TimestampNTZType),
    T.BinaryType: (T.BinaryType,),
}
_MONEY = ("money", "smallmoney")


def conform(df: DataFrame, columns: list[ColumnSpec]) -> DataFrame:
    """``df`` with exactly ``columns``, in that order, at their target types."""
    raw = {f.name.lower(): f.dataType for f in df.schema.fields}
    return df.select(
        *[conform_column(F.col(f"`{c.name}`"), raw[c.name.lower()], c).alias(c.name) for c in columns]
    )


def conform_column(c: Column, raw: T.DataType, spec: ColumnSpec) -> Column:
    wanted = spec.spark_type
    if isinstance(wanted, T.StringType):
        return render_text(c, raw, spec.type_name)
    if isinstance(wanted, T.DecimalType):
        if not isinstance(raw, T.DecimalType):
            return _only_null(c, spec)
        if _always_fits(raw, wanted):
            return c.cast(wanted)
        fits = decimal_fits(c, raw, wanted)
        return F.when(c.isNull() | fits, c.try_cast(wanted)).otherwise(_reject(spec))
    if spec.type_name in _MONEY and isinstance(raw, T.DecimalType):
        return c.cast("double")
    if isinstance(raw, _ACCEPTED[type(wanted)]):
        return c.cast(wanted)
    return _only_null(c, spec)


def decimal_fits(c: Column, raw: T.DecimalType, wanted: T.DecimalType) -> Column:
    """True where ``c`` can be held by ``wanted`` without losing a digit; NULL for NULL.

    The value goes there and back at its own type, so nothing is compared at a third,
    rounded precision.
    """
    if _always_fits(raw, wanted):
        return F.when(c.isNotNull(), F.lit(True))
    back = c.try_cast(wanted).try_cast(raw)
    return F.when(c.isNotNull(), F.coalesce(back == c, F.lit(False)))


def _always_fits(raw: T.DecimalType, wanted: T.DecimalType) -> bool:
    return wanted.scale >= raw.scale and wanted.precision - wanted.scale >= raw.precision - raw.scale


def _only_null(c: Column, spec: ColumnSpec) -> Column:
    nothing = F.lit(None).cast(spec.spark_type)
    return F.when(c.isNull(), nothing).otherwise(_reject(spec))


def _reject(spec: ColumnSpec) -> Column:
    expected = spec.spark_type.simpleString()
    return F.raise_error(F.lit(INVALID_VALUE.format(column=spec.name, expected=expected))).cast(spec.spark_type)
