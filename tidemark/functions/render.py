"""Any value as text, as checkpoints and text columns record it.

All built from column expressions. Fractions of a second appear in groups of three digits
and only as many groups as the value needs; a double never uses an exponent and a whole
double has no fraction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def render_text(c: Column, raw: T.DataType, type_name: str = "") -> Column:
    """Text of ``c``, whose Spark type is ``raw``; NULL stays NULL.

    ``type_name`` is the source's type name where it decides the form: a
    ``uniqueidentifier`` is lower case, a ``time`` has its fraction regrouped, a
    ``datetimeoffset`` is written as a UTC instant with its offset.
    """
    if isinstance(raw, T.StringType):
        if type_name == "uniqueidentifier":
            return F.lower(c)
        return _time_text(c) if type_name == "time" else c
    if isinstance(raw, T.BinaryType):
        return hex_text(c)
    if isinstance(raw, T.TimestampType) and type_name == "datetimeoffset":
        return F.concat(F.translate(_timestamp_text(c), " ", "T"), F.lit("+00:00"))
    if isinstance(raw, (T.TimestampType, T.TimestampNTZType)):
        return _timestamp_text(c)
    if isinstance(raw, (T.FloatType, T.DoubleType)):
        return _float_text(c)
    if isinstance(raw, T.DecimalType):
        return _decimal_text(c, raw)
    return c.cast("string")


def hex_text(c: Column) -> Column:
    """Lower-case hex without a prefix."""
    return F.lower(F.hex(c))


def _timestamp_text(c: Column) -> Column:
    # Spark prints as many fractional digits as needed; the last group is filled up to three.
    text = c.cast("string")
    point = F.instr(text, ".")
    missing = F.pmod(point - F.length(text), F.lit(3))
    return F.when(point == 0, text).otherwise(F.concat(text, F.repeat(F.lit("0"), missing)))


def _time_text(c: Column) -> Column:
    whole = F.substring_index(c, ".", 1)
    fraction = F.when(F.instr(c, ".") > 0, F.rpad(F.substring_index(c, ".", -1), 9, "0")).otherwise("")
    grouped = F.regexp_replace(fraction, "(000)+$", "")
    return F.when(grouped == "", whole).otherwise(F.concat(whole, F.lit("."), grouped))


def _decimal_text(c: Column, raw: T.DecimalType) -> Column:
    text = c.cast("string")
    if raw.scale <= 6:
        return text  # plain notation is guaranteed down to six fractional digits
    return F.when(F.instr(text, "E") == 0, text).otherwise(_shift_exponent(text, raw.scale))


def _float_text(c: Column) -> Column:
    text = c.cast("string")
    plain = F.when(F.endswith(text, F.lit(".0")), F.substring(text, F.lit(1), F.length(text) - 2)).otherwise(text)
    special = (
        F.when(F.isnan(c), F.lit("NaN"))
        .when(c == float("inf"), F.lit("inf"))
        .when(c == float("-inf"), F.lit("-inf"))
    )
    return special.when(F.instr(text, "E") == 0, plain).otherwise(_shift_exponent(text))


def _shift_exponent(text: Column, scale: int | None = None) -> Column:
    """``-1.25E-7`` as ``-0.000000125``: moves the point through the digit string."""
    negative = F.startswith(text, F.lit("-"))
    unsigned = F.regexp_replace(text, "^-", "")
    mantissa = F.substring_index(unsigned, "E", 1)
    exponent = F.substring_index(unsigned, "E", -1).cast("int")
    lead = F.substring_index(mantissa, ".", 1)
    tail = F.when(F.instr(mantissa, ".") > 0, F.substring_index(mantissa, ".", -1)).otherwise("")
    if scale is None:
        tail = F.regexp_replace(tail, "0+$", "")
    digits = F.concat(lead, tail)
    point = F.length(lead) + exponent
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    whole = F.rpad(digits, point, "0")
    mixed = F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.length(digits)))
    shifted = F.when(point <= 0, small).when(point >= F.length(digits), whole).otherwise(mixed)
    return F.concat(F.when(negative, "-").otherwise(""), shifted)
