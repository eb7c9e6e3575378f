"""Which Spark type a source column becomes.

``resolve`` answers for one column on the driver; ``resolve_columns`` answers for a whole
frame of catalog rows as one projection. Both read the same table of names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type names by the Spark type they become. A decimal is the one type
# that also needs its precision and scale; a name listed nowhere becomes text, unrecognised.
SOURCE_TYPE_NAMES = {
    "smallint": ("tinyint", "smallint"),
    "int": ("int",),
    "bigint": ("bigint",),
    "double": ("real", "float", "money", "smallmoney"),
    "boolean": ("bit",),
    "date": ("date",),
    "timestamp": ("datetime", "datetime2", "smalldatetime", "datetimeoffset"),
    "binary": ("binary", "varbinary", "image", "timestamp", "rowversion"),
    "string": (
        "char", "varchar", "text", "nchar", "nvarchar", "ntext",
        "uniqueidentifier", "xml", "time",
    ),
}
DECIMAL_NAMES = ("decimal", "numeric")
MAX_PRECISION = 38

_SPARK_TYPES = {
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "string": T.StringType(),
}
_BY_NAME = {name: spark for spark, names in SOURCE_TYPE_NAMES.items() for name in names}

# The catalog spelling given to a column that comes from a Spark table.
_SPARK_TO_SOURCE = {
    "tinyint": "smallint",
    "smallint": "smallint",
    "int": "int",
    "bigint": "bigint",
    "float": "real",
    "double": "float",
    "boolean": "bit",
    "date": "date",
    "timestamp": "datetimeoffset",
    "timestamp_ntz": "datetime2",
    "binary": "varbinary",
    "string": "nvarchar",
}


@dataclass(frozen=True)
class ColumnSpec:
    """One described source column and what it becomes."""

    name: str
    source_type: str
    spark_type: T.DataType
    recognised: bool

    @property
    def type_name(self) -> str:
        """The source type name, normalised for comparison."""
        return self.source_type.strip().lower()


def resolve(name: str, data_type: str, precision: int | None = None, scale: int | None = None) -> ColumnSpec:
    """Resolves one catalog row. Never fails: what cannot be mapped becomes text."""
    wanted = data_type.strip().lower()
    if wanted in DECIMAL_NAMES:
        if precision is not None and scale is not None and 1 <= precision <= MAX_PRECISION and 0 <= scale <= precision:
            return ColumnSpec(name, data_type, T.DecimalType(precision, scale), True)
        return ColumnSpec(name, data_type, T.StringType(), False)
    spark = _BY_NAME.get(wanted)
    return ColumnSpec(name, data_type, _SPARK_TYPES[spark or "string"], spark is not None)


def resolve_columns(described: DataFrame) -> DataFrame:
    """Adds ``spark_type`` and ``recognised`` to rows of (data_type, precision, scale)."""
    name = F.lower(F.trim("data_type"))
    precision, scale = F.col("precision"), F.col("scale")
    fits = precision.between(1, MAX_PRECISION) & (scale >= 0) & (scale <= precision)
    sized = F.coalesce(name.isin(*DECIMAL_NAMES) & fits, F.lit(False))
    spark_type: Column = F.when(sized, F.format_string("decimal(%d,%d)", precision, scale))
    for spark, names in SOURCE_TYPE_NAMES.items():
        spark_type = spark_type.when(name.isin(*names), F.lit(spark))
    mapped = sized | F.coalesce(name.isin(*_BY_NAME), F.lit(False))
    return described.withColumns({"spark_type": spark_type.otherwise("string"), "recognised": mapped})


def describe_schema(schema: T.StructType, declared: dict[str, tuple] | None = None) -> list[ColumnSpec]:
    """Describes a Spark schema as catalog columns; ``declared`` overrides by column name.

    A declared entry is ``(data_type,)`` or ``(data_type, precision, scale)``.
    """
    wanted = {name.lower(): spec for name, spec in (declared or {}).items()}
    columns = []
    for f in schema.fields:
        if f.name.lower() in wanted:
            columns.append(resolve(f.name, *wanted[f.name.lower()]))
        elif isinstance(f.dataType, T.DecimalType):
            columns.append(resolve(f.name, "decimal", f.dataType.precision, f.dataType.scale))
        else:
            spelled = f.dataType.simpleString()
            columns.append(resolve(f.name, _SPARK_TO_SOURCE.get(spelled, spelled)))
    return columns


def target_schema(columns: list[ColumnSpec]) -> T.StructType:
    """The target's schema: every column nullable, whatever the source declares."""
    return T.StructType([T.StructField(c.name, c.spark_type, True) for c in columns])


def find_column(names, wanted: str) -> str | None:
    """The actual spelling of ``wanted`` among ``names``, compared without case."""
    return next((n for n in names if n.lower() == wanted.lower()), None)
