import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import InvalidValueError, translate
from tidemark.functions.conform import conform, decimal_fits
from tidemark.functions.render import render_text
from tidemark.functions.typemap import (
    DECIMAL_NAMES,
    SOURCE_TYPE_NAMES,
    describe_schema,
    resolve,
    resolve_columns,
    target_schema,
)

CASES = [
    (name, None, None, spark, True) for spark, names in SOURCE_TYPE_NAMES.items() for name in names
] + [
    (" INT ", None, None, "int", True),
    ("NVarChar", None, None, "string", True),
    ("decimal", 10, 2, "decimal(10,2)", True),
    ("numeric", 38, 38, "decimal(38,38)", True),
    ("decimal", 39, 2, "string", False),
    ("decimal", 300, 2, "string", False),
    ("decimal", 10, -2, "string", False),
    ("decimal", 2, 5, "string", False),
    ("decimal", None, None, "string", False),
    ("decimal", 0, 0, "string", False),
    ("geography", None, None, "string", False),
    ("geometry", None, None, "string", False),
    ("hierarchyid", None, None, "string", False),
    ("sql_variant", None, None, "string", False),
]


@pytest.mark.parametrize("data_type, precision, scale, spark_type, recognised", CASES)
def test_resolve(data_type, precision, scale, spark_type, recognised):
    spec = resolve("c", data_type, precision, scale)
    assert (spec.spark_type.simpleString(), spec.recognised) == (spark_type, recognised)
    assert spec.source_type == data_type


def test_the_frame_resolver_agrees_with_the_single_one(spark):
    rows = spark.createDataFrame([c[:3] for c in CASES], "data_type string, precision int, scale int")
    got = [(r["spark_type"], r["recognised"]) for r in resolve_columns(rows).collect()]
    assert got == [(c[3], c[4]) for c in CASES]
    assert "decimal" in DECIMAL_NAMES


def test_every_target_column_is_nullable():
    specs = [resolve("a", "int"), resolve("b", "decimal", 5, 2)]
    assert all(f.nullable for f in target_schema(specs).fields)


def one(spark, value, raw, data_type, precision=None, scale=None):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", raw)]))
    try:
        return conform(df, [resolve("c", data_type, precision, scale)]).first()["c"]
    except Exception as e:  # noqa: BLE001
        raise translate(e) from None


@pytest.mark.parametrize(
    "value, raw, declared, expected",
    [
        (200, T.ShortType(), ("tinyint",), 200),
        (7, T.ByteType(), ("tinyint",), 7),
        (1, T.IntegerType(), ("int",), 1),
        (1 << 40, T.LongType(), ("bigint",), 1 << 40),
        (0.5, T.FloatType(), ("real",), 0.5),
        (Decimal("12.3400"), T.DecimalType(19, 4), ("money",), 12.34),
        (Decimal("-50.55"), T.DecimalType(10, 2), ("decimal", 10, 2), Decimal("-50.55")),
        (Decimal("7"), T.DecimalType(5, 0), ("decimal", 10, 2), Decimal("7.00")),
        (Decimal("1.2300"), T.DecimalType(10, 4), ("decimal", 10, 2), Decimal("1.23")),
        (Decimal("999"), T.DecimalType(10, 0), ("decimal", 3, 0), Decimal("999")),
        (bytearray(b"\x0f\xa0"), T.BinaryType(), ("rowversion",), bytearray(b"\x0f\xa0")),
        (dt.date(1969, 12, 31), T.DateType(), ("date",), dt.date(1969, 12, 31)),
        (True, T.BooleanType(), ("bit",), True),
        ("x", T.StringType(), ("nvarchar",), "x"),
    ],
)
def test_values_arrive_exactly(spark, value, raw, declared, expected):
    assert one(spark, value, raw, *declared) == expected


@pytest.mark.parametrize(
    "value, raw, declared, expected",
    [
        (7, T.LongType(), ("int",), "int"),
        ("7", T.StringType(), ("int",), "int"),
        (7, T.IntegerType(), ("bigint",), "bigint"),
        (Decimal("1.2345"), T.DecimalType(10, 4), ("decimal", 10, 2), r"decimal\(10,2\)"),
        (Decimal("1000"), T.DecimalType(10, 0), ("decimal", 3, 0), r"decimal\(3,0\)"),
        (Decimal("1234567890123456789012345678.123456789"), T.DecimalType(38, 9), ("decimal", 38, 20), r"decimal\(38,20\)"),
        ("2024-01-01", T.StringType(), ("datetime2",), "timestamp"),
        (1.5, T.DoubleType(), ("decimal", 10, 2), r"decimal\(10,2\)"),
        (1, T.IntegerType(), ("bit",), "boolean"),
    ],
)
def test_wrong_values_fail_without_being_shown(spark, value, raw, declared, expected):
    with pytest.raises(InvalidValueError, match=rf"column c holds something other than {expected}$") as caught:
        one(spark, value, raw, *declared)
    assert str(value) not in str(caught.value)


@pytest.mark.parametrize(
    "declared", [("int",), ("bigint",), ("decimal", 5, 2), ("bit",), ("date",), ("datetime2",), ("binary",), ("xml",), ("geography",)]
)
def test_null_passes_whatever_type_carries_it(spark, declared):
    assert one(spark, None, T.LongType(), *declared) is None
    assert one(spark, None, T.StringType(), *declared) is None


def test_timestamps_without_zone_are_taken_as_utc_and_floor_before_1970(spark):
    df = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.750' AS c")
    got = conform(df, [resolve("c", "datetime2")]).select(F.unix_micros("c")).first()[0]
    assert got == -250_000


def test_decimal_flags(spark):
    raw = T.DecimalType(10, 4)
    df = spark.createDataFrame([(Decimal("1.2300"),), (Decimal("1.2345"),), (None,)], T.StructType([T.StructField("c", raw)]))
    flags = [r[0] for r in df.select(decimal_fits(F.col("c"), raw, T.DecimalType(10, 2))).collect()]
    assert flags == [True, False, None]


def text(spark, expression, data_type="sql_variant"):
    df = spark.sql(f"SELECT {expression} AS c")
    return df.select(render_text(F.col("c"), df.schema["c"].dataType, data_type)).first()[0]


@pytest.mark.parametrize(
    "expression, data_type, expected",
    [
        ("true", "bit", "true"),
        ("cast(1 as double)", "float", "1"),
        ("cast(0.1 as double)", "float", "0.1"),
        ("cast(-0.5 as double)", "float", "-0.5"),
        ("cast('1e21' as double)", "float", "1000000000000000000000"),
        ("cast('1.25e10' as double)", "float", "12500000000"),
        ("cast('123456789.125' as double)", "float", "123456789.125"),
        ("cast('-1.25e-7' as double)", "float", "-0.000000125"),
        ("cast('NaN' as double)", "float", "NaN"),
        ("cast('-Infinity' as double)", "float", "-inf"),
        ("cast(0.1 as float)", "real", "0.1"),
        ("cast(42 as decimal(5,0))", "numeric", "42"),
        ("cast(-50.55 as decimal(10,2))", "decimal", "-50.55"),
        ("cast(0 as decimal(38,18))", "decimal", "0.000000000000000000"),
        ("cast('0.00000000012' as decimal(38,18))", "decimal", "0.000000000120000000"),
        ("X'0FA0'", "varbinary", "0fa0"),
        ("'6F9619FF-8B86-D011-B42D-00C04FC964FF'", "uniqueidentifier", "6f9619ff-8b86-d011-b42d-00c04fc964ff"),
        ("date'2026-03-04'", "date", "2026-03-04"),
        ("'13:45:30.1234567'", "time", "13:45:30.123456700"),
        ("'13:45:30.1200000'", "time", "13:45:30.120"),
        ("'13:45:30.0000000'", "time", "13:45:30"),
        ("'13:45:30'", "time", "13:45:30"),
        ("timestamp_ntz'2026-01-03 12:00:00'", "datetime2", "2026-01-03 12:00:00"),
        ("timestamp_ntz'2026-01-03 12:00:00.5'", "datetime2", "2026-01-03 12:00:00.500"),
        ("timestamp_ntz'2026-01-03 12:00:00.1234'", "datetime2", "2026-01-03 12:00:00.123400"),
        ("timestamp_ntz'1969-12-31 23:59:59.75'", "datetime2", "1969-12-31 23:59:59.750"),
        ("timestamp'2026-03-04 13:45:30.123456+02:00'", "datetimeoffset", "2026-03-04T11:45:30.123456+00:00"),
        ("timestamp'2026-03-04 13:45:30+02:00'", "datetimeoffset", "2026-03-04T11:45:30+00:00"),
        ("cast(null as int)", "int", None),
        ("cast(null as double)", "float", None),
        ("cast(null as string)", "time", None),
    ],
)
def test_text_form(spark, expression, data_type, expected):
    assert text(spark, expression, data_type) == expected


def test_a_spark_schema_describes_itself(spark):
    df = spark.sql("SELECT 1 AS a, 2L AS b, 'x' AS c, timestamp_ntz'2024-01-01' AS d, array(1) AS e, 1.5BD AS f")
    specs = describe_schema(df.schema, {"A": ("tinyint",)})
    assert [(s.name, s.source_type, s.spark_type.simpleString(), s.recognised) for s in specs] == [
        ("a", "tinyint", "smallint", True),
        ("b", "bigint", "bigint", True),
        ("c", "nvarchar", "string", True),
        ("d", "datetime2", "timestamp", True),
        ("e", "array<int>", "string", False),
        ("f", "decimal", "decimal(2,1)", True),
    ]
