"""The text and options sent to a database. No database is started: what is checked is what
would be sent, and how its answers are read."""

import pytest

from tidemark.config import SyncConfig, TableSync
from tidemark.errors import CheckpointMismatchError, SettingError, SourceQueryError, SourceUnavailableError, TableNotFoundError, translate
from tidemark.functions.typemap import resolve
from tidemark.operators.catalog import config_frame, match_catalog
from tidemark.sources import jdbc
from tidemark.sources.jdbc import JdbcSource

TABLE = TableSync("dbo.customers", "updated_at", ("id",))
COLUMNS = [
    resolve("id", "int"),
    resolve("start", "time"),
    resolve("ref", "uniqueidentifier"),
    resolve("shape", "geography"),
    resolve("odd ]name", "nvarchar"),
    resolve("updated_at", "datetime2"),
]


def test_a_connection_string_becomes_options():
    text = "Server=tcp:db.example,1433;Database=crm;User Id=svc;Password=s3cret;Encrypt=true;TrustServerCertificate=false"
    source = JdbcSource.from_connection_string(None, text)
    options = source.reader_options("SELECT 1 AS x")
    assert options == {
        "url": "jdbc:sqlserver://db.example:1433",
        "dbtable": "(SELECT 1 AS x) AS src",
        "user": "svc",
        "password": "s3cret",
        "encrypt": "true",
        "trustServerCertificate": "false",
        "databaseName": "crm",
    }
    assert "s3cret" not in repr(source) and {text, "s3cret"} <= set(source.secrets)
    with pytest.raises(SettingError):
        JdbcSource.from_connection_string(None, "Database=crm")


def test_settings_are_passed_on_or_refused():
    text = 'Server=db;User Id=u;Password="a;b";ApplicationIntent=ReadOnly;Authentication=ActiveDirectoryPassword;Pooling=true'
    source = JdbcSource.from_connection_string(None, text)
    assert source.password == "a;b" and source.options == {"applicationIntent": "ReadOnly", "authentication": "ActiveDirectoryPassword"}
    with pytest.raises(SettingError, match="colour"):
        JdbcSource.from_connection_string(None, "Server=db;Colour=blue")
    url = JdbcSource.from_connection_string(None, "jdbc:sqlserver://db;user=u;password={a;b}")
    assert url.password == "a;b" and "a;b" in url.secrets


@pytest.mark.parametrize(
    "type_name, text, expected",
    [
        ("float", "1.0000000000000000e+000", "1"),
        ("float", "1.2500000000000000e-007", "0.000000125"),
        ("float", "-1.2300000000000000e+020", "-123000000000000000000"),
        ("real", "1.0000000e-001", "0.10000000149011612"),
        ("money", "12.3400", "12.34"),
        ("smallmoney", "100.0000", "100"),
    ],
)
def test_numbers_take_the_targets_form(spark, type_name, text, expected):
    from pyspark.sql import functions as F

    from tidemark.functions.render import render_text

    spec = resolve("w", type_name)
    assert jdbc.tidy_watermark(text, spec) == expected
    raw = spark.range(1).select(F.lit(float(expected)).alias("w"))
    assert raw.select(render_text(F.col("w"), raw.schema["w"].dataType, type_name)).first()[0] == expected


def test_limits_become_reader_options(spark):
    source = JdbcSource(spark, "jdbc:x")
    source.configure(SyncConfig("/o", None, 500, 7, 60))
    assert source.reader_options("q") | {"dbtable": ""} == {
        "url": "jdbc:x", "dbtable": "", "fetchsize": "500", "loginTimeout": "7", "socketTimeout": "60000"}
    source.configure(SyncConfig("/o", None, 500, None, None))
    assert "socketTimeout" not in source.reader_options("q")


def test_every_column_is_named_and_text_is_made_at_the_source():
    assert jdbc.projection_sql(COLUMNS) == (
        "[id], CAST([start] AS varchar(16)) AS [start], CAST([ref] AS char(36)) AS [ref], "
        "CAST([shape] AS nvarchar(max)) AS [shape], [odd ]]name], [updated_at]"
    )


def test_scans():
    columns = [resolve("id", "int"), resolve("updated_at", "datetime2")]
    head = "SELECT [id], [updated_at] FROM dbo.customers WHERE "
    bound = "CAST(N'{}' AS datetime2(7))"
    assert jdbc.scan_sql(TABLE, columns, None, "2026") == f"{head}[updated_at] <= {bound.format('2026')} OR [updated_at] IS NULL"
    assert jdbc.scan_sql(TABLE, columns, "2025", "2026") == (
        f"{head}[updated_at] > {bound.format('2025')} AND [updated_at] <= {bound.format('2026')}")
    assert jdbc.scan_sql(TABLE, columns, None, None) == f"{head}[updated_at] IS NULL"


@pytest.mark.parametrize(
    "data_type, value, expected",
    [
        ("int", "42", "42"),
        ("decimal", "-1.50", "-1.50"),
        ("bigint", "1e3", "1000"),
        ("nvarchar", "O'Hara; DROP", "N'O''Hara; DROP'"),
        ("date", "2026-01-01", "CAST(N'2026-01-01' AS date)"),
        ("datetime", "2026-01-01 00:00:00.003333300", "CAST(N'2026-01-01 00:00:00.0033333' AS datetime2(7))"),
        ("datetimeoffset", "2026-01-01T00:00:00+00:00", "CAST(N'2026-01-01T00:00:00+00:00' AS datetimeoffset(7))"),
    ],
)
def test_bounds_are_typed(data_type, value, expected):
    assert jdbc.bound_sql(value, resolve("w", data_type, 10, 2)) == expected


@pytest.mark.parametrize("value", ["1; DROP TABLE x", "NaN", "Infinity", ""])
def test_a_number_bound_must_be_a_number(value):
    with pytest.raises(CheckpointMismatchError):
        jdbc.bound_sql(value, resolve("w", "int"))


@pytest.mark.parametrize(
    "data_type, text, expected",
    [
        ("datetime2", "2026-01-03 12:00:00.0000000", "2026-01-03 12:00:00"),
        ("datetime2", "2026-01-03 12:00:00.1234567", "2026-01-03 12:00:00.123456700"),
        ("datetime2", "2026-01-03 12:00:00.1130000", "2026-01-03 12:00:00.113"),
        ("datetimeoffset", "2026-01-03 12:00:00.5000000", "2026-01-03T12:00:00.500+00:00"),
        ("uniqueidentifier", "AB", "ab"),
        ("int", "7", "7"),
        ("int", None, None),
    ],
)
def test_watermarks_are_read_in_checkpoint_form(data_type, text, expected):
    assert jdbc.tidy_watermark(text, resolve("w", data_type)) == expected


def test_the_greatest_watermark_keeps_every_digit():
    columns = [resolve("updated_at", "datetime2")]
    assert jdbc.max_sql(TABLE, columns) == (
        "SELECT CONVERT(varchar(27), MAX([updated_at]), 121) AS watermark FROM dbo.customers")
    assert jdbc.max_sql(TABLE, columns, label=True).startswith("SELECT N'dbo.customers' AS table_name, ")


def test_the_database_counts_for_a_reconciliation(spark):
    columns = [resolve("updated_at", "datetime2")]
    source = Answers(spark, spark.createDataFrame([(7, "2026-01-03 12:00:00.1234567")], "n long, newest string"))
    assert source.summary(TABLE, columns) == (7, "2026-01-03 12:00:00.123456")
    assert source.asked[0][0].startswith("SELECT COUNT_BIG(*) AS n, CONVERT(varchar(27), MAX([updated_at]), 121) AS newest")


def test_one_catalog_query_for_each_database():
    assert "FROM INFORMATION_SCHEMA.COLUMNS WHERE TABLE_NAME IN (N'a', N'b')" in jdbc.catalog_sql(None, ["a", "b", "a"])
    assert "FROM crm.INFORMATION_SCHEMA.COLUMNS" in jdbc.catalog_sql("crm", ["a"])


class Answers(JdbcSource):
    """Answers queries from frames, in order, and keeps what was asked."""

    def __init__(self, spark, *frames):
        super().__init__(spark, "jdbc:fake")
        self.frames, self.asked = list(frames), []

    def query(self, sql, predicates=None):
        self.asked.append((sql, predicates))
        return self.frames.pop(0)


CATALOG = ("TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, DATA_TYPE string, "
           "NUMERIC_PRECISION int, NUMERIC_SCALE int, DEFAULT_SCHEMA string")


def catalog(spark):
    return spark.createDataFrame(
        [
            ("dbo", "Customers", "updated_at", 2, "datetime2", None, None, "dbo"),
            ("dbo", "Customers", "id", 1, "int", 10, 0, "dbo"),
            ("old", "Customers", "id", 1, "bigint", 19, 0, "dbo"),
            ("dbo", "Money", "amount", 1, "decimal", 10, 2, "dbo"),
        ],
        CATALOG,
    )


def test_describe_finds_the_schema_and_keeps_the_order(spark):
    tables = [TableSync("customers", "updated_at", "id"), TableSync("OLD.customers", "w", "id"), TableSync("dbo.money", "w", "x")]
    found = Answers(spark, catalog(spark)).describe(tables)
    assert [(c.name, c.spark_type.simpleString()) for c in found["customers"]] == [("id", "int"), ("updated_at", "timestamp")]
    assert [c.spark_type.simpleString() for c in found["OLD.customers"]] == ["bigint"]
    assert [c.spark_type.simpleString() for c in found["dbo.money"]] == ["decimal(10,2)"]
    with pytest.raises(TableNotFoundError, match="^dbo.gone"):
        Answers(spark, catalog(spark)).describe([TableSync("dbo.gone", "w", "id")])
    rows = match_catalog(catalog(spark).toDF(*[c.lower() for c in catalog(spark).columns]), config_frame(spark, [TableSync("dbo.gone", "w", "id")]))
    assert rows.first()["column_name"] is None


def test_an_idle_table_costs_one_query(spark):
    columns = [resolve("id", "int"), resolve("updated_at", "datetime2")]
    mark = spark.createDataFrame([("2026-01-03 12:00:00.0000000",)], "watermark string")
    source = Answers(spark, mark)
    assert source.scan(TABLE, columns, "2026-01-03 12:00:00") is None and len(source.asked) == 1


def test_a_scan_is_bounded_and_split_by_key(spark):
    columns = [resolve("id", "int"), resolve("updated_at", "datetime2")]
    mark = spark.createDataFrame([("2026-01-03 12:00:00.0000000",)], "watermark string")
    source = Answers(spark, mark, spark.createDataFrame([("1",), ("40",), ("40",), ("900",)], "low string"), spark.range(1))
    source.num_partitions = 4
    scan = source.scan(TABLE, columns, None)
    assert scan.bounded and scan.newest == "2026-01-03 12:00:00"
    assert source.asked[1][0].startswith("SELECT CAST(MIN([id]) AS nvarchar(4000)) AS low FROM (SELECT [id], NTILE(4) OVER (ORDER BY [id])")
    assert source.asked[-1][1] == ["[id] < 40 OR [id] IS NULL", "[id] >= 40 AND [id] < 900", "[id] >= 900"]


def test_a_scan_is_split_without_being_told_so(spark):
    columns = [resolve("id", "int"), resolve("updated_at", "datetime2")]
    source = Answers(spark, spark.createDataFrame([("1",), ("5",)], "low string"))
    assert JdbcSource.from_connection_string(spark, "Server=db").num_partitions is None
    assert source._ranges(TABLE, columns, "q") == ["[id] < 5 OR [id] IS NULL", "[id] >= 5"]
    assert f"NTILE({spark.sparkContext.defaultParallelism})" in source.asked[0][0]
    source.num_partitions = 1
    assert source._ranges(TABLE, columns, "q") == []


def test_without_a_number_key_the_watermark_is_split(spark):
    columns = [resolve("id", "uniqueidentifier"), resolve("updated_at", "datetime2")]
    mark = spark.createDataFrame([("2026-01-03 12:00:00.0000000",)], "watermark string")
    starts = spark.createDataFrame([("2020-01-01 00:00:00.0000000",), ("2026-01-03 12:00:00.0000000",)], "low string")
    source = Answers(spark, mark, starts, spark.range(1))
    source.scan(TABLE, columns, None)
    assert source.asked[1][0].startswith("SELECT CONVERT(varchar(27), MIN([updated_at]), 121) AS low ")
    assert source.asked[-1][1][1] == "[updated_at] >= CAST(N'2026-01-03 12:00:00' AS datetime2(7))"
    text = [resolve("id", "nvarchar"), resolve("updated_at", "nvarchar")]
    source = Answers(spark, mark, spark.range(1))
    source.scan(TABLE, text, None)
    assert source.asked[-1][1] == []


def test_ranges_of_skewed_keys_hold_about_as_many_rows():
    """The statement itself, its quoting changed for the engine at hand: nine tenths of the keys lie close together."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 10 = 0 THEN i * 100000 ELSE i END AS id FROM range(20000) r(i)")
    spec = resolve("id", "bigint")
    local = lambda sql: sql.replace("[id]", "id").replace("nvarchar(4000)", "varchar")
    starts = [r[0] for r in con.execute(local(jdbc.quantile_sql(spec, "SELECT * FROM t", 8))).fetchall()]
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {local(p)}").fetchone()[0] for p in jdbc.range_predicates(spec, starts)]
    assert len(counts) == 8 and sum(counts) == 20000 and max(counts) <= 2 * min(counts)


def test_tables_with_news_are_found_by_one_statement(spark):
    columns = [resolve("id", "int")]
    tables = [TableSync(n, "id", "id") for n in ("dbo.a", "dbo.b", "dbo.c")]
    answer = spark.createDataFrame([("dbo.a", "5"), ("dbo.b", "9")], "t string, w string")
    source = Answers(spark, answer)
    assert source.changed(tables, {t.table: columns for t in tables}, {"dbo.a": "5", "dbo.b": "8"}) == {"dbo.b"}
    assert source.asked[0][0].count("UNION ALL") == 1
    assert source.changed(tables, {}, {}) == set()


@pytest.mark.parametrize(
    "message, kind",
    [
        ("An error: java.sql.SQLException: Login failed for user 'svc' with s3cret", SourceUnavailableError),
        ("com.microsoft.sqlserver.jdbc.SQLServerException: Invalid object name", SourceQueryError),
    ],
)
def test_database_failures_are_sorted_and_scrubbed(message, kind):
    from pyspark.errors import PySparkException

    error = translate(PySparkException(message), ["s3cret"])
    assert type(error) is kind and "s3cret" not in str(error)


def test_bounds_have_at_most_the_digits_the_source_accepts():
    assert jdbc.bound_sql("2026-01-01 00:00:00.123456700", resolve("w", "datetime2")) == (
        "CAST(N'2026-01-01 00:00:00.1234567' AS datetime2(7))")
