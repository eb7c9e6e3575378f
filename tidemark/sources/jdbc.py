"""A live database read through Spark's JDBC source.

The SQL text is that of SQL Server. The upper bound of every run is the greatest watermark
taken before the read, so that a split read, whose parts see different moments, never
carries the checkpoint past rows it did not fetch.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field
from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.config import SyncConfig, TableName, TableSync
from tidemark.errors import (
    CheckpointMismatchError,
    SettingError,
    TableNotFoundError,
    in_table,
)
from tidemark.functions.typemap import ColumnSpec, find_column, resolve
from tidemark.operators.catalog import config_frame, match_catalog
from tidemark.sinks.storage import at_once
from tidemark.sources import connection
from tidemark.sources.base import Scan

# Types whose text the source renders, and the SQL that does it.
TEXT_AT_SOURCE = {
    "time": "CAST({c} AS varchar(16))",
    "uniqueidentifier": "CAST({c} AS char(36))",
    "xml": "CAST({c} AS nvarchar(max))",
}
UNMAPPED_AT_SOURCE = "CAST({c} AS nvarchar(max))"

# A watermark as text with every digit the source holds, by source type.
WATERMARK_TEXT = {
    "date": "CONVERT(varchar(10), {w}, 23)",
    "time": "CAST({w} AS varchar(16))",
    "datetime": "CONVERT(varchar(27), CAST({w} AS datetime2(7)), 121)",
    "smalldatetime": "CONVERT(varchar(27), CAST({w} AS datetime2(7)), 121)",
    "datetime2": "CONVERT(varchar(27), {w}, 121)",
    "datetimeoffset": "CONVERT(varchar(27), CAST(SWITCHOFFSET({w}, '+00:00') AS datetime2(7)), 121)",
    "real": "CONVERT(varchar(40), {w}, 3)",
    "float": "CONVERT(varchar(40), {w}, 3)",
    "money": "CONVERT(varchar(40), {w}, 2)",
    "smallmoney": "CONVERT(varchar(40), {w}, 2)",
}
WATERMARK_TEXT_OTHERWISE = "CAST({w} AS nvarchar(4000))"

# The type a checkpoint's text is converted to for the comparison.
BOUND_TYPES = {
    "date": "date",
    "time": "time(7)",
    "datetime": "datetime2(7)",
    "smalldatetime": "datetime2(7)",
    "datetime2": "datetime2(7)",
    "datetimeoffset": "datetimeoffset(7)",
    "real": "real",
    "float": "float",
}
# Types whose text the source pads with zeros or an exponent.
_PLAIN_NUMBERS = ("real", "float", "money", "smallmoney")
_NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "decimal", "numeric", "money", "smallmoney", "bit")

_UTC_ZONES = ("UTC", "Etc/UTC", "GMT", "Z", "Zulu", "Etc/GMT", "Universal", "Etc/Universal", "UCT", "Etc/UCT")

# Of how many tables one statement asks the greatest watermark.
TABLES_PER_STATEMENT = 100


@dataclass
class JdbcSource:
    """Tables of one database server. ``options`` go to Spark's JDBC reader unchanged.

    A scan is read by ``num_partitions`` tasks, as many as the cluster has cores if not given.
    """

    spark: SparkSession
    url: str = field(repr=False)
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    options: dict[str, str] = field(default_factory=dict, repr=False)
    num_partitions: int | None = None

    def __post_init__(self):
        self.secrets = tuple(s for s in (self.url, self.password) if s)
        self._limits: dict[str, str] = {}

    @classmethod
    def from_connection_string(cls, spark: SparkSession, text: str, **kwargs) -> JdbcSource:
        """From ``Server=tcp:host,1433;Database=d;User Id=u;Password=p;Encrypt=true`` or a JDBC URL.

        A key that is neither passed on nor known to have no effect is refused.
        """
        found = connection.settings(text)
        password = connection.chosen(found, "password")
        if text.lower().startswith("jdbc:"):
            source = cls(spark, text, password=password, **kwargs)
            source.secrets = (*source.secrets, *connection.secrets_of(text))
            return source
        server = connection.chosen(found, "server")
        if not server:
            raise SettingError("the connection string names no server")
        if unknown := connection.unknown(found):
            raise SettingError(f"the connection string has settings that are not understood: {', '.join(unknown)}")
        host, _, port = server.removeprefix("tcp:").partition(",")
        url = f"jdbc:sqlserver://{host.strip()}" + (f":{port.strip()}" if port else "")
        options = {connection.PROPERTIES[key]: value for key, value in found.items() if key in connection.PROPERTIES}
        if (connection.chosen(found, "integrated") or "").lower() in ("true", "yes", "sspi"):
            options["integratedSecurity"] = "true"
        if connection.chosen(found, "database"):
            options["databaseName"] = connection.chosen(found, "database")
        source = cls(spark, url, connection.chosen(found, "user"), password, options, **kwargs)
        source.secrets = (text, *source.secrets, *connection.secrets_of(text))
        return source

    # ------------------------------------------------------------------ reading

    def configure(self, config: SyncConfig) -> None:
        for zone in self._zones():
            if zone not in _UTC_ZONES:
                raise SettingError(f"a JVM runs in zone {zone}; JDBC timestamps need -Duser.timezone=UTC everywhere")
        self._limits = {"fetchsize": str(config.fetch_batch_size)}
        if config.login_timeout_sec is not None:
            self._limits["loginTimeout"] = str(config.login_timeout_sec)
        if config.query_timeout_sec is not None:
            # The driver's read time-out: how long one read may wait, not the whole query.
            self._limits["socketTimeout"] = str(config.query_timeout_sec * 1000)

    def _zones(self) -> set[str]:
        """The default zones of the driver and of the executors, asked in a job of a task for each core."""
        driver = self.spark._jvm.java.time.ZoneId.systemDefault().getId()
        tasks = self.spark.sparkContext.defaultParallelism
        asked = self.spark.range(0, tasks, 1, tasks).selectExpr("reflect('java.time.ZoneId', 'systemDefault') AS zone")
        return {driver, *(row["zone"] for row in asked.distinct().collect())}

    def query(self, sql: str, predicates: list[str] | None = None) -> DataFrame:
        """One task for each predicate; a single one without."""
        options = self.reader_options(sql)
        if not predicates:
            return self.spark.read.format("jdbc").options(**options).load()
        url, rows = options.pop("url"), options.pop("dbtable")
        return self.spark.read.jdbc(url, rows, predicates=predicates, properties=options)

    def reader_options(self, sql: str) -> dict[str, str]:
        credentials = {"user": self.user, "password": self.password}
        return {
            "url": self.url,
            "dbtable": f"({sql}) AS src",
            **{k: v for k, v in credentials.items() if v is not None},
            **self._limits,
            **self.options,
        }

    def describe(self, tables: list[TableSync]) -> dict[str, list[ColumnSpec]]:
        """One catalog query for each database, whatever the number of tables."""
        by_database: dict[str | None, list[TableSync]] = {}
        for t in tables:
            by_database.setdefault(TableName.parse(t.table).database, []).append(t)
        described: dict[str, list[ColumnSpec]] = {t.table: [] for t in tables}
        for database, group in by_database.items():
            catalog = self.query(catalog_sql(database, [TableName.parse(t.table).table for t in group]))
            rows = match_catalog(catalog.toDF(*[c.lower() for c in catalog.columns]), config_frame(self.spark, group))
            for row in rows.where("column_name IS NOT NULL").orderBy("table", "ordinal").collect():
                described[row["table"]].append(
                    resolve(row["column_name"], row["data_type"], row["precision"], row["scale"])
                )
        for t in tables:
            if not described[t.table]:
                raise in_table(TableNotFoundError("does not exist, or the account may not see it"), t.table)
        return described

    def watermark(self, table: TableSync, columns: list[ColumnSpec]) -> str | None:
        row = self.query(max_sql(table, columns)).first()
        return tidy_watermark(row[0], _watermark_spec(table, columns)) if row else None

    def summary(self, table: TableSync, columns: list[ColumnSpec]) -> tuple[int, str | None]:
        """The database counts; digits beyond microseconds, which no target holds, are cut."""
        n, newest = self.query(summary_sql(table, columns)).first()
        newest = tidy_watermark(newest, _watermark_spec(table, columns))
        return int(n), newest and re.sub(r"(\.\d{6})\d{3}(?!\d)", r"\1", newest)

    def changed(self, tables, described, checkpoints: dict[str, str]) -> set[str]:
        """One statement asks many tables for their greatest watermarks."""
        known = [t for t in tables if t.table in checkpoints]
        specs = {t.table: _watermark_spec(t, described[t.table]) for t in known}

        def news(group: list[TableSync]) -> list[str]:
            sql = " UNION ALL ".join(max_sql(t, described[t.table], label=True) for t in group)
            return [
                name
                for name, newest in self.query(sql).collect()
                if newest is not None and tidy_watermark(newest, specs[name]) != checkpoints[name]
            ]

        groups = [known[i : i + TABLES_PER_STATEMENT] for i in range(0, len(known), TABLES_PER_STATEMENT)]
        return {name for found in at_once(self.spark, news, groups) for name in found}

    def scan(self, table: TableSync, columns: list[ColumnSpec], last_value: str | None) -> Scan | None:
        newest = self.watermark(table, columns)
        if last_value is not None and newest in (None, last_value):
            return None
        sql = scan_sql(table, columns, last_value, newest)
        return Scan(self.query(sql, predicates=self._ranges(table, columns, sql)), newest, bounded=True)

    def _ranges(self, table: TableSync, columns: list[ColumnSpec], sql: str) -> list[str]:
        """Predicates that cut one table into ranges of about as many rows each; none if it cannot be cut.

        The ranges are of the first whole-number key column, else of the watermark if it is a number or
        a time. Their ends are quantiles, so that dense stretches are cut finer. Either column is safe: a
        row that is changed during the read leaves the bounded scan altogether and comes with the next run.
        """
        n = self.num_partitions or self.spark.sparkContext.defaultParallelism
        if n < 2:
            return []
        keys = [find_column([c.name for c in columns], k) for k in table.primary_key]
        whole = [c for c in columns if c.name in keys and isinstance(c.spark_type, T.IntegralType)]
        watermark = _watermark_spec(table, columns)
        cuttable = isinstance(watermark.spark_type, (T.IntegralType, T.DateType, T.TimestampType))
        spec = whole[0] if whole else watermark if cuttable else None
        if spec is None:
            return []
        starts = [row[0] for row in self.query(quantile_sql(spec, sql, n)).collect()]
        return range_predicates(spec, [tidy_watermark(s, spec) for s in starts])


# ----------------------------------------------------------------------------- SQL text


def quoted(name: str) -> str:
    return "[" + name.replace("]", "]]") + "]"


def text_literal(value: str) -> str:
    return "N'" + value.replace("'", "''") + "'"


def catalog_sql(database: str | None, tables: list[str]) -> str:
    names = ", ".join(text_literal(t) for t in dict.fromkeys(tables))
    prefix = f"{database}." if database else ""
    return (
        "SELECT TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME, ORDINAL_POSITION, DATA_TYPE, "
        "CAST(NUMERIC_PRECISION AS int) AS NUMERIC_PRECISION, CAST(NUMERIC_SCALE AS int) AS NUMERIC_SCALE, "
        f"SCHEMA_NAME() AS DEFAULT_SCHEMA FROM {prefix}INFORMATION_SCHEMA.COLUMNS WHERE TABLE_NAME IN ({names})"
    )


def quantile_sql(spec: ColumnSpec, sql: str, n: int) -> str:
    """The least value of each of n parts of as many rows, as checkpoint text, in order; NULLs aside."""
    name = quoted(spec.name)
    parts = f"SELECT {name}, NTILE({n}) OVER (ORDER BY {name}) AS part FROM ({sql}) AS src WHERE {name} IS NOT NULL"
    shape = WATERMARK_TEXT.get(spec.type_name, WATERMARK_TEXT_OTHERWISE).format(w=f"MIN({name})")
    return f"SELECT {shape} AS low FROM ({parts}) AS parts GROUP BY part ORDER BY MIN({name})"


def range_predicates(spec: ColumnSpec, starts: list[str]) -> list[str]:
    """Ranges that begin at ``starts``; every value lies in exactly one, NULLs in the first."""
    name = quoted(spec.name)
    ends = [bound_sql(s, spec) for s in dict.fromkeys(starts)][1:]
    if not ends:
        return []
    between = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(ends, ends[1:])]
    return [f"{name} < {ends[0]} OR {name} IS NULL", *between, f"{name} >= {ends[-1]}"]


def projection_sql(columns: list[ColumnSpec]) -> str:
    """Every described column by name, so the order cannot drift from the description."""
    parts = []
    for c in columns:
        name = quoted(c.name)
        shape = TEXT_AT_SOURCE.get(c.type_name) if c.recognised else UNMAPPED_AT_SOURCE
        parts.append(f"{shape.format(c=name)} AS {name}" if shape else name)
    return ", ".join(parts)


def scan_sql(table: TableSync, columns: list[ColumnSpec], last_value: str | None, newest: str | None) -> str:
    spec = _watermark_spec(table, columns)
    w = quoted(spec.name)
    if newest is None:
        where = f"{w} IS NULL"  # nothing else was there when the bound was taken
    elif last_value is None:
        where = f"{w} <= {bound_sql(newest, spec)} OR {w} IS NULL"
    else:
        where = f"{w} > {bound_sql(last_value, spec)} AND {w} <= {bound_sql(newest, spec)}"
    return f"SELECT {projection_sql(columns)} FROM {table.table} WHERE {where}"


def max_sql(table: TableSync, columns: list[ColumnSpec], label: bool = False) -> str:
    prefix = f"{text_literal(table.table)} AS table_name, " if label else ""
    return f"SELECT {prefix}{_greatest_sql(table, columns)} AS watermark FROM {table.table}"


def summary_sql(table: TableSync, columns: list[ColumnSpec]) -> str:
    return f"SELECT COUNT_BIG(*) AS n, {_greatest_sql(table, columns)} AS newest FROM {table.table}"


def _greatest_sql(table: TableSync, columns: list[ColumnSpec]) -> str:
    spec = _watermark_spec(table, columns)
    return WATERMARK_TEXT.get(spec.type_name, WATERMARK_TEXT_OTHERWISE).format(w=f"MAX({quoted(spec.name)})")


def bound_sql(value: str, spec: ColumnSpec) -> str:
    """A checkpoint's text as a literal of a type the source compares without loss."""
    if spec.type_name in _NUMBER_TYPES:
        try:
            number = Decimal(value)
        except InvalidOperation:
            number = Decimal("NaN")
        if not number.is_finite():
            raise CheckpointMismatchError(f"the checkpoint of watermark column {spec.name} is not a number")
        return format(number, "f")
    if spec.type_name in BOUND_TYPES:
        # Checkpoint text may have nine digits, of which the source never fills the last two.
        value = re.sub(r"(\.\d{7})0+(?!\d)", r"\1", value)
        return f"CAST({text_literal(value)} AS {BOUND_TYPES[spec.type_name]})"
    return text_literal(value)


def tidy_watermark(text: str | None, spec: ColumnSpec) -> str | None:
    """The source's rendering in checkpoint form: fractions in groups of three digits."""
    if text is not None and spec.type_name in _PLAIN_NUMBERS:
        return plain_number(text, spec.type_name)
    if text is None or spec.type_name not in ("time", "datetime", "smalldatetime", "datetime2", "datetimeoffset"):
        return text.lower() if text is not None and spec.type_name == "uniqueidentifier" else text
    whole, _, fraction = text.strip().partition(".")
    fraction = fraction.ljust(9, "0") if fraction else ""
    while fraction.endswith("000"):
        fraction = fraction[:-3]
    tidy = f"{whole}.{fraction}" if fraction else whole
    return tidy.replace(" ", "T") + "+00:00" if spec.type_name == "datetimeoffset" else tidy


def plain_number(text: str, type_name: str) -> str:
    """A float or money value in the form the target's side renders it: shortest digits, no exponent."""
    value = float(text)
    if value != value or value in (float("inf"), float("-inf")):
        return {"nan": "NaN"}.get(str(value), str(value))
    if type_name == "real":  # the target holds the widened value
        value = struct.unpack("f", struct.pack("f", value))[0]
    shown = format(Decimal(repr(value)), "f")
    return shown.rstrip("0").rstrip(".") if "." in shown else shown


def _watermark_spec(table: TableSync, columns: list[ColumnSpec]) -> ColumnSpec:
    return next(c for c in columns if c.name.lower() == table.watermark_column.lower())
