"""Exceptions, credential redaction and table annotation.

Every class derives from the builtin a caller would catch, so a retry policy can be
written against ``ConnectionError`` or ``RuntimeError`` without importing this module.
No message holds a row value, a password or a connection string.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.errors import PySparkException


class SyncError(Exception):
    """Base of everything raised here; remembers the table it was annotated with."""

    table: str | None = None

    def __str__(self) -> str:
        text = super().__str__()
        return f"{self.table}: {text}" if self.table else text


class SettingError(SyncError, ValueError, RuntimeError):
    """A run setting (output location, batch size, table list) is unusable."""


class MissingConfigError(SyncError, ValueError):
    """A table has no watermark column or no primary key."""


class UnsafeNameError(SyncError, ValueError):
    """A table or column name cannot be placed into SQL or a path."""


class TableNotFoundError(SyncError, ValueError):
    """The source does not know the table, or the account may not see it."""


class ColumnNotFoundError(SyncError, ValueError):
    """A configured watermark or key column does not exist."""


class InvalidValueError(SyncError, ValueError):
    """A fetched value contradicts its column's declared type."""


class SchemaConflictError(SyncError, ValueError):
    """A source column changed its type since the target was created."""


class CheckpointMismatchError(SyncError, ValueError):
    """The stored checkpoint cannot be used with the configured watermark column."""


class SourceUnavailableError(SyncError, ConnectionError):
    """The source could not be reached or refused the login."""


class SourceQueryError(SyncError, ValueError):
    """A statement failed on an established session."""


class TargetError(SyncError, RuntimeError):
    """Writing or reading a target or checkpoint table failed."""


class ConcurrentWriteError(SyncError, RuntimeError):
    """Another writer committed first. Nothing was changed; run again."""


# Fixed text: conform() raises it inside a task and translate() recognises it here.
INVALID_VALUE = "column {column} holds something other than {expected}"
_INVALID_VALUE_RE = re.compile(r"column (?P<column>.+?) holds something other than (?P<expected>[a-z]+(\(\d+,\d+\))?)")

# Spark names the condition, then the value, then an SQLSTATE of class 22 for bad data.
_DATA_ERROR_RE = re.compile(r"\[(?P<condition>[A-Z_]+)[^\]]*\](?:(?!SQLSTATE).)*SQLSTATE: 22", re.DOTALL)

# Fixed text: fragments by which JDBC drivers report an unreachable source.
_CONNECT_MARKERS = (
    "login failed",
    "connection refused",
    "connection to the host",
    "communications link failure",
    "sqlnontransientconnectionexception",
    "no suitable driver",
    "unknownhostexception",
    "socket timeout",
    "login timeout",
)


# Fixed text: fragments by which JDBC drivers report that a wait was too long.
_TIMEOUT_MARKERS = ("read timed out", "sockettimeoutexception", "socket timeout", "query has timed out")


@contextmanager
def during(step: str):
    """Names the step in which the source did not answer in time."""
    try:
        yield
    except Exception as e:
        if _is_spark_failure(e) and any(marker in str(e).lower() for marker in _TIMEOUT_MARKERS):
            raise SourceUnavailableError(f"the source took too long while {step}") from None
        raise


def redact(message: str, secrets) -> str:
    """Replaces every secret in ``message``; longest first, so no fragment survives."""
    for secret in sorted({s for s in secrets if s}, key=len, reverse=True):
        message = message.replace(secret, "[redacted]")
    return message


def in_table(error: BaseException, table: str) -> BaseException:
    """Names the table on one of our errors, once."""
    if isinstance(error, SyncError) and error.table is None:
        error.table = table
    return error


def translate(error: BaseException, secrets=()) -> BaseException:
    """Turns a Spark failure into one of ours; other errors come back unchanged.

    The caller raises the result ``from None``: a Java cause chain may quote the URL.
    """
    if isinstance(error, SyncError) or not _is_spark_failure(error):
        return error
    text = redact(str(error), secrets)
    invalid = _INVALID_VALUE_RE.search(text)
    if invalid:
        return InvalidValueError(INVALID_VALUE.format(**invalid.groupdict()))
    bad_data = _DATA_ERROR_RE.search(text)
    if bad_data:
        return InvalidValueError(f"a source value cannot be converted ({bad_data['condition']})")
    first_line = next((line.strip() for line in text.splitlines() if line.strip()), "Spark job failed")
    lowered = text.lower()
    if any(marker in lowered for marker in _CONNECT_MARKERS):
        return SourceUnavailableError(first_line)
    if "java.sql." in lowered or "sqlexception" in lowered or "sqlserverexception" in lowered:
        return SourceQueryError(first_line)
    return TargetError(first_line)


def _is_spark_failure(error: BaseException) -> bool:
    return isinstance(error, PySparkException) or type(error).__module__.startswith("py4j.")
