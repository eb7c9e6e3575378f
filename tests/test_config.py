import pytest

from tidemark.config import SyncConfig, TableName, TableSync, build_catalog
from tidemark.errors import (
    ConcurrentWriteError,
    SettingError,
    SourceUnavailableError,
    SyncError,
    UnsafeNameError,
    in_table,
    redact,
)
from tidemark.plans.sync import plan_concurrency
from tidemark.sources import connection


@pytest.mark.parametrize(
    "name, path",
    [("customers", "customers"), ("dbo.customers", "dbo/customers"), ("appdb.dbo.customers", "appdb/dbo/customers")],
)
def test_names_of_one_to_three_parts_become_paths(name, path):
    assert TableName.parse(name).path == path


@pytest.mark.parametrize(
    "name",
    ["users; DROP TABLE x", "users'", 'users"', "us\\ers", "", "dbo..customers", ".", "..", "server.appdb.dbo.customers",
     "my table", "[customers]", "[dbo].[customers]", "a\0b"],
)
def test_unsafe_names_are_refused(name):
    with pytest.raises(UnsafeNameError):
        TableName.parse(name)


def test_a_bare_string_is_a_single_key():
    assert TableSync("t", "w", "id").primary_key == ("id",)
    assert build_catalog([{"table": "t", "watermark_column": "w", "primary_key": "id"}])[0].primary_key == ("id",)


@pytest.mark.parametrize("missing", ["table", "watermark_column", "primary_key"])
def test_a_missing_entry_is_a_value_error(missing):
    entry = {"table": "t", "watermark_column": "w", "primary_key": "id"}
    del entry[missing]
    with pytest.raises(ValueError, match=missing):
        build_catalog([entry])


@pytest.mark.parametrize("change", [{"watermark_column": " "}, {"primary_key": []}, {"primary_key": ["", " "]}])
def test_blank_watermark_or_key_is_refused(change):
    with pytest.raises(ValueError):
        build_catalog([{"table": "t", "watermark_column": "w", "primary_key": "id"} | change])


def test_a_table_may_be_listed_once_whatever_its_case():
    with pytest.raises(ValueError, match="more than once"):
        build_catalog([TableSync("dbo.T", "w", "id"), TableSync("DBO.t", "w", "id")])
    assert build_catalog([]) == []


@pytest.mark.parametrize("settings", [{"output_uri": " "}, {"checkpoint_uri": ""}, {"fetch_batch_size": 0}])
def test_unusable_settings_are_refused(settings):
    with pytest.raises(SettingError):
        SyncConfig(**({"output_uri": "/o"} | settings)).validate()


def test_checkpoints_live_beside_the_tables_unless_told_otherwise():
    config = SyncConfig("/lake/")
    assert config.table_uri("dbo.t") == "/lake/dbo/t"
    assert config.checkpoint_table_uri("dbo.t") == "/lake/_streamer_checkpoints/dbo/t"
    assert SyncConfig("/lake", "/elsewhere/").checkpoint_table_uri("db.dbo.t") == "/elsewhere/db/dbo/t"
    assert SyncConfig("").checkpoint_uri == ""


@pytest.mark.parametrize(
    "tables, cores, requested, expected",
    [(0, 8, None, 0), (3, 64, None, 3), (3, 64, 100, 3), (1000, 8, None, 32), (100, 8, 4, 4), (5, 0, None, 4)],
)
def test_concurrency(tables, cores, requested, expected):
    assert plan_concurrency(tables, cores, requested) == expected


def test_concurrency_below_one_is_refused():
    with pytest.raises(ValueError):
        plan_concurrency(10, 8, 0)


@pytest.mark.parametrize("text", ["Server=x;Password=s3cret;", "server=x; PWD = s3cret", "junk;password=s3cret"])
def test_the_password_is_found_and_scrubbed(text):
    assert connection.chosen(connection.settings(text), "password") == "s3cret"
    message = redact(f"login with {text} failed, s3cret was wrong", [text, *connection.secrets_of(text)])
    assert "s3cret" not in message and text not in message


@pytest.mark.parametrize(
    "written, password",
    [('"a;b"', "a;b"), ("'a;b=c'", "a;b=c"), ("{a;b}}c}", "a;b}c"), ('"say ""hi"";"', 'say "hi";'), ("'it''s'", "it's"), ("a\"b", 'a"b')],
)
def test_quoted_passwords_are_read_and_scrubbed_whole(written, password):
    text = f"Server=x;Password={written};Database=d"
    found = connection.settings(text)
    assert (found["password"], found["database"], found["server"]) == (password, "d", "x")
    for quote in (password, written):
        left = redact(f"refused: {quote}!", connection.secrets_of(text))
        assert "[redacted]" in left and not any(part in left for part in (password, "a;b", ";b", "it''s"))


def test_errors_are_the_builtin_a_caller_expects_and_name_the_table_once():
    assert issubclass(ConcurrentWriteError, RuntimeError) and issubclass(SourceUnavailableError, ConnectionError)
    error = in_table(in_table(SourceUnavailableError("down"), "dbo.t"), "dbo.u")
    assert str(error) == "dbo.t: down" and error.table == "dbo.t" and isinstance(error, SyncError)
    assert str(in_table(KeyError("x"), "dbo.t")) == "'x'"
