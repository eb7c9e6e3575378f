"""The few file operations a driver needs, through Hadoop so that any URI works."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemark.errors import ConcurrentWriteError, SettingError, TargetError

# The setting by which a caller states that a local path is a folder all executors share.
SHARED_SETTING = "spark.tidemark.sharedOutput"

# Metadata calls wait for the store, so several are under way at a time.
CALLS_AT_ONCE = 16

_RACE = "another writer committed first; run again"

_known: WeakKeyDictionary = WeakKeyDictionary()


def storage(spark: SparkSession) -> Storage:
    """The session's storage; its Java classes are looked up once."""
    if spark not in _known:
        _known[spark] = Storage(spark)
    return _known[spark]


def at_once(spark: SparkSession, call: Callable, items: Iterable) -> list:
    """``call`` of every item, in order, several at a time."""
    items = list(items)
    if len(items) < 2:
        return [call(item) for item in items]
    with ThreadPoolExecutor(min(CALLS_AT_ONCE, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(call), items))


def require_shared(spark: SparkSession, uri: str) -> None:
    """Refuses a local path on a cluster, where each executor would write to a disk of its own.

    A folder beneath ``spark.checkpoint.dir`` is shared, and so is whatever SHARED_SETTING vouches for.
    """
    if _in_one_process(spark) or storage(spark).scheme(uri) != "file":
        return
    shared = _shared_folder(spark)
    plain = lambda path: path.removeprefix("file:").lstrip("/")
    if shared and plain(uri).startswith(plain(shared).rstrip("/") + "/"):
        return
    if spark.conf.get(SHARED_SETTING, "false").lower() != "true":
        raise SettingError(f"{uri} is a local path; if all executors share it, set {SHARED_SETTING} to true")


def _shared_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def _in_one_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


class Storage:
    def __init__(self, spark: SparkSession):
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path, self._context = hadoop.Path, hadoop.FileContext
        self._no_overwrite = hadoop.Options.Rename.NONE
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._array = spark._jvm.java.lang.reflect.Array
        self._conf = spark._jsc.hadoopConfiguration()

    def _fs(self, uri: str):
        path = self._path(uri)
        return path.getFileSystem(self._conf), path

    def list(self, uri: str) -> list[tuple[str, int]]:
        """(name, modification time in ms) of the entries; empty if there is no such folder.

        Only a missing folder counts as absent. Any other failure is raised, so that an
        unreachable store is never taken for an empty one.
        """
        fs, path = self._fs(uri)
        try:
            entries = fs.listStatus(path)
        except Py4JJavaError as e:
            if _is(e, "FileNotFoundException"):
                return []
            raise TargetError(f"cannot list {uri}") from None
        return [(s.getPath().getName(), s.getModificationTime()) for s in entries]

    def scheme(self, uri: str) -> str:
        return self._fs(uri)[0].getScheme()

    def size(self, uri: str) -> int:
        fs, path = self._fs(uri)
        return fs.getContentSummary(path).getLength()

    def read_json(self, uri: str) -> dict:
        fs, path = self._fs(uri)
        try:
            stream = fs.open(path)
            try:
                return json.loads(self._io.toString(stream, "UTF-8"))
            finally:
                stream.close()
        except Py4JJavaError:
            raise TargetError(f"cannot read {uri}") from None

    def create_json(self, folder: str, name: str, content: dict) -> None:
        """Publishes a complete file under a name that must not exist yet.

        Written aside first, then given its name unless that is taken: a reader sees the
        whole file or none, and the second of two writers fails. Local disk (a hard link),
        HDFS and ABFS (a rename) do that atomically; plain object stores check, then rename.
        """
        fs, target = self._fs(f"{folder}/{name}")
        aside = self._path(f"{folder}/.{name}.{uuid.uuid4().hex}")
        text = json.dumps(content).encode()
        if fs.getScheme() == "file":
            self._link(fs.makeQualified(aside).toUri().getPath(), fs.makeQualified(target).toUri().getPath(), text)
            return
        try:
            out = fs.create(aside, False)
            try:
                out.write(bytearray(text))
            finally:
                out.close()
        except Py4JJavaError:
            raise TargetError(f"cannot write {folder}/{name}") from None
        try:
            self._rename(fs, aside, target)
        except Py4JJavaError as e:
            fs.delete(aside, False)
            if _is(e, "FileAlreadyExistsException"):
                raise ConcurrentWriteError(_RACE) from None
            raise TargetError(f"cannot write {folder}/{name}") from None

    def _rename(self, fs, aside, target) -> None:
        """Renames unless the new name is taken."""
        try:
            context = self._context.getFileContext(target.toUri(), self._conf)
        except Py4JJavaError as e:
            if not _is(e, "UnsupportedFileSystemException"):
                raise
            # A store without that call: look first, then rename.
            if fs.exists(target) or not fs.rename(aside, target):
                fs.delete(aside, False)
                raise ConcurrentWriteError(_RACE) from None
            return
        options = self._array.newInstance(self._no_overwrite.getClass(), 1)
        options[0] = self._no_overwrite
        context.rename(context.makeQualified(aside), context.makeQualified(target), options)

    @staticmethod
    def _link(aside: str, target: str, text: bytes) -> None:
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(aside, "xb") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(aside, target)
        except FileExistsError:
            raise ConcurrentWriteError(_RACE) from None
        except OSError:
            # A mount without hard links: still exclusive, though written in place.
            try:
                with open(target, "xb") as file:
                    file.write(text)
            except FileExistsError:
                raise ConcurrentWriteError(_RACE) from None
        finally:
            os.unlink(aside)

    def delete(self, uri: str) -> None:
        fs, path = self._fs(uri)
        fs.delete(path, True)


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getName().endswith(name)
