"""Shared by the operators: folds, scratch tables, tokenizer files."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows whose crc32(id as text) mod 3 is this are held out from every training step.
HELD_OUT = 1


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, whose Python may not have it installed.

    The archive lies in the shared folder, from where Spark hands it out.
    """
    from pyarrow import fs

    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    place = scratch(spark)
    store, path = fs.FileSystem.from_uri(place)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/tidemark_package.zip") as out:
        out.write(held.getvalue())
    context.addPyFile(f"{place}/tidemark_package.zip")
    _SHIPPED.add(context.applicationId)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(id_column: str) -> Column:
    """Whether a row is kept from training; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == HELD_OUT, F.lit(False))


def scratch(spark: SparkSession) -> str:
    """A fresh folder in the cluster's shared folder; a local one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster is a cluster
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="llm-")


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows as a table on shared storage: computed once, and safe from lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file. The files are installed beside the libraries."""
    import public_tokenizers

    return public_tokenizers.path(name)
