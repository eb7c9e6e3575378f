"""The entry in a copy of the repository without the operators for training data."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHECK = """
import os
import __spark_entry__ as contract
assert contract.__file__.startswith(os.getcwd())
assert not [n for n in contract.queries() if n.startswith("op") or n == "pipeline"], "operators are gone"
assert set(contract.oracle_sql()) == set(contract.queries()) and len(contract.queries()) > 70
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", contract.queries()["full_scan_orders"](spark, "/root/testdata/sf0.001").limit(3).count())
"""


def copied(folder, *without):
    place = str(folder / "copy")
    shutil.copytree(ROOT, place, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "llm", *without))
    return place


def checked(place):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CHECK], cwd=place, env=environment, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "rows 3" in done.stdout


def test_without_the_folders(tmp_path):
    checked(copied(tmp_path))


def test_without_the_folders_and_the_pipeline(tmp_path):
    checked(copied(tmp_path, "corpus_pipeline.py"))
