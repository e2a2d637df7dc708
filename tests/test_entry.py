"""The entry works without the optional package, and without a library that the package needs."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = """
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
names = entry.queries()
assert len(names) >= 60 and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names), sorted(names)
assert set(entry.oracle_sql()) <= set(names)
"""
RUN = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
assert names["duplicate_keys"](spark, "/root/testdata/sf0.001").count() > 0
"""


def run(folder: Path, code: str) -> None:
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr


def test_without_the_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "llm", "__pycache__")])
    assert not (copy / "allotment/llm").exists() and not (copy / "tests/llm").exists()
    run(copy, COUNT.format(missing="no_such_library") + RUN)


@pytest.mark.parametrize("library", ["ahocorasick", "xxhash", "public_tokenizers"])
def test_without_a_library(library):
    run(ROOT, COUNT.format(missing=library))
