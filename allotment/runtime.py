"""Shared-storage scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_LOCAL_ROOT: str | None = None
_SCOPES: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one ``spark.checkpoint.dir`` names.

    Intermediate tables must outlive any executor, so on a cluster the setting
    has to point at shared storage. Only a local master may fall back to a
    temporary folder.
    """
    global _LOCAL_ROOT
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="allotment-")
    return _LOCAL_ROOT


def run_folder(spark: SparkSession) -> str:
    """This application's part of the scratch folder."""
    return f"{scratch_root(spark)}/allotment/{spark.conf.get('spark.app.id')}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path in the scratch folder of the innermost scope, else the application's."""
    folder = _SCOPES[-1] if _SCOPES else run_folder(spark)
    return f"{folder}/{label}-{uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[str]:
    """Scratch written inside goes to a folder of its own, which is deleted at the end.

    Frames that read it stop working then, so write results inside.
    """
    folder = f"{run_folder(spark)}/{label}-{uuid4().hex}"
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application left in scratch; frames built on it stop working."""
    _delete(spark, run_folder(spark))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to scratch and return a scan of what was written.

    Used where several later steps read the same expensive frame: the scan
    survives the loss of executors without recomputing its inputs, prunes
    columns, and tells the planner its true size.
    """
    return materialise_watching(df, label, {})[0]


def materialise_watching(
    df: DataFrame, label: str, watch: Mapping[str, Column]
) -> tuple[DataFrame, dict[str, object]]:
    """The same, with aggregates over all rows taken by the job that writes them."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if not watch:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), {}
    seen = Observation()
    df.observe(seen, *[column.alias(name) for name, column in watch.items()]).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), dict(seen.get)
