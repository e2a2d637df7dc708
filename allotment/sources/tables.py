"""Catalogue tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from .. import contracts as c


def table_exists(spark: SparkSession, name: str) -> bool:
    """True when the table can be read; a metadata lookup, no job. Any error means no."""
    try:
        if spark.catalog.tableExists(name):
            return True
    except PySparkException:
        pass
    try:
        spark.table(name).schema
        return True
    except PySparkException:
        return False


def table_or_none(spark: SparkSession, name: str | None) -> DataFrame | None:
    return spark.table(name) if name and table_exists(spark, name) else None


def read_roles(spark: SparkSession, tables: Mapping[str, str | DataFrame]) -> dict[str, DataFrame]:
    """The model's input frames from a role -> table name (or frame) mapping."""
    c.require_roles(tables, c.INPUT_ROLES)
    return {
        role: source if isinstance(source, DataFrame) else spark.table(source)
        for role, source in ((role, tables[role]) for role in c.INPUT_ROLES)
    }


def register_files(spark: SparkSession, name: str, path: str, file_format: str = "parquet", **options: str) -> DataFrame:
    """Register files under a catalogue name; an earlier registration is replaced, its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.catalog.createTable(name, path=path, source=file_format, **options)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register the frame under a fixed name for the next step."""
    df.createOrReplaceTempView(name)
    return df
