"""Reading the given tables, and intermediate tables in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..runtime import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to cut lineage; a table that a later one replaces can be dropped.

    The folder is the one that ``spark.checkpoint.dir`` names, which all executors
    share, so a lost executor costs no more than the tasks it was running.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """The frame as written; ``label`` replaces an earlier table of that label."""
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.drop(label)
        self._paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            path = self._paths.pop(label, None)
            if path is not None:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
