"""Look at physical plans."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df: DataFrame) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
