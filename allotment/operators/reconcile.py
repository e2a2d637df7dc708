"""Compare the row count of a result with that of a comparison table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import CRITICAL, WARNING, RunContext, one_row, result


def compare_counts(expected: Column, found: Column, tolerance: float) -> tuple[Column, Column, Column]:
    """(passed, difference, allowed rows); ``tolerance`` is a fraction of the expected count."""
    difference = F.abs(found - expected)
    allowed = F.floor(F.abs(expected) * F.lit(float(tolerance)))
    return difference <= allowed, difference, allowed


def reconcile(
    spark: SparkSession,
    context: RunContext,
    *,
    target_name: str,
    target: DataFrame | None,
    source_name: str | None = None,
    source: DataFrame | None = None,
    tolerance: float = 0.0,
    rule: str = "adf_reconciliation_count",
) -> DataFrame:
    """One result row.

    Without a comparison table (not named, or named but missing) the check is
    skipped and passes as a warning; a missing target is a critical failure.
    """
    if not source_name:
        return one_row(spark).select(*result(
            context, F.lit(target_name), F.lit(rule), F.lit(True), F.lit(0),
            F.lit("no comparison table given; skipped"), WARNING,
        ))
    if source is None:
        return one_row(spark).select(*result(
            context, F.lit(source_name), F.lit(rule), F.lit(True), F.lit(0),
            F.lit("comparison table not available; skipped"), WARNING,
        ))
    if target is None:
        return one_row(spark).select(*result(
            context, F.lit(target_name), F.lit(rule), F.lit(False), F.lit(1),
            F.lit("table to reconcile not available"), CRITICAL,
        ))
    counts = one_row(spark).select(
        source.agg(F.count("*")).scalar().alias("expected"),
        target.agg(F.count("*")).scalar().alias("found"),
    )
    passed, difference, allowed = compare_counts(F.col("expected"), F.col("found"), tolerance)
    message = F.format_string(
        "expected=%d; found=%d; difference=%d; allowed=%d", F.col("expected"), F.col("found"), difference, allowed
    )
    return counts.select(*result(
        context, F.lit(target_name), F.lit(rule), passed, F.when(passed, 0).otherwise(difference), message,
    ))
