"""Quality rules, their result records and the gate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as c

PASSED, FAILED = "PASSED", "FAILED"
CRITICAL, WARNING = "CRITICAL", "WARNING"


@dataclass(frozen=True)
class RunContext:
    """What every result record repeats."""

    execution_id: str
    environment: str
    process: str


@dataclass(frozen=True)
class TableCheck:
    """A table (name, and its frame or None if missing) with the rules to apply."""

    name: str
    rows: DataFrame | None
    has_data_rule: str
    key: str | None = None
    critical: Sequence[str] = ()
    rule_prefix: str = "gold"


def critical_null_flag(columns: Sequence[str]) -> Column:
    """1 for a row in which any of the columns is NULL, else 0."""
    if not columns:
        return F.lit(0)
    any_null = reduce(Column.__or__, [F.col(name).isNull() for name in columns])
    return any_null.cast("int")


def profile(df: DataFrame, key: str | Sequence[str] | None = None, critical: Sequence[str] = ()) -> DataFrame:
    """One row: number of rows, rows with critical NULLs, duplicated keys.

    All three come from one pass. With a key the table is pre-aggregated per
    key before the shuffle, so a heavily repeated key costs no more than others;
    a NULL key counts as a key.
    """
    nulls = critical_null_flag(critical).cast("bigint")
    if not key:
        return df.agg(
            F.count("*").alias("filas"),
            F.coalesce(F.sum(nulls), F.lit(0)).alias("nulos"),
            F.lit(0).cast("bigint").alias("duplicados"),
        )
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum(nulls).alias("_nulls"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("filas"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("nulos"),
        F.count_if(F.col("_n") > 1).alias("duplicados"),
    )


def critical_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of rows in which any column is NULL."""
    return profile(df, critical=columns).select(F.col("nulos").alias("cantidad"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of keys that occur more than once."""
    return profile(df, key=keys).select(F.col("duplicados").alias("cantidad"))


def result(
    context: RunContext,
    table: Column,
    rule: Column,
    passed: Column,
    errors: Column,
    message: Column,
    severity: str | Column | None = CRITICAL,
) -> list[Column]:
    """The ten columns of a result record. A blank severity is WARNING."""
    level = severity if isinstance(severity, Column) else F.lit(severity)
    return [
        F.lit(context.execution_id).alias("execution_id"),
        F.lit(context.environment).alias("ambiente"),
        F.lit(context.process).alias("proceso"),
        table.alias("tabla"),
        rule.alias("regla"),
        F.when(passed, PASSED).otherwise(FAILED).alias("resultado"),
        F.coalesce(errors, F.lit(0)).cast("bigint").alias("cantidad_errores"),
        F.upper(F.when(level != "", level).otherwise(WARNING)).alias("severidad"),
        message.alias("mensaje"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
    ]


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1)


def check_table(spark: SparkSession, context: RunContext, check: TableCheck) -> DataFrame:
    """Result rows of one table: data present, columns, critical NULLs, duplicate keys."""
    name = F.lit(check.name)
    if check.rows is None:
        return one_row(spark).select(*result(
            context, name, F.lit(check.has_data_rule), F.lit(False), F.lit(1),
            F.lit(f"table {check.name} does not exist"),
        ))
    missing = c.missing_columns(check.rows, check.critical)
    deep = bool(check.critical) and not missing
    stats = profile(check.rows, check.key if deep else None, check.critical if deep else ())

    def rule(name: str, errors: Column, text: Column) -> Column:
        return F.struct(F.lit(name).alias("rule"), errors.cast("bigint").alias("errors"), text.alias("text"))

    def counted(text: str, count: Column) -> Column:
        return F.concat(F.lit(text), count)

    nulls, repeated = F.col("nulos"), F.col("duplicados")
    rules = [rule(check.has_data_rule, F.col("filas") == 0, counted("rows: ", F.col("filas")))]
    if missing:
        text = F.lit(f"missing columns: {', '.join(missing)}")
        rules.append(rule(f"{check.rule_prefix}_required_columns", F.lit(len(missing)), text))
    elif check.critical:
        text = counted(f"rows with NULL in {'/'.join(check.critical)}: ", nulls)
        rules.append(rule(f"{check.rule_prefix}_critical_nulls", nulls, text))
        if check.key:
            text = counted(f"duplicated {check.key}: ", repeated)
            rules.append(rule(f"{check.rule_prefix}_duplicate_{check.key}", repeated, text))
    found = stats.select(F.inline(F.array(*rules)))
    return found.select(*result(
        context, name, F.col("rule"), F.col("errors") == 0, F.col("errors"), F.col("text"),
    ))


def run_checks(spark: SparkSession, context: RunContext, checks: Iterable[TableCheck]) -> DataFrame:
    """Result rows of all tables as one plan, so all tables are profiled in one job."""
    parts = [check_table(spark, context, check) for check in checks]
    return reduce(DataFrame.unionByName, parts)


def gate_open(results: DataFrame) -> bool:
    """False when any critical rule failed."""
    return results.filter((F.col("severidad") == CRITICAL) & (F.col("resultado") == FAILED)).isEmpty()
