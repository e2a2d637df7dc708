"""A whole run: control, extraction, Silver, index, gate, reconciliation, publication, audit."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as c
from ..operators import quality, reconcile, records
from ..operators.control import NothingToLoad, active_loads, normalise_control, valid_loads
from ..runtime import materialise, scratch_scope
from ..sources import sinks
from ..sources.extract import extract_all, read_catalogue
from ..sources.files import land_controlled
from ..sources.paths import target_below
from ..sources.tables import publish_view, read_roles, register_files, table_or_none
from . import index


class GateClosed(RuntimeError):
    """A critical check failed; its results are in the quality table."""


@dataclass(frozen=True)
class SilverStep:
    """Refresh ``target`` from ``source`` with one of the Silver transformations."""

    source: str
    target: str
    transform: Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Run:
    """One run. Tables are named; the rest has the defaults of the library."""

    execution_id: str
    environment: str
    process: str
    tables: Mapping[str, str]  # input and output roles of the index
    audit_table: str
    quality_table: str
    options: index.IndexOptions = index.IndexOptions()
    file_format: str = "parquet"
    silver: Sequence[SilverStep] = ()
    has_data: Sequence[tuple[str, str]] = ()  # (table, rule)
    comparison_table: str | None = None
    tolerance: float = 0.0
    details: Mapping[str, str] = field(default_factory=dict)

    @property
    def context(self) -> quality.RunContext:
        return quality.RunContext(self.execution_id, self.environment, self.process)


def audit(spark: SparkSession, run: Run, status: str, task: str, message: str) -> None:
    event = records.audit_event(
        spark, ambiente=run.environment, process=run.process, run_id=run.execution_id,
        execution_id=run.execution_id, status=status, name=run.process, task=task, message=message,
    )
    sinks.append_rows(event, run.audit_table, file_format=run.file_format)


def extract(
    spark: SparkSession,
    run: Run,
    control: DataFrame,
    owner: str,
    system: str,
    root: str,
    metrics_table: str | None = None,
    read: Callable = read_catalogue,
    fail_fast: bool = False,
    table_name: Callable[[Mapping[str, object]], str | None] | None = None,
    valid: tuple[int, int] = (0, 0),
) -> DataFrame:
    """Land the active objects of the run's process, one system and one owner.

    ``table_name`` registers what is landed for the Silver step. Metrics are appended
    before any error is raised.
    """
    loads = publish_view(run_loads(control, run.process, system, owner, valid), c.CONTROL_VIEW)
    metrics = extract_all(
        spark, loads, root, execution_id=run.execution_id, process_name=run.process, source_system=system,
        read=read, default_format=run.file_format, fail_fast=fail_fast, raise_errors=False, table_name=table_name,
    )
    return _recorded(metrics, run, metrics_table, f"extraction from {system} failed for some objects")


def land_files(
    spark: SparkSession,
    run: Run,
    control: DataFrame,
    owner: str,
    system: str,
    source_root: str,
    target_root: str,
    metrics_table: str | None = None,
    fail_fast: bool = False,
    tables: Mapping[str, str] | None = None,
    valid: tuple[int, int] = (0, 0),
) -> DataFrame:
    """Land the files of the run's process, one system and one owner, as ``extract`` does objects.

    Files are copied side by side; with ``fail_fast`` they go one load order after the
    other and the first order with a failure ends the step. ``tables`` (target name ->
    catalogue name) registers landed CSV files, with their header, for the Silver step.
    """
    loads = run_loads(control, run.process, system, owner, valid)
    steps = [loads]
    if fail_fast:
        orders = [row[0] for row in loads.select("orden_ejecucion").distinct().orderBy("orden_ejecucion").toLocalIterator()]
        steps = [loads.filter(F.col("orden_ejecucion").eqNullSafe(F.lit(order))) for order in orders]
    metrics = None
    for step in steps:
        landed = land_controlled(spark, step, source_root, target_root)
        metrics = landed if metrics is None else metrics.unionByName(landed)
        if fail_fast and not landed.filter("status = 'failed'").isEmpty():
            break
    for name, table in (tables or {}).items():
        path = loads.filter(F.col("nombre_archivo_destino") == name).select(target_below(target_root)).first()
        if path is not None and not metrics.filter((F.col("archivo_destino") == path[0]) & (F.col("status") == "success")).isEmpty():
            register_files(spark, table, path[0], "csv", header="true")
    return _recorded(metrics, run, metrics_table, f"landing files of {system} failed for some files")


def run_loads(control: DataFrame, process: str, system: str, owner: str, valid: tuple[int, int] = (0, 0)) -> DataFrame:
    """The control rows that a run may load, in load order.

    A frame with ``valid_from`` and ``valid_to`` is also held against the given dates
    (yyyymmdd, 0 for open).
    """
    rows = normalise_control(control)
    if not c.missing_columns(control, ["valid_from", "valid_to"]):
        loads = valid_loads(normalise_control(control, keep=("valid_from", "valid_to")), process, system, owner, *valid)
        if loads.isEmpty():
            raise NothingToLoad(f"no valid control row of {process}, {system}, {owner}")
        return loads.orderBy(F.col("orden_ejecucion").asc(), F.col("nombre_archivo_fuente").asc())
    mine = rows.filter((F.col("proceso") == process) & (F.col("sistema_fuente") == system))
    return active_loads(mine, owner)


def _recorded(metrics: DataFrame, run: Run, table: str | None, failure: str) -> DataFrame:
    if table:
        sinks.append_rows(metrics, table, file_format=run.file_format)
    if not metrics.filter("status = 'failed'").isEmpty():
        raise RuntimeError(f"{failure}; see the metrics")
    return metrics


def refresh_silver(spark: SparkSession, run: Run) -> dict[str, int]:
    """Rows written per Silver table."""
    return {
        step.target: sinks.refresh_table(
            step.transform(spark.table(step.source), run.execution_id), step.target, file_format=run.file_format
        )
        for step in run.silver
    }


def build_index(spark: SparkSession, run: Run) -> DataFrame:
    """Compute the index, write snapshot and history; return one metrics record.

    It has the rows of the six inputs, those of the index as counted by the job that
    wrote it, and the names of both tables.
    """
    inputs = read_roles(spark, run.tables)
    c.require_roles(run.tables, c.OUTPUT_ROLES)
    ranked = index.stamp(index.priority_index(inputs, run.options), run.execution_id)
    written = sinks.write_gold(ranked, run.tables["index"], run.tables["index_history"], run.file_format)
    rows = {f"rows_{row.tabla}": row.filas for row in index.row_counts(inputs).collect()}
    record = rows | {
        "execution_id": run.execution_id, "rows_index": written,
        "index_table": run.tables["index"], "index_history_table": run.tables["index_history"],
    }
    return records.records(spark, [record], c.RUN_METRIC_SCHEMA)


def check(spark: SparkSession, run: Run) -> DataFrame:
    """Quality rules and reconciliation: append all results, then stop on a critical failure."""
    gold = run.tables["index"]
    checks = [quality.TableCheck(name, table_or_none(spark, name), rule) for name, rule in run.has_data]
    checks.append(quality.TableCheck(
        gold, table_or_none(spark, gold), "gold_has_data", key="cod_cliente", critical=c.INDEX_CRITICAL_COLUMNS,
    ))
    compared = reconcile.reconcile(
        spark, run.context, target_name=gold, target=table_or_none(spark, gold),
        source_name=run.comparison_table, source=table_or_none(spark, run.comparison_table),
        tolerance=run.tolerance,
    )
    # Written once: the log and the gate see the same results, and only this attempt's.
    results = materialise(quality.run_checks(spark, run.context, checks).unionByName(compared), "checks")
    sinks.append_rows(results, run.quality_table, file_format=run.file_format)
    if not quality.gate_open(results):
        raise GateClosed(f"critical checks failed; see {run.quality_table}")
    return results


def full_run(
    spark: SparkSession,
    run: Run,
    publish: Callable[[DataFrame], Mapping[str, object]],
    before: Sequence[Callable[[SparkSession, Run], object]] = (),
) -> Mapping[str, object]:
    """All steps in order; ``before`` holds the extractions. The gate always precedes publishing.

    The run's intermediate tables are deleted at its end, whether it fails or not.
    """
    audit(spark, run, "STARTED", "audit_start", "run started")
    try:
        with scratch_scope(spark, "run"):
            for step in before:
                step(spark, run)
            refresh_silver(spark, run)
            build_index(spark, run)
            check(spark, run)
            metrics = publish(spark.table(run.tables["index"]))
        if metrics["status"] != "success":
            raise RuntimeError(f"publication failed: {metrics['error_message']}")
    except Exception as error:
        audit(spark, run, "FAILED", "audit_finish", str(error))
        raise
    audit(spark, run, "SUCCEEDED", "audit_finish", f"published {metrics['rows_written']} rows")
    return metrics
