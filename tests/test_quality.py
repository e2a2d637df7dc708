from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from allotment import contracts as c
from allotment.operators import quality, reconcile, records
from allotment.operators.quality import TableCheck

CONTEXT = quality.RunContext("run-1", "dev", "stock")


def index_rows(spark, rows):
    return spark.createDataFrame(rows, "cod_cliente string, prioridad bigint, Estatus string")


def by_rule(results):
    return {r.regla: (r.resultado, r.cantidad_errores, r.severidad) for r in results.collect()}


def gold(spark, df):
    return quality.run_checks(spark, CONTEXT, [
        TableCheck("gold", df, "gold_has_data", "cod_cliente", c.INDEX_CRITICAL_COLUMNS)
    ])


def test_record_layout(spark):
    results = gold(spark, index_rows(spark, [("a", 1, "N")]))
    assert results.schema.names == c.QUALITY_SCHEMA.names
    assert [f.dataType for f in results.schema] == [f.dataType for f in c.QUALITY_SCHEMA]
    row = results.first()
    assert (row.execution_id, row.ambiente, row.proceso, row.tabla) == ("run-1", "dev", "stock", "gold")
    dt.datetime.fromisoformat(row.timestamp)


def test_good_table(spark):
    results = gold(spark, index_rows(spark, [("a", 1, "N"), ("b", 2, "N")]))
    assert by_rule(results) == {
        "gold_has_data": ("PASSED", 0, "CRITICAL"),
        "gold_critical_nulls": ("PASSED", 0, "CRITICAL"),
        "gold_duplicate_cod_cliente": ("PASSED", 0, "CRITICAL"),
    }
    assert quality.gate_open(results)


def test_nulls_and_duplicates(spark):
    # NULL is a key: two NULL codes are one duplicated key.
    rows = [("a", 1, "N"), ("a", 2, None), ("a", 3, "N"), (None, 4, "N"), (None, None, "N"), ("b", 5, "N")]
    results = gold(spark, index_rows(spark, rows))
    found = by_rule(results)
    assert found["gold_critical_nulls"] == ("FAILED", 3, "CRITICAL")
    assert found["gold_duplicate_cod_cliente"] == ("FAILED", 2, "CRITICAL")
    assert not quality.gate_open(results)


def test_missing_columns_suppress_the_deep_rules(spark):
    found = by_rule(gold(spark, index_rows(spark, [("a", 1, "N")]).drop("prioridad", "Estatus")))
    assert found == {"gold_has_data": ("PASSED", 0, "CRITICAL"), "gold_required_columns": ("FAILED", 2, "CRITICAL")}


def test_empty_and_missing_tables(spark):
    empty = by_rule(gold(spark, index_rows(spark, [])))
    assert empty["gold_has_data"] == ("FAILED", 1, "CRITICAL")
    assert empty["gold_critical_nulls"][0] == empty["gold_duplicate_cod_cliente"][0] == "PASSED"
    missing = gold(spark, None)
    assert by_rule(missing) == {"gold_has_data": ("FAILED", 1, "CRITICAL")}
    assert "does not exist" in missing.first().mensaje


def test_profile_counts(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 400, 0).otherwise(F.col("id")))
    assert tuple(quality.profile(df, "k", ["id"]).first()) == (1000, 0, 1)
    assert tuple(quality.profile(df).first()) == (1000, 0, 0)
    assert quality.critical_nulls(df, []).first().cantidad == 0
    assert tuple(quality.profile(df.limit(0), "k", ["id"]).first()) == (0, 0, 0)


def test_all_tables_in_one_plan(spark):
    checks = [TableCheck(f"t{i}", spark.range(i), "silver_has_data") for i in range(4)]
    found = {r.tabla: (r.resultado, r.mensaje) for r in quality.run_checks(spark, CONTEXT, checks).collect()}
    assert found["t0"] == ("FAILED", "rows: 0") and found["t3"] == ("PASSED", "rows: 3")


def test_severity_is_upper_case_and_defaults_to_warning(spark):
    make = lambda level: spark.range(1).select(*quality.result(
        CONTEXT, F.lit("t"), F.lit("r"), F.lit(False), F.lit(None).cast("bigint"), F.lit("m"), level)).first()
    assert make("critical").severidad == "CRITICAL"
    assert make(None).severidad == make("").severidad == "WARNING"
    assert make("critical").cantidad_errores == 0


@pytest.mark.parametrize("expected, found, tolerance, result, errors", [
    (10, 8, 0.0, "FAILED", 2), (100, 103, 0.05, "PASSED", 0), (100, 106, 0.05, "FAILED", 6),
    (10, 10, 0.0, "PASSED", 0), (0, 1, 0.5, "FAILED", 1), (0, 0, 0.0, "PASSED", 0),
])
def test_reconciliation(spark, expected, found, tolerance, result, errors):
    row = reconcile.reconcile(
        spark, CONTEXT, target_name="t", target=spark.range(found), source_name="s", source=spark.range(expected),
        tolerance=tolerance,
    ).first()
    assert (row.resultado, row.cantidad_errores, row.severidad, row.tabla) == (result, errors, "CRITICAL", "t")
    assert f"expected={expected}; found={found}" in row.mensaje


def test_reconciliation_difference(spark):
    df = spark.createDataFrame([(100, 103)], "a bigint, b bigint")
    assert tuple(df.select(*reconcile.compare_counts(F.col("a"), F.col("b"), 0.05)).first()) == (True, 3, 5)


def test_reconciliation_outcomes(spark):
    run = lambda **case: reconcile.reconcile(spark, CONTEXT, target_name="t", **case).first()
    skipped = run(target=spark.range(10))
    assert (skipped.resultado, skipped.severidad, skipped.tabla) == ("PASSED", "WARNING", "t")
    away = run(target=spark.range(10), source_name="s")
    assert (away.resultado, away.severidad, away.tabla) == ("PASSED", "WARNING", "s")
    lost = run(target=None, source_name="s", source=spark.range(1))
    assert (lost.resultado, lost.severidad, lost.cantidad_errores) == ("FAILED", "CRITICAL", 1)


def test_audit_event(spark):
    event = records.audit_event(
        spark, ambiente=" dev ", process="stock", run_id="run-1", status=" started ", name="n", message=" go ",
        task="audit_start", source_system="  ",
    )
    assert event.schema.names == c.AUDIT_SCHEMA.names
    row = event.first()
    assert (row.status, row.ambiente, row.message, row.task) == ("STARTED", "dev", "go", "audit_start")
    assert row.source_system is None and row.details_json is None and row.execution_id is None
    assert len(row.event_id) == 36 and dt.datetime.fromisoformat(row.timestamp).tzinfo


def test_audit_status_is_checked(spark):
    with pytest.raises(c.ContractError):
        records.audit_event(spark, status="done")
    frame = spark.createDataFrame([("done",)], "status string")
    with pytest.raises(Exception, match="not an audit status"):
        records.normalise_audit(frame).collect()
    null = spark.createDataFrame([(None,)], "status string")
    with pytest.raises(Exception, match="not an audit status"):
        records.normalise_audit(null).collect()


def test_all_null_fields_keep_their_type(spark):
    rows = [records.file_metric(archivo_origen="a", archivo_destino="b", status="success")]
    df = records.records(spark, rows, c.FILE_METRIC_SCHEMA)
    assert df.schema == c.FILE_METRIC_SCHEMA and df.first().rows_read is None
