from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from allotment import contracts as c
from allotment.operators.control import NothingToLoad
from allotment.plans import index, run as runs, silver
from allotment.sources import sinks

from .test_cleaning import OFFER, raw
from .test_control import legacy
from .test_index import CUTOFF, EDGE_CUSTOMERS, customer, frames, sale

FACT = [sale("A", 5, 9, 10), sale("B", 5, 1, 10), sale("C", 4, 2, 10)]
OUTPUTS = ["t_index", "t_history", "t_audit", "t_quality", "t_metrics", "t_silver", "t_bronze", "t_groups"]


@pytest.fixture
def tables(spark):
    inputs = frames(spark, FACT, [customer("A"), customer("B", prio=1), customer("C")])
    inputs |= {role: spark.range(2) for role in c.INPUT_ROLES if role not in inputs}
    for role, df in inputs.items():
        df.createOrReplaceTempView(f"v_{role}")
    raw(spark, c.OFFERS_CASTS, OFFER).createOrReplaceTempView("v_offers")
    spark.table("v_offers").write.saveAsTable("t_bronze")
    yield {role: f"v_{role}" for role in c.INPUT_ROLES} | {"index": "t_index", "index_history": "t_history"}
    for name in OUTPUTS:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for role in inputs:
        spark.catalog.dropTempView(f"v_{role}")
    spark.catalog.dropTempView("v_offers")


def make(tables, execution_id="run-1", **changes):
    return runs.Run(execution_id, "dev", "stock", tables, "t_audit", "t_quality", **{
        "silver": [runs.SilverStep("t_bronze", "t_silver", silver.sales_offers)],
        "has_data": [("t_bronze", "bronze_sap_has_data"), ("t_silver", "silver_has_data")],
    } | changes)


def statuses(spark):
    return [r.status for r in spark.table("t_audit").orderBy("timestamp").collect()]


def test_full_run(spark, tables, tmp_path):
    target = str(tmp_path / "published")
    publish = lambda df: sinks.publish(df, target, "overwrite", write=sinks.publish_to_path)

    def land(session, run):
        return runs.extract(
            session, run, legacy(session, ColumnasArchivoFuente="*"), "VistasSapHana", "SapHana", str(tmp_path / "bronze"),
            metrics_table="t_metrics", read=lambda s, r: s.table("v_offers"), table_name=lambda record: "t_bronze",
        )

    for execution_id in ("run-1", "run-2"):
        metrics = runs.full_run(spark, make(tables, execution_id), publish, before=[land])
        assert metrics["rows_written"] == 3
    rows = spark.table("t_index").orderBy("prioridad").collect()
    assert [r.cod_cliente for r in rows] == ["B", "A", "C"]
    assert {r.execution_id for r in rows} == {"run-2"} and {r.Estatus for r in rows} == {"N"}
    assert spark.table("t_history").count() == 6
    published = spark.read.parquet(target)
    assert published.columns == c.PUBLICATION_COLUMNS
    assert published.exceptAll(spark.table("t_index").select(*c.PUBLICATION_COLUMNS)).isEmpty()
    assert statuses(spark) == ["STARTED", "SUCCEEDED"] * 2
    assert spark.table("t_silver").count() == 1 and spark.table("t_metrics").count() == 2
    results = spark.table("t_quality").filter("execution_id = 'run-2'")
    assert results.count() == 6 and results.filter("resultado = 'FAILED'").isEmpty()


def test_gate_stops_before_publishing(spark, tables):
    # A customer with two attribute rows is twice in the index.
    frames(spark, FACT, EDGE_CUSTOMERS)["customers"].createOrReplaceTempView("v_customers")
    spark.table("v_customers").unionByName(spark.table("v_customers").withColumn("nombre_cliente", F.lit("z"))) \
        .createOrReplaceTempView("v_customers_twice")
    published = []
    with pytest.raises(runs.GateClosed):
        runs.full_run(spark, make(tables | {"customers": "v_customers_twice"}), published.append)
    assert not published
    assert statuses(spark) == ["STARTED", "FAILED"]
    failed = spark.table("t_quality").filter("resultado = 'FAILED'").collect()
    assert [r.regla for r in failed] == ["gold_duplicate_cod_cliente"]


def test_reconciliation_is_part_of_the_gate(spark, tables):
    with pytest.raises(runs.GateClosed):
        runs.full_run(spark, make(tables, comparison_table="v_materials"), lambda df: None)
    failed = spark.table("t_quality").filter("resultado = 'FAILED'").collect()
    assert [(r.regla, r.cantidad_errores) for r in failed] == [("adf_reconciliation_count", 1)]


def test_failed_publication_fails_the_run(spark, tables):
    with pytest.raises(RuntimeError, match="publication failed"):
        runs.full_run(spark, make(tables), lambda df: {"status": "error", "error_message": "no route"})
    assert statuses(spark) == ["STARTED", "FAILED"]


def test_failed_extraction_keeps_its_metrics(spark, tables, tmp_path):
    def broken(session, record):
        raise RuntimeError("unreachable")

    with pytest.raises(RuntimeError, match="extraction from SapHana"):
        runs.extract(spark, make(tables), legacy(spark), "VistasSapHana", "SapHana", str(tmp_path), "t_metrics", broken)
    assert [(r.status, r.error_message) for r in spark.table("t_metrics").collect()] == [("failed", "unreachable")]


def test_build_index_counts(spark, tables):
    record = runs.build_index(spark, make(tables))
    assert record.schema == c.RUN_METRIC_SCHEMA and record.first().asDict() == {
        "execution_id": "run-1", "rows_profitability": 3, "rows_cost_to_serve": 2, "rows_materials": 2, "rows_customers": 3,
        "rows_priority_groups": 2, "rows_previous_index": 2, "rows_index": 3, "index_table": "t_index", "index_history_table": "t_history",
    }


def test_mended_data_open_the_gate_again(spark, tables):
    run = make(tables, "run 'quoted'", has_data=[("v_nothing", "bronze_sap_has_data")])
    published = lambda df: {"status": "success", "rows_written": df.count()}
    with pytest.raises(runs.GateClosed):
        runs.full_run(spark, run, published)
    spark.range(1).createOrReplaceTempView("v_nothing")
    assert runs.full_run(spark, run, published)["rows_written"] == 3
    spark.catalog.dropTempView("v_nothing")


def test_a_run_leaves_no_scratch_and_the_whole_error(spark, tables, monkeypatch, tmp_path):
    from allotment import runtime

    monkeypatch.setattr(runtime, "scratch_root", lambda session: str(tmp_path))
    text = "no route;" * 1000
    with pytest.raises(RuntimeError):
        runs.full_run(spark, make(tables), lambda df: {"status": "error", "error_message": text})
    runs.full_run(spark, make(tables), lambda df: {"status": "success", "rows_written": df.count()})
    assert not [p for p in tmp_path.rglob("*.parquet")]
    assert text in spark.table("t_audit").filter("status = 'FAILED'").first().message


def test_control_rows_of_the_run_only(spark):
    rows = legacy(spark).unionByName(legacy(spark, Proceso="other")).unionByName(legacy(spark, SistemaFuente="sharepoint"))
    loads = runs.run_loads(rows, "stock", "SapHana", "VistasSapHana")
    assert [(r.proceso, r.sistema_fuente) for r in loads.collect()] == [("stock", "SapHana")]
    dated = rows.withColumns({"valid_from": F.lit(20240101), "valid_to": F.lit(20240601)})
    assert runs.run_loads(dated, "stock", "SapHana", "VistasSapHana", (20240301, 20240301)).count() == 1
    with pytest.raises(NothingToLoad):
        runs.run_loads(dated, "stock", "SapHana", "VistasSapHana", (20250101, 20250101))


def test_files_land_and_feed_silver(spark, tables, tmp_path):
    source, target = tmp_path / "portal", tmp_path / "landed"
    source.mkdir()
    (source / "g.csv").write_text("Cliente,Nombre,CADENA,GRUPO,Priorización\n7,x,N/A,y,3\n", encoding="utf-8")
    listed = dict(SistemaFuente="sharepoint", PropietarioFuente="DatosPortalDeInformacion", RutaArchivoFuente="", ExtencionArchivoDestino=".csv")
    good = legacy(spark, NombreArchivoFuente="g.csv", NombreArchivoDestino="g", **listed)
    lost = legacy(spark, NombreArchivoFuente="lost.csv", NombreArchivoDestino="lost", OrdenEjecucion="5", **listed)
    step = lambda control, **more: runs.land_files(
        spark, make(tables), control, "DatosPortalDeInformacion", "sharepoint", str(source), str(target), "t_metrics", **more
    )
    step(good, tables={"g": "t_bronze"})
    run = make(tables, silver=[runs.SilverStep("t_bronze", "t_groups", silver.priority_groups)])
    assert runs.refresh_silver(spark, run) == {"t_groups": 1}
    assert [(r.cliente, r.priorizacion, r.cadena) for r in spark.table("t_groups").collect()] == [(7, 3, None)]
    with pytest.raises(RuntimeError, match="landing files"):
        step(good.unionByName(lost))
    assert sorted(r.status for r in spark.table("t_metrics").collect()) == ["failed", "success", "success"]
    with pytest.raises(RuntimeError, match="landing files"):
        step(good.unionByName(lost), fail_fast=True)
    assert spark.table("t_metrics").count() == 4


def test_scratch_needs_shared_storage_on_a_cluster(monkeypatch):
    from allotment import runtime

    class Conf(dict):
        pass

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})

    assert runtime.scratch_root(Session(spark_checkpoint_dir="abfss://x/y/")) == "abfss://x/y"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.scratch_root(Session(spark_master="spark://host"))
    local = runtime.scratch_root(Session(spark_master="local[2]"))
    assert local == runtime.scratch_root(Session(spark_master="local[2]"))


def test_scratch_can_be_dropped(spark, monkeypatch, tmp_path):
    from allotment import runtime

    monkeypatch.setattr(runtime, "scratch_root", lambda session: str(tmp_path))
    kept = runtime.materialise(spark.range(3), "x")
    assert kept.count() == 3 and list((tmp_path / "allotment").iterdir())
    runtime.drop_scratch(spark)
    assert not list((tmp_path / "allotment").iterdir())
    runtime.drop_scratch(spark)
