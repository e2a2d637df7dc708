from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from allotment import contracts as c
from allotment.contracts import ContractError
from allotment.operators import control

LEGACY = [legacy[0] for _, legacy in c.CONTROL_COLUMNS.values()]


def legacy(spark, **changes):
    row = {
        "Proceso": " stock ", "SistemaFuente": "SapHana", "PropietarioFuente": "VistasSapHana",
        "ColumnasArchivoFuente": "COL1,COL2", "RutaArchivoFuente": "SCHEMA", "NombreArchivoFuente": "VIEW",
        "FiltrosArchivoFuente": None, "RutaArchivoDestino": "sap/path", "NombreArchivoDestino": "file",
        "ExtencionArchivoDestino": ".parquet", "TipoCarga": None, "Activo": "1", "OrdenEjecucion": "10",
    } | changes
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))


def test_normalised_record(spark):
    row = control.normalise_control(legacy(spark)).first().asDict()
    assert list(row) == list(c.CONTROL_COLUMNS)
    assert row["proceso"] == "stock" and row["extension_archivo_destino"] == ".parquet"
    assert row["activo"] is True and row["orden_ejecucion"] == 10
    assert row["tipo_carga"] == "" and row["filtros_archivo_fuente"] == ""


def test_either_spelling_of_the_extension(spark):
    df = legacy(spark).withColumnRenamed("ExtencionArchivoDestino", "ExtensionArchivoDestino")
    assert control.normalise_control(df).first().extension_archivo_destino == ".parquet"
    both = legacy(spark).withColumn("extension_archivo_destino", F.lit(".csv"))
    assert control.normalise_control(both).first().extension_archivo_destino == ".csv"


def test_missing_columns_are_typed_nulls(spark):
    out = control.normalise_control(spark.createDataFrame([("VistasSapHana",)], "PropietarioFuente string"))
    assert dict(out.dtypes) == {name: kind for name, (kind, _) in c.CONTROL_COLUMNS.items()}
    assert out.first().activo is True and out.first().orden_ejecucion == 0
    assert control.active_loads(out).count() == 1


@pytest.mark.parametrize("kind, values, expected", [
    ("string", ["1", " Si ", "ACTIVO", "y", "0", "no", "", "2", None], [True] * 4 + [False] * 4 + [True]),
    ("int", [1, 2, -1, 0, None], [True, True, True, False, True]),
    ("double", [0.5, 0.0, None], [True, False, True]),
    ("boolean", [True, False, None], [True, False, True]),
])
def test_flags(spark, kind, values, expected):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, Activo {kind}").orderBy("i")
    found = [r[0] for r in df.select(control.truth(F.col("Activo"), df.schema["Activo"].dataType)).collect()]
    assert found == expected


def test_load_order(spark):
    df = spark.createDataFrame([("10",), (" 7\t",), ("",), (None,)], "o string")
    assert [r[0] for r in df.select(control.load_order(F.col("o"), df.schema["o"].dataType)).collect()] == [10, 7, 0, 0]
    numbers = spark.createDataFrame([(3,), (None,)], "o bigint")
    assert [r[0] for r in numbers.select(control.load_order(F.col("o"), numbers.schema["o"].dataType)).collect()] == [3, 0]
    with pytest.raises(Exception, match="not a whole number"):
        control.normalise_control(legacy(spark, OrdenEjecucion="first")).collect()


def test_owner_and_order(spark):
    rows = [("VistasSapHana", "b", "20", "1"), ("VistasSapHana", "c", "10", None), ("VistasSapHana", "a", "20", "si"),
            ("DatosPortalDeInformacion", "d", "1", "1"), ("VistasSapHana", "x", "0", "0")]
    df = control.normalise_control(spark.createDataFrame(
        rows, "PropietarioFuente string, NombreArchivoFuente string, OrdenEjecucion string, Activo string"))
    names = lambda frame: [r.nombre_archivo_fuente for r in frame.collect()]
    assert names(control.active_loads(df, "VistasSapHana")) == ["c", "a", "b"]
    assert names(control.active_loads(df)) == ["d", "c", "a", "b"]
    assert names(control.active_loads(df, " DatosPortalDeInformacion ")) == ["d"]
    with pytest.raises(ContractError, match="owner"):
        control.active_loads(df, "somebody")


def test_nothing_to_load(spark):
    df = control.normalise_control(legacy(spark, Activo="0"))
    with pytest.raises(control.NothingToLoad):
        control.active_loads(df)
    assert control.active_loads(df, must_exist=False).count() == 0


def test_validity(spark):
    base = control.normalise_control(legacy(spark))
    rows = spark.createDataFrame([(0, 99991231), (20240101, 20241231)], "valid_from int, valid_to int").join(
        base.withColumn("k", F.lit(1)), F.lit(1) == F.col("k")).drop("k")
    count = lambda *window, **other: control.valid_loads(rows, "stock", "SapHana", *other.values() or (None,), *window).count()
    assert count() == 2
    assert count(20231231, 0) == 1
    assert count(20240101, 20241231) == 2
    assert count(20240101, 20250101) == 1
    assert control.valid_loads(rows, "other", "SapHana").count() == 0
    assert control.valid_loads(rows, "stock", "SapHana", "DatosPortalDeInformacion").count() == 0
    assert control.valid_loads(rows, "stock", "SapHana").columns == list(c.CONTROL_COLUMNS)
    for process, system in (("", "SapHana"), ("stock", ""), ("stock", "other")):
        with pytest.raises(ContractError):
            control.valid_loads(rows, process, system)


def test_upsert(spark):
    keys = ", ".join(f"{k} string" for k in c.CONTROL_KEY)
    schema = f"{keys}, tipo_carga string, nota string, created_at date, updated_at date"
    old_day = dt.date(2020, 1, 1)
    key = lambda k: (k,) * len(c.CONTROL_KEY)
    target = spark.createDataFrame([key("a") + ("full", "keep", old_day, old_day), key("b") + ("full", "keep", old_day, old_day)], schema)
    incoming = spark.createDataFrame([key("b") + (None, "new"), key("c") + ("file", "new")], f"{keys}, tipo_carga string, nota string")
    now = F.lit("2024-06-01").cast("date")
    out = control.upsert(target, incoming, now=now)
    assert out.schema.names == target.schema.names
    found = {r.proceso_id: (r.tipo_carga, r.nota, str(r.created_at), str(r.updated_at)) for r in out.collect()}
    assert found == {
        "a": ("full", "keep", "2020-01-01", "2020-01-01"),
        "b": (None, "keep", "2020-01-01", "2024-06-01"),
        "c": ("file", "new", "2024-06-01", "2024-06-01"),
    }
    with pytest.raises(Exception, match="same key twice"):
        control.upsert(target, incoming.union(incoming), now=now).collect()


def test_upsert_of_a_dimension(spark):
    target = spark.createDataFrame([("stock", "old", True)], "proceso string, descripcion string, activo boolean")
    incoming = spark.createDataFrame([("stock", "new", False), ("other", "x", True)], target.schema)
    out = control.upsert(target, incoming, keys=["proceso"], updated=["descripcion", "activo"])
    assert sorted(map(tuple, out.collect())) == [("other", "x", True), ("stock", "new", False)]


def test_star_view_needs_active_dimensions(spark):
    loads = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (1, 9, 1)], "proceso_id int, sistema_fuente_id int, propietario_fuente_id int")
    for name, (kind, _) in c.CONTROL_COLUMNS.items():
        if name not in ("proceso", "sistema_fuente", "propietario_fuente"):
            loads = loads.withColumn(name, F.lit(None).cast(kind))
    loads = loads.withColumns({"valid_from": F.lit(0), "valid_to": F.lit(c.OPEN_END_DATE)})
    dim = lambda name, *rows: spark.createDataFrame(list(rows), f"{name}_id int, {name} string, activo boolean")
    view = control.control_view(
        loads, dim("proceso", (1, "p", True), (2, "q", False)), dim("sistema_fuente", (1, "s", True)),
        dim("propietario_fuente", (1, "o", True)),
    )
    assert [(r.proceso, r.sistema_fuente, r.propietario_fuente) for r in view.collect()] == [("p", "s", "o")]
    assert control.legacy_names(view).columns == LEGACY + ["AnioMesDiaInicial", "AnioMesDiaFinal"]
