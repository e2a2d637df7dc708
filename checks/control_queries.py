"""Load control and control-driven extraction, over control rows derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allotment import contracts as c
from allotment.operators import control, ranking
from allotment.plans import run as runs
from allotment.plans import silver
from allotment.runtime import materialise, scratch_path
from allotment.sources import extract

from . import inputs
from .registry import query

# Every part is an object to load, under the legacy names. Both dialects read this.
LEGACY = {
    "Proceso": "' stock '",
    "SistemaFuente": "CASE WHEN p_partkey % 2 = 0 THEN 'SapHana' ELSE ' sharepoint' END",
    "PropietarioFuente": "CASE WHEN p_partkey % 2 = 0 THEN 'VistasSapHana ' ELSE 'DatosPortalDeInformacion' END",
    "ColumnasArchivoFuente": "'*'",
    "RutaArchivoFuente": "CONCAT(' ', p_brand, ' ')",
    "NombreArchivoFuente": "CONCAT(p_name, CAST(p_partkey AS VARCHAR(20)))",
    "FiltrosArchivoFuente": "CASE p_partkey % 3 WHEN 0 THEN CAST(NULL AS VARCHAR(20)) WHEN 1 THEN '' ELSE ' WHERE a > 1 ' END",
    "RutaArchivoDestino": "p_type",
    "NombreArchivoDestino": "p_name",
    "ExtencionArchivoDestino": "CASE WHEN p_partkey % 2 = 0 THEN '.parquet' ELSE '.xlsx' END",
    "TipoCarga": "CASE WHEN p_partkey % 5 = 0 THEN CAST(NULL AS VARCHAR(20)) ELSE ' full ' END",
    "Activo": """CASE p_partkey % 7 WHEN 0 THEN '0' WHEN 1 THEN CAST(NULL AS VARCHAR(20)) WHEN 2 THEN ' Si ' WHEN 3 THEN 'no'
      WHEN 4 THEN '1' WHEN 5 THEN '' ELSE 'ACTIVE' END""",
    "OrdenEjecucion": """CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN CAST(NULL AS VARCHAR(20)) WHEN 2 THEN ' 10 '
      ELSE CAST(p_size AS VARCHAR(20)) END""",
}
LEGACY_SQL = f"legacy AS (SELECT {', '.join(f'{text} AS {name}' for name, text in LEGACY.items())} FROM part)"
NORMAL_SQL = f"""{LEGACY_SQL},
normal AS (
  SELECT trim(Proceso) AS proceso, trim(SistemaFuente) AS sistema_fuente, trim(PropietarioFuente) AS propietario_fuente,
    trim(ColumnasArchivoFuente) AS columnas_archivo_fuente, trim(RutaArchivoFuente) AS ruta_archivo_fuente,
    trim(NombreArchivoFuente) AS nombre_archivo_fuente, coalesce(trim(FiltrosArchivoFuente), '') AS filtros_archivo_fuente,
    trim(RutaArchivoDestino) AS ruta_archivo_destino, trim(NombreArchivoDestino) AS nombre_archivo_destino,
    trim(ExtencionArchivoDestino) AS extension_archivo_destino, coalesce(trim(TipoCarga), '') AS tipo_carga,
    coalesce(lower(trim(Activo)) IN ('1', 'true', 't', 'yes', 'y', 'si', 's', 'activo', 'active'), true) AS activo,
    CAST(coalesce(nullif(trim(OrdenEjecucion), ''), '0') AS INTEGER) AS orden_ejecucion
  FROM legacy)"""


def legacy_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = inputs.table(spark, sf_dir, "part")
    return part.select(*[F.expr(text).alias(name) for name, text in LEGACY.items()])


@query(f"WITH {NORMAL_SQL} SELECT * FROM normal")
def control_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.normalise_control(legacy_control(spark, sf_dir))


@query(f"WITH {NORMAL_SQL} SELECT * FROM normal WHERE activo AND propietario_fuente = 'VistasSapHana'")
def control_active_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.active_loads(control.normalise_control(legacy_control(spark, sf_dir)), "VistasSapHana")


# Control rows with a validity: one per order, valid from its date, closed after
# a year unless it is still open.
VALIDITY = {
    "valid_from": "CAST(date_format(o_orderdate, 'yyyyMMdd') AS INT)",
    "valid_to": "CASE WHEN o_orderstatus = 'O' THEN 99991231 ELSE CAST(date_format(o_orderdate, 'yyyyMMdd') AS INT) + 10000 END",
}
VALID_ROWS = {
    "proceso": "'stock'",
    "sistema_fuente": "CASE WHEN o_orderstatus = 'P' THEN 'sharepoint' ELSE 'SapHana' END",
    "propietario_fuente": "'VistasSapHana'",
    "columnas_archivo_fuente": "'*'",
    "ruta_archivo_fuente": "o_orderpriority",
    "nombre_archivo_fuente": "CAST(o_orderkey AS VARCHAR(20))",
    "filtros_archivo_fuente": "''",
    "ruta_archivo_destino": "'erp'",
    "nombre_archivo_destino": "CAST(o_custkey AS VARCHAR(20))",
    "extension_archivo_destino": "'.parquet'",
    "tipo_carga": "'full'",
    "activo": "o_totalprice > 50000",
    "orden_ejecucion": "CAST(o_custkey AS INT)",
}


@query(f"""SELECT {', '.join(f'{text} AS {name}' for name, text in VALID_ROWS.items())} FROM (
  SELECT *, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS d FROM orders)
WHERE o_totalprice > 50000 AND o_orderstatus <> 'P' AND d <= 19980101
  AND CASE WHEN o_orderstatus = 'O' THEN 99991231 ELSE d + 10000 END >= 19981231""")
def control_validity_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "orders").select(
        *[F.expr(text).alias(name) for name, text in (VALID_ROWS | VALIDITY).items()]
    )
    return control.valid_loads(rows, "stock", "SapHana", "VistasSapHana", start=19980101, end=19981231)


# --- control dimensions ----------------------------------------------------------

def processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("proceso_id"), F.col("c_name").alias("proceso"), (F.col("c_acctbal") > 0).alias("activo")
    )


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("sistema_fuente_id"),
        F.col("n_name").alias("sistema_fuente"),
        (F.col("n_nationkey") % 7 != 0).alias("activo"),
    )


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("propietario_fuente_id"),
        F.col("s_name").alias("propietario_fuente"),
        (F.col("s_acctbal") > 0).alias("activo"),
    )


LOADS = {
    "proceso_id": "o_custkey",
    "sistema_fuente_id": "CAST(o_orderkey % 25 AS INT)",
    "propietario_fuente_id": "l_suppkey",
    "columnas_archivo_fuente": "'*'",
    "ruta_archivo_fuente": "l_returnflag",
    "nombre_archivo_fuente": "CAST(l_orderkey AS VARCHAR(20))",
    "filtros_archivo_fuente": "''",
    "ruta_archivo_destino": "l_linestatus",
    "nombre_archivo_destino": "CAST(l_partkey AS VARCHAR(20))",
    "extension_archivo_destino": "'.parquet'",
    "tipo_carga": "'full'",
    "activo": "l_quantity > 10",
    "orden_ejecucion": "l_linenumber",
    "valid_from": "0",
    "valid_to": "99991231",
}
STAR_SQL = f"""loads AS (
  SELECT {', '.join(f'{text} AS {name}' for name, text in LOADS.items())}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
star AS (
  SELECT c_name AS proceso, n_name AS sistema_fuente, s_name AS propietario_fuente,
    columnas_archivo_fuente, ruta_archivo_fuente, nombre_archivo_fuente, filtros_archivo_fuente,
    ruta_archivo_destino, nombre_archivo_destino, extension_archivo_destino, tipo_carga, activo, orden_ejecucion,
    valid_from, valid_to
  FROM loads, customer, nation, supplier
  WHERE c_custkey = proceso_id AND n_nationkey = sistema_fuente_id AND s_suppkey = propietario_fuente_id
    AND c_acctbal > 0 AND n_nationkey % 7 <> 0 AND s_acctbal > 0)"""


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem").join(
        inputs.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    loads = lines.select(*[F.expr(text).alias(name) for name, text in LOADS.items()])
    return control.control_view(
        loads, processes(spark, sf_dir), systems(spark, sf_dir), owners(spark, sf_dir)
    )


@query(f"WITH {STAR_SQL} SELECT * FROM star")
def control_star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir)


COMPAT_NAMES = {name: legacy[0] for name, (_, legacy) in c.CONTROL_COLUMNS.items()} | {
    "valid_from": "AnioMesDiaInicial", "valid_to": "AnioMesDiaFinal",
}


@query(f"""WITH {STAR_SQL} SELECT {', '.join(f'{old} AS "{new}"' for old, new in COMPAT_NAMES.items())} FROM star""")
def control_legacy_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.legacy_names(star(spark, sf_dir))


# --- seeds: dimensions crossed, pairs picked, one projection per seed ---------------

def region_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("propietario_fuente_id"), F.col("r_name").alias("propietario_fuente")
    )


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's (name, nation, region) refers to the three dimensions."""
    wanted = (
        inputs.table(spark, sf_dir, "customer")
        .join(inputs.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(inputs.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_name").alias("proceso"),
            F.col("n_name").alias("sistema_fuente"),
            F.col("r_name").alias("propietario_fuente"),
        )
    )
    return control.dimension_references(
        processes(spark, sf_dir), systems(spark, sf_dir), region_owners(spark, sf_dir), wanted
    )


REFERENCES_SQL = """refs AS (
  SELECT c_custkey AS proceso_id, n_nationkey AS sistema_fuente_id, r_regionkey AS propietario_fuente_id,
         c_name AS proceso, n_name AS sistema_fuente, r_name AS propietario_fuente
  FROM customer CROSS JOIN nation CROSS JOIN region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey)"""


@query(f"WITH {REFERENCES_SQL} SELECT * FROM refs")
def control_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references(spark, sf_dir)


SEEDS = [
    {"sistema_fuente": "NATION_7", "propietario_fuente": "ASIA", "nombre_archivo_fuente": "ofertas",
     "extension_archivo_destino": ".parquet", "tipo_carga": "full", "orden_ejecucion": 10, "activo": True},
    {"sistema_fuente": "NATION_7", "propietario_fuente": "ASIA", "nombre_archivo_fuente": "pedidos",
     "extension_archivo_destino": ".parquet", "tipo_carga": "full", "orden_ejecucion": 20, "activo": True},
    {"sistema_fuente": "NATION_1", "propietario_fuente": "AMERICA", "nombre_archivo_fuente": "grupos",
     "extension_archivo_destino": ".xlsx", "tipo_carga": "file", "orden_ejecucion": 10, "activo": True},
    {"sistema_fuente": "NATION_1", "propietario_fuente": "AMERICA", "nombre_archivo_fuente": "previas",
     "extension_archivo_destino": ".xlsx", "tipo_carga": "file", "orden_ejecucion": 20, "activo": False},
]


@query(f"WITH {REFERENCES_SQL} " + " UNION ALL ".join(
    f"""SELECT proceso_id, sistema_fuente_id, propietario_fuente_id, '{s["nombre_archivo_fuente"]}' AS nombre_archivo_fuente,
    '{s["extension_archivo_destino"]}' AS extension_archivo_destino, '{s["tipo_carga"]}' AS tipo_carga,
    CAST({s["orden_ejecucion"]} AS INTEGER) AS orden_ejecucion, {str(s["activo"]).lower()} AS activo
    FROM refs WHERE sistema_fuente = '{s["sistema_fuente"]}' AND propietario_fuente = '{s["propietario_fuente"]}'"""
    for s in SEEDS))
def control_seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.seed_loads(references(spark, sf_dir), SEEDS)


# --- upsert --------------------------------------------------------------------------

KEYED = {
    "proceso_id": "{k}",
    "sistema_fuente_id": "CAST(1 AS BIGINT)",
    "propietario_fuente_id": "CAST(2 AS BIGINT)",
    "ruta_archivo_fuente": "'erp'",
    "nombre_archivo_fuente": "CAST({k} AS VARCHAR(20))",
    "ruta_archivo_destino": "'bronze'",
    "nombre_archivo_destino": "'t'",
}
OLD_ROWS = {n: t.format(k="o_orderkey") for n, t in KEYED.items()} | {
    "columnas_archivo_fuente": "'*'", "filtros_archivo_fuente": "o_orderpriority",
    "extension_archivo_destino": "'.csv'", "tipo_carga": "o_orderstatus",
    "orden_ejecucion": "CAST(o_custkey AS INT)", "activo": "true",
    "created_at": "DATE '2020-01-01'", "updated_at": "DATE '2020-01-01'",
}
NEW_ROWS = {n: t.format(k="k") for n, t in KEYED.items()} | {
    "columnas_archivo_fuente": "'a,b'", "filtros_archivo_fuente": "CASE WHEN n > 4 THEN CAST(NULL AS VARCHAR(20)) ELSE 'WHERE a = 1' END",
    "extension_archivo_destino": "'.parquet'", "tipo_carga": "'full'",
    "orden_ejecucion": "CAST(n AS INT)", "activo": "n > 2",
}


@query(f"""WITH viejo AS (SELECT {', '.join(f'{t} AS {n}' for n, t in OLD_ROWS.items())} FROM orders),
nuevo AS (SELECT {', '.join(f'{t} AS {n}' for n, t in NEW_ROWS.items())} FROM (
  SELECT l_orderkey + 7 AS k, count(*) AS n FROM lineitem GROUP BY ALL))
SELECT v.* FROM viejo v WHERE proceso_id NOT IN (SELECT proceso_id FROM nuevo)
UNION ALL
SELECT n.*, coalesce(v.created_at, DATE '2024-06-01') AS created_at, DATE '2024-06-01' AS updated_at
FROM nuevo n LEFT JOIN viejo v USING (proceso_id)""")
def control_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = inputs.table(spark, sf_dir, "orders").select(*[F.expr(t).alias(n) for n, t in OLD_ROWS.items()])
    lines = inputs.table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") + 7).alias("k"))
    incoming = lines.agg(F.count("*").alias("n")).select(*[F.expr(t).alias(n) for n, t in NEW_ROWS.items()])
    return control.upsert(target, incoming, now=F.lit("2024-06-01").cast("date"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS nombre, row_number() OVER (ORDER BY s_suppkey % 7, CAST(s_suppkey AS VARCHAR)) AS puesto
FROM supplier WHERE s_suppkey % 5 <> 0""")
def control_load_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place at which each active load comes."""
    key = F.col("s_suppkey")
    loads = inputs.table(spark, sf_dir, "supplier").select(
        F.lit("VistasSapHana").alias("PropietarioFuente"), key.cast("string").alias("NombreArchivoFuente"),
        F.when(key % 5 == 0, "no").otherwise("si").alias("Activo"), (key % 7).cast("string").alias("OrdenEjecucion"),
    )
    ordered = control.active_loads(control.normalise_control(loads), "VistasSapHana")
    placed = ordered.select(F.col("nombre_archivo_fuente").alias("nombre"), F.monotonically_increasing_id().alias("at"))
    return ranking.global_row_number(placed, [F.col("at")], "puesto").select("nombre", "puesto")


# --- extraction ------------------------------------------------------------------------

def extract_control(spark: SparkSession) -> DataFrame:
    """What to extract from the given tables; the last object does not exist."""
    rows = [
        ("s_suppkey AS clave, s_name AS nombre", "supplier", "WHERE s_acctbal > 0", "10"),
        ("c_custkey AS clave, c_name AS nombre", "customer", "", "20"),
        ("p_partkey AS clave, concat(p_brand, ' ', p_name) AS nombre", "part", "WHERE p_size BETWEEN 5 AND 40", "20"),
        ("*", "no_such_table", None, "30"),
    ]
    legacy = spark.createDataFrame(
        [("stock", "SapHana", "VistasSapHana", columns, "tpch", name, where, "erp", name, "parquet", "full", "1", order)
         for columns, name, where, order in rows],
        ", ".join(f"{legacy[0]} string" for _, legacy in c.CONTROL_COLUMNS.values()),
    )
    return control.active_loads(control.normalise_control(legacy), "VistasSapHana")


def reader(sf_dir: str):
    return lambda spark, record: inputs.table(spark, sf_dir, record["nombre_archivo_fuente"])


EXTRACTED = {
    "supplier": "SELECT s_suppkey AS clave, s_name AS nombre FROM supplier WHERE s_acctbal > 0",
    "customer": "SELECT c_custkey AS clave, c_name AS nombre FROM customer",
    "part": "SELECT p_partkey AS clave, concat(p_brand, ' ', p_name) AS nombre FROM part WHERE p_size BETWEEN 5 AND 40",
}


@query(" UNION ALL ".join(
    f"SELECT *, 'tpch.{name}' AS source_object, 'run-1' AS execution_id FROM ({sql})" for name, sql in EXTRACTED.items()))
def control_driven_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the listed objects and read back what was landed."""
    root = scratch_path(spark, "bronze")
    metrics = extract.extract_all(
        spark, extract_control(spark), root, execution_id="run-1", process_name="stock",
        source_system="SapHana", read=reader(sf_dir), raise_errors=False,
    )
    landed = [row.target_path for row in metrics.filter("status = 'success'").toLocalIterator()]
    return spark.read.parquet(*landed).select("clave", "nombre", "source_object", "execution_id")


@query(" UNION ALL ".join(
    f"""SELECT 'tpch.{name}' AS source_object, 'stock' AS process_name, 'SapHana' AS sistema_fuente,
    count(*) AS rows_read, count(*) AS rows_written, 'success' AS status FROM ({sql})""" for name, sql in EXTRACTED.items())
    + " UNION ALL SELECT 'tpch.no_such_table', 'stock', 'SapHana', 0, 0, 'failed'")
def extraction_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric row per object, read from the view the extraction leaves behind."""
    extract.extract_all(
        spark, extract_control(spark), scratch_path(spark, "bronze"), execution_id="run-1", process_name="stock",
        source_system="SapHana", read=reader(sf_dir), raise_errors=False,
    )
    return spark.table(c.TABLE_METRICS_VIEW).select(
        "source_object", "process_name", "sistema_fuente", "rows_read", "rows_written", "status"
    )


def run_of(tag: str, **changes) -> runs.Run:
    return runs.Run("run-1", "dev", "stock", {}, f"audit_{tag}", f"quality_{tag}", **changes)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS "EBELN", CAST(o_custkey AS INT) AS "WERKS", NULL::VARCHAR AS "VBELN",
  'run-1' AS execution_id FROM orders""")
def bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract, register what was landed, conform it, and read the Silver table back."""
    columns = {
        "MATNR": "'m'", "WERKS": "concat(' ', o_custkey)", "DATE_SQL": "cast(o_orderdate AS string)", "EBELN": "cast(o_orderkey AS string)",
        "VBELN": "'N/A'", "Cantidad_Pedida": "'1'", "Peso_Pedido": "'1.5'", "PesoLBS_Pedido": "'2'", "Volumen_Pedido_LBS_DOC": "NULL",
    }
    chosen = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    listed = spark.createDataFrame(
        [("stock", "SapHana", "VistasSapHana", chosen, "tpch", "orders", None, "erp", "orders", "parquet", "full", "1", "1")],
        ", ".join(f"{legacy[0]} string" for _, legacy in c.CONTROL_COLUMNS.values()),
    )
    path = scratch_path(spark, "layers")
    tag = path.rsplit("-", 1)[1]
    run = run_of(tag, silver=[runs.SilverStep(f"bronze_{tag}", f"silver_{tag}", silver.orders)])
    runs.extract(
        spark, run, listed, "VistasSapHana", "SapHana", path, read=reader(sf_dir), table_name=lambda record: f"bronze_{tag}",
    )
    runs.refresh_silver(spark, run)
    kept = materialise(spark.table(f"silver_{tag}").select("EBELN", "WERKS", "VBELN", "execution_id"), "silver")
    spark.sql(f"DROP TABLE bronze_{tag}")
    spark.sql(f"DROP TABLE silver_{tag}")
    return kept


@query("""SELECT CAST(c_custkey AS VARCHAR) AS nombre FROM customer
WHERE c_custkey % 3 = 0 AND c_custkey % 4 <> 0 AND 20240101 + c_custkey % 300 <= 20240200""")
def control_run_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of control rows of two processes and systems, with dates, those that a run loads."""
    key = F.col("c_custkey")
    rows = inputs.table(spark, sf_dir, "customer").select(
        F.when(key % 3 == 0, " stock ").otherwise("other").alias("Proceso"),
        F.when(key % 4 == 0, "sharepoint").otherwise("SapHana").alias("SistemaFuente"),
        F.lit("VistasSapHana").alias("PropietarioFuente"), key.cast("string").alias("NombreArchivoFuente"),
        (F.lit(20240101) + key % 300).cast("int").alias("valid_from"), F.lit(20991231).alias("valid_to"),
    )
    loads = runs.run_loads(rows, "stock", "SapHana", "VistasSapHana", (20240200, 20240200))
    return loads.select(F.col("nombre_archivo_fuente").alias("nombre"))
