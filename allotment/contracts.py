"""Column contracts and record schemas.

Fixed values: the names, types and constants in this module are the public
contract of the flow (tables read, tables written, record layouts) and have to
keep these spellings; the names of views are this library's own choice.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- model inputs -----------------------------------------------------------

PROFITABILITY_COLUMNS = ["fecha", "cod_cliente", "cc_utilidad_bruta", "valor_neto"]
COST_TO_SERVE_COLUMNS = ["fecha"]
CUSTOMER_COLUMNS = [
    "cod_cliente", "cod_cadena", "cod_canal1", "cod_estructura", "cod_sub_canal",
    "cod_tipologia", "nombre_cliente", "grupo_economico", "desc_cadena", "desc_canal",
    "canal_atencion", "longitud", "latitud", "id_centro", "lprio",
]

# Roles of the tables a model run reads and writes.
INPUT_ROLES = [
    "profitability", "cost_to_serve", "materials",
    "customers", "priority_groups", "previous_index",
]
OUTPUT_ROLES = ["index", "index_history"]

DISTRIBUTION_CENTRES = [
    ("3900", 9.0747526, -79.4278550),
    ("3903", 8.4394907, -82.4650681),
    ("3905", 8.1231047, -80.6981549),
    ("3904", 9.4686099, -82.5180536),
]
CENTRE_SCHEMA = T.StructType([
    T.StructField("id_centro", T.StringType(), False),
    T.StructField("latitud_centro", T.DoubleType(), False),
    T.StructField("longitud_centro", T.DoubleType(), False),
])

WINDOW_MONTHS = 12
EARTH_RADIUS_KM = 6371.0
# The chain weights add up to 1.05; that is the published weighting.
CHAIN_WEIGHTS = (0.33, 0.55, 0.17)
CUSTOMER_WEIGHTS = (0.33, 0.5, 0.17)
LOCAL_TIME_ZONE = "America/Bogota"

# --- Silver -----------------------------------------------------------------

OFFERS_CASTS = {
    "DATE_SQL": "date",
    "ERDAT": "date",
    "ERZET": "timestamp",
    "FKDAT": "date",
    "KWMENG": "decimal(16,4)",
    "Cantidad_Pedida": "int",
    "KUNNR": "string",
    "IdMaterial": "string",
    "BRGEW": "decimal(16,4)",
}
ORDERS_CASTS = {
    "MATNR": "string",
    "WERKS": "int",
    "DATE_SQL": "date",
    "EBELN": "string",
    "VBELN": "string",
    "Cantidad_Pedida": "int",
    "Peso_Pedido": "decimal(16,4)",
    "PesoLBS_Pedido": "decimal(16,4)",
    "Volumen_Pedido_LBS_DOC": "decimal(16,4)",
}
PRIORITY_GROUPS_RENAMES = {
    "Cliente": "cliente",
    "Nombre": "nombre",
    "CADENA": "cadena",
    "GRUPO": "grupo",
    "Priorización": "priorizacion",
}
PRIORITY_GROUPS_CASTS = {
    "cliente": "int",
    "nombre": "string",
    "cadena": "string",
    "grupo": "string",
    "priorizacion": "int",
}
PREVIOUS_PRIORITIES_RENAMES = {
    "CODIGO": "codigo",
    "CLIENTE": "cliente",
    "PRIORIZACIÓN": "priorizacion",
}
PREVIOUS_PRIORITIES_CASTS = {
    "codigo": "string",
    "cliente": "string",
    "priorizacion": "int",
}

# --- Gold and publication ---------------------------------------------------

INDEX_CRITICAL_COLUMNS = ["cod_cliente", "prioridad", "Estatus"]
PUBLICATION_COLUMNS = ["cod_cliente", "prioridad", "Estatus", "create_timestamp"]

# --- control records --------------------------------------------------------

# Standard name -> (type, legacy names accepted for it, in order of preference).
CONTROL_COLUMNS: dict[str, tuple[str, list[str]]] = {
    "proceso": ("string", ["Proceso"]),
    "sistema_fuente": ("string", ["SistemaFuente"]),
    "propietario_fuente": ("string", ["PropietarioFuente"]),
    "columnas_archivo_fuente": ("string", ["ColumnasArchivoFuente"]),
    "ruta_archivo_fuente": ("string", ["RutaArchivoFuente"]),
    "nombre_archivo_fuente": ("string", ["NombreArchivoFuente"]),
    "filtros_archivo_fuente": ("string", ["FiltrosArchivoFuente"]),
    "ruta_archivo_destino": ("string", ["RutaArchivoDestino"]),
    "nombre_archivo_destino": ("string", ["NombreArchivoDestino"]),
    "extension_archivo_destino": ("string", ["ExtencionArchivoDestino", "ExtensionArchivoDestino"]),
    "tipo_carga": ("string", ["TipoCarga"]),
    "activo": ("boolean", ["Activo"]),
    "orden_ejecucion": ("int", ["OrdenEjecucion"]),
}
TRUE_WORDS = ["1", "true", "t", "yes", "y", "si", "s", "activo", "active"]
SOURCE_SYSTEMS = ["SapHana", "sharepoint"]
SOURCE_OWNERS = ["VistasSapHana", "DatosPortalDeInformacion"]
CONTROL_VIEW = "vw_control_cargas"
TABLE_METRICS_VIEW = "vw_metrics_ext_saphana"
FILE_METRICS_VIEW = "vw_metrics_ext_sharepoint"
CONTROL_KEY = [
    "proceso_id", "sistema_fuente_id", "propietario_fuente_id", "ruta_archivo_fuente",
    "nombre_archivo_fuente", "ruta_archivo_destino", "nombre_archivo_destino",
]
CONTROL_UPDATED = [
    "columnas_archivo_fuente", "filtros_archivo_fuente", "extension_archivo_destino",
    "tipo_carga", "orden_ejecucion", "activo",
]
OPEN_END_DATE = 99991231

# --- cleaning ---------------------------------------------------------------

NULL_TOKENS = ["", "null", "NULL", "None", "nan", "N/A"]
NULL_TOKENS_ANY_CASE = ["", "null", "none", "nan", "n/a"]
ACCENTED = "áéíóúÁÉÍÓÚñÑ"
UNACCENTED = "aeiouAEIOUnN"
SECRET_QUERY_KEYS = ["sig", "token", "access_token", "client_secret", "sharedaccesssignature"]

# --- records ----------------------------------------------------------------

QUALITY_SCHEMA = T.StructType([
    T.StructField("execution_id", T.StringType()),
    T.StructField("ambiente", T.StringType()),
    T.StructField("proceso", T.StringType()),
    T.StructField("tabla", T.StringType()),
    T.StructField("regla", T.StringType()),
    T.StructField("resultado", T.StringType()),
    T.StructField("cantidad_errores", T.LongType()),
    T.StructField("severidad", T.StringType()),
    T.StructField("mensaje", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])
AUDIT_SCHEMA = T.StructType([
    T.StructField(name, T.StringType())
    for name in [
        "event_id", "timestamp", "ambiente", "process", "run_id", "status",
        "name", "message", "task", "source_system", "execution_id", "details_json",
    ]
])
AUDIT_STATUSES = ["STARTED", "SUCCEEDED", "FAILED", "WARNING"]
TABLE_METRIC_SCHEMA = T.StructType([
    T.StructField("process_name", T.StringType()),
    T.StructField("sistema_fuente", T.StringType()),
    T.StructField("source_object", T.StringType()),
    T.StructField("target_path", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("metric_timestamp_utc", T.StringType()),
])
FILE_METRIC_SCHEMA = T.StructType([
    T.StructField("archivo_origen", T.StringType()),
    T.StructField("archivo_destino", T.StringType()),
    T.StructField("bytes_read", T.LongType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("metric_timestamp_utc", T.StringType()),
])
RUN_METRIC_SCHEMA = T.StructType([
    T.StructField("execution_id", T.StringType()),
    *[T.StructField(f"rows_{role}", T.LongType()) for role in INPUT_ROLES],
    T.StructField("rows_index", T.LongType()),
    T.StructField("index_table", T.StringType()),
    T.StructField("index_history_table", T.StringType()),
])
PUBLICATION_METRIC_SCHEMA = T.StructType([
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


# --- checks -----------------------------------------------------------------

class ContractError(ValueError):
    """A frame or a role mapping does not meet its contract."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns that ``df`` lacks, in contract order (exact spelling)."""
    present = set(df.columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Iterable[str], label: str) -> DataFrame:
    """Return ``df`` unchanged, or fail naming every column it lacks."""
    missing = missing_columns(df, required)
    if missing:
        raise ContractError(f"{label} lacks required columns: {', '.join(missing)}")
    return df


def require_roles(tables: Mapping[str, object], roles: Iterable[str]) -> None:
    """Fail naming every role that has no table."""
    missing = [role for role in roles if tables.get(role) is None or tables.get(role) == ""]
    if missing:
        raise ContractError(f"no table given for: {', '.join(missing)}")


def present_measures(df: DataFrame, measures: Mapping[str, str]) -> dict[str, bool]:
    """Which of the optional measures (name -> column) the frame carries."""
    columns = set(df.columns)
    return {name: column in columns for name, column in measures.items()}
