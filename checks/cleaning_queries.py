"""Cleaning, casting, renaming and the Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allotment.functions import carries_secret, is_https
from allotment.operators import cleaning
from allotment.plans import silver

from . import inputs
from .registry import query

TOKENS = """CASE c_custkey % 7 WHEN 0 THEN ' NULL ' WHEN 1 THEN 'n/a' WHEN 2 THEN 'N/A' WHEN 3 THEN 'NaN'
  WHEN 4 THEN '  ' WHEN 5 THEN 'nan' ELSE CONCAT(' ', c_name, ' ') END"""


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "customer").select("c_custkey", F.expr(TOKENS).alias("texto"))


@query(f"""SELECT c_custkey, CASE WHEN t NOT IN ('', 'null', 'NULL', 'None', 'nan', 'N/A') THEN t END AS texto
FROM (SELECT c_custkey, trim({TOKENS}) AS t FROM customer)""")
def null_tokens_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_null_tokens(tokens(spark, sf_dir))


@query(f"""SELECT c_custkey, CASE WHEN lower(t) NOT IN ('', 'null', 'none', 'nan', 'n/a') THEN t END AS texto
FROM (SELECT c_custkey, trim({TOKENS}) AS t FROM customer)""")
def null_tokens_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_null_tokens(tokens(spark, sf_dir), any_case=True)


@query("SELECT doc_id, translate(text, 'áéíóúÁÉÍÓÚñÑ', 'aeiouAEIOUnN') AS text FROM documents")
def accent_folding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fold_accents_in_strings(inputs.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("SELECT c_custkey AS codigo, c_name AS cliente, c_acctbal AS saldo FROM customer")
def rename_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return cleaning.rename_columns(customer, {"c_custkey": "codigo", "c_name": "cliente", "c_acctbal": "saldo"})


@query("""SELECT s_suppkey, s_name, 'SapHana' AS source_system, 'stock' AS process_name, 'run-1' AS execution_id,
  'erp.supplier' AS source_object, true AS ingested FROM supplier""")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = inputs.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return cleaning.add_lineage(
        supplier, source_system="SapHana", process_name="stock", execution_id="run-1", source_object="erp.supplier"
    ).withColumn("ingested", F.col("ingestion_timestamp").isNotNull()).drop("ingestion_timestamp")


# --- Silver: the given columns as noisy text --------------------------------------

# Both dialects read these expressions, so the two sides start from the same text.
RAW_ORDERS = {
    "MATNR": "CONCAT(' ', CAST(l_partkey AS VARCHAR(20)), ' ')",
    "WERKS": """CASE l_linenumber % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN CONCAT(CAST(l_suppkey AS VARCHAR(20)), '.7')
       WHEN 2 THEN '99999999999' WHEN 3 THEN 'x12' ELSE CAST(l_suppkey AS VARCHAR(20)) END""",
    "DATE_SQL": """CASE l_linenumber % 4 WHEN 0 THEN '20240131' WHEN 1 THEN 'null'
       ELSE SUBSTRING(CAST(l_shipdate AS VARCHAR(30)), 1, 10) END""",
    "EBELN": "CASE WHEN l_returnflag = 'R' THEN 'Devolución Ñ' ELSE l_returnflag END",
    "VBELN": "l_linestatus",
    "Cantidad_Pedida": "CONCAT('-', CAST(CAST(l_quantity AS DECIMAL(9,3)) AS VARCHAR(20)))",
    "Peso_Pedido": "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR(20))",
    "PesoLBS_Pedido": "CASE WHEN l_linenumber = 2 THEN '1,5' ELSE CAST(CAST(l_tax AS DECIMAL(9,2)) AS VARCHAR(20)) END",
    "Volumen_Pedido_LBS_DOC": """CASE WHEN l_linenumber = 3 THEN '1234567890123456'
       ELSE CONCAT(CAST(l_orderkey AS VARCHAR(20)), '.123456') END""",
}
RAW_OFFERS = {
    "DATE_SQL": "SUBSTRING(CAST(o_orderdate AS VARCHAR(30)), 1, 10)",
    "ERDAT": "CASE WHEN o_orderstatus = 'F' THEN 'None' ELSE SUBSTRING(CAST(o_orderdate AS VARCHAR(30)), 1, 10) END",
    "ERZET": """CASE o_orderstatus WHEN 'F' THEN '131500' WHEN 'O' THEN '13:15:00'
       ELSE CONCAT(SUBSTRING(CAST(o_orderdate AS VARCHAR(30)), 1, 10), ' 13:15:00') END""",
    "FKDAT": "CASE WHEN o_orderstatus = 'P' THEN 'nunca' ELSE SUBSTRING(CAST(o_orderdate AS VARCHAR(30)), 1, 10) END",
    "KWMENG": "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR(20))",
    "Cantidad_Pedida": "CAST(o_orderkey AS VARCHAR(20))",
    "KUNNR": "CONCAT(' ', CAST(o_custkey AS VARCHAR(20)))",
    "IdMaterial": "CASE WHEN o_orderstatus = 'F' THEN ' nan ' ELSE o_orderpriority END",
    "BRGEW": "CASE WHEN o_orderstatus = 'O' THEN 'N/A' ELSE CONCAT(CAST(o_orderkey AS VARCHAR(20)), '.00005') END",
}


def raw(spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str], key: list[str]) -> DataFrame:
    return inputs.table(spark, sf_dir, table).select(
        *key, *[F.expr(text).alias(name) for name, text in columns.items()]
    )


def cleaned(name: str) -> str:
    text = f"trim(translate(\"{name}\", 'áéíóúÁÉÍÓÚñÑ', 'aeiouAEIOUnN'))"
    return f"CASE WHEN {text} NOT IN ('', 'null', 'NULL', 'None', 'nan', 'N/A') THEN {text} END"


def as_int(name: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({cleaned(name)} AS DECIMAL(28,10))) AS INTEGER) AS \"{name}\""


def as_type(name: str, target: str) -> str:
    return f"TRY_CAST({cleaned(name)} AS {target}) AS \"{name}\""


def source(table: str, columns: dict[str, str]) -> str:
    return f"(SELECT {', '.join(f'{text} AS \"{name}\"' for name, text in columns.items())} FROM {table})"


def as_date(name: str) -> str:
    return f"""CASE WHEN regexp_matches({cleaned(name)}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
      THEN CAST({cleaned(name)} AS DATE) END AS "{name}\""""


@query(f"""SELECT {as_type('MATNR', 'VARCHAR')}, {as_int('WERKS')}, {as_date('DATE_SQL')}, {as_type('EBELN', 'VARCHAR')},
  {as_type('VBELN', 'VARCHAR')}, {as_int('Cantidad_Pedida')}, {as_type('Peso_Pedido', 'DECIMAL(16,4)')},
  {as_type('PesoLBS_Pedido', 'DECIMAL(16,4)')}, {as_type('Volumen_Pedido_LBS_DOC', 'DECIMAL(16,4)')},
  'run-1' AS execution_id FROM {source('lineitem', RAW_ORDERS)}""")
def silver_cast_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.orders(raw(spark, sf_dir, "lineitem", RAW_ORDERS, []), "run-1")


@query(f"""SELECT {as_date('DATE_SQL')}, {as_date('ERDAT')},
  CASE WHEN regexp_matches("ERZET", '^[0-9]{{4}}-') THEN "ERZET" END AS "ERZET",
  {as_date('FKDAT')}, {as_type('KWMENG', 'DECIMAL(16,4)')}, {as_int('Cantidad_Pedida')}, {as_type('KUNNR', 'VARCHAR')},
  {as_type('IdMaterial', 'VARCHAR')}, {as_type('BRGEW', 'DECIMAL(16,4)')},
  'run-1' AS execution_id FROM {source('orders', RAW_OFFERS)}""")
def silver_cast_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = silver.sales_offers(raw(spark, sf_dir, "orders", RAW_OFFERS, []), "run-1")
    return offers.withColumn("ERZET", F.date_format("ERZET", "yyyy-MM-dd HH:mm:ss"))


RAW_GROUPS = {
    "Cliente": "CASE WHEN c_custkey % 6 = 0 THEN 'N/A' ELSE CAST(c_custkey AS VARCHAR(20)) END",
    "Nombre": "CONCAT(c_name, ' Ñandú')",
    "CADENA": "CASE WHEN c_custkey % 4 = 0 THEN CAST(c_nationkey AS VARCHAR(20)) ELSE ' ' END",
    "GRUPO": "c_mktsegment",
    "Priorización": "CONCAT(CAST(c_nationkey AS VARCHAR(20)), '.0')",
}
RAW_PREVIOUS = {
    "CODIGO": "CONCAT(' ', CAST(c_custkey AS VARCHAR(20)), ' ')",
    "CLIENTE": "CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE c_name END",
    "PRIORIZACIÓN": "CASE WHEN c_custkey % 5 = 1 THEN 'alta' ELSE CAST(c_nationkey AS VARCHAR(20)) END",
}


@query(f"""SELECT {as_int('Cliente').rsplit(' AS ', 1)[0]} AS cliente, {cleaned('Nombre')} AS nombre, {cleaned('CADENA')} AS cadena,
  {cleaned('GRUPO')} AS grupo, {as_int('Priorización').rsplit(' AS ', 1)[0]} AS priorizacion,
  'run-1' AS execution_id FROM {source('customer', RAW_GROUPS)}""")
def silver_priority_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.priority_groups(raw(spark, sf_dir, "customer", RAW_GROUPS, []), "run-1")


@query(f"""SELECT {cleaned('CODIGO')} AS codigo, {cleaned('CLIENTE')} AS cliente,
  {as_int('PRIORIZACIÓN').rsplit(' AS ', 1)[0]} AS priorizacion, 'run-1' AS execution_id
  FROM {source('customer', RAW_PREVIOUS)}""")
def silver_previous_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.previous_priorities(raw(spark, sf_dir, "customer", RAW_PREVIOUS, []), "run-1")


# --- URLs ---------------------------------------------------------------------------

URL = """CASE page_id % 5 WHEN 0 THEN CONCAT(url, '?sig=abc') WHEN 1 THEN CONCAT(url, '&Token=')
  WHEN 2 THEN CONCAT(url, '?x=1&%73ig') WHEN 3 THEN CONCAT(url, '?signature=1') ELSE url END"""


@query(f"""SELECT page_id, u AS url,
  regexp_matches(replace(lower(regexp_extract(u, '^[^?#]*[?]([^#]*)', 1)), '%73', 's'),
    '(^|&)(sig|token|access_token|client_secret|sharedaccesssignature)(=|&|$)') AS con_secreto,
  starts_with(lower(u), 'https:') AS https
FROM (SELECT page_id, {URL} AS u FROM pages)""")
def url_secret_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", F.expr(URL).alias("url"))
    return pages.select(
        "page_id", "url",
        carries_secret(F.col("url")).alias("con_secreto"),
        is_https(F.col("url")).alias("https"),
    )
