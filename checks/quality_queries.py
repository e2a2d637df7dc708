"""Quality rules, reconciliation and the audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allotment.operators import quality, reconcile, records
from allotment.operators.ranking import rank_by_score
from allotment.plans import run as runs
from allotment.plans.index import stamp
from allotment.runtime import scratch_path
from allotment.sources import sinks

from . import inputs
from .model_queries import DIM
from .registry import query

CONTEXT = quality.RunContext("run-1", "dev", "stock")


@query("""SELECT count(*) AS cantidad FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {DIM} SELECT count(*) AS cantidad FROM dim WHERE cod_cadena IS NULL OR lprio IS NULL")
def critical_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.critical_nulls(inputs.customers(spark, sf_dir), ["cod_cadena", "lprio"])


def gold_like(spark: SparkSession, sf_dir: str, execution_id: str = "run-1") -> DataFrame:
    """Customers ranked by balance, with the columns of the index."""
    customers = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("cod_cliente"), F.col("c_acctbal").alias("margen_porcentual")
    )
    return stamp(rank_by_score(customers, "margen_porcentual", "cod_cliente", "prioridad"), execution_id)


RESULT_COLUMNS = ["execution_id", "ambiente", "proceso", "tabla", "regla", "resultado", "cantidad_errores", "severidad", "mensaje"]


def result_sql(table: str, rule: str, errors: str, message: str, source: str, severity: str = "CRITICAL") -> str:
    return f"""SELECT 'run-1' AS execution_id, 'dev' AS ambiente, 'stock' AS proceso, '{table}' AS tabla, '{rule}' AS regla,
  CASE WHEN {errors} = 0 THEN 'PASSED' ELSE 'FAILED' END AS resultado, CAST({errors} AS BIGINT) AS cantidad_errores,
  '{severity}' AS severidad, {message} AS mensaje FROM {source}"""


HAS_DATA = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"


@query(f"WITH {DIM} " + " UNION ALL ".join([
    result_sql("bronze.lineitem", "bronze_sap_has_data", HAS_DATA, "'rows: ' || count(*)", "lineitem"),
    result_sql("bronze.none", "bronze_sap_has_data", HAS_DATA, "'rows: ' || count(*)", "lineitem WHERE l_quantity < 0"),
    result_sql("bronze.lost", "bronze_sharepoint_has_data", "1", "'table bronze.lost does not exist'", "(SELECT 1)"),
    result_sql("silver.dim", "silver_has_data", HAS_DATA, "'rows: ' || count(*)", "dim"),
    result_sql("silver.dim", "silver_critical_nulls", "count(*)", "'rows with NULL in cod_cliente/lprio: ' || count(*)",
               "dim WHERE lprio IS NULL"),
    result_sql("silver.dim", "silver_duplicate_cod_cliente", "0", "'duplicated cod_cliente: 0'", "(SELECT 1)"),
    result_sql("silver.events", "silver_has_data", HAS_DATA, "'rows: ' || count(*)", "events"),
    result_sql("silver.events", "silver_critical_nulls", "0", "'rows with NULL in user_id: 0'", "(SELECT 1)"),
    result_sql("silver.events", "silver_duplicate_user_id", "count(*)", "'duplicated user_id: ' || count(*)",
               "(SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)"),
    result_sql("silver.orders", "silver_has_data", HAS_DATA, "'rows: ' || count(*)", "orders"),
    result_sql("silver.orders", "silver_required_columns", "2", "'missing columns: prioridad, Estatus'", "(SELECT 1)"),
    result_sql("gold.index", "gold_has_data", HAS_DATA, "'rows: ' || count(*)", "customer"),
    result_sql("gold.index", "gold_critical_nulls", "0", "'rows with NULL in cod_cliente/prioridad/Estatus: 0'", "(SELECT 1)"),
    result_sql("gold.index", "gold_duplicate_cod_cliente", "0", "'duplicated cod_cliente: 0'", "(SELECT 1)"),
]))
def quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem")
    check = quality.TableCheck
    results = quality.run_checks(spark, CONTEXT, [
        check("bronze.lineitem", lines, "bronze_sap_has_data"),
        check("bronze.none", lines.filter("l_quantity < 0"), "bronze_sap_has_data"),
        check("bronze.lost", None, "bronze_sharepoint_has_data"),
        check("silver.dim", inputs.customers(spark, sf_dir), "silver_has_data", "cod_cliente", ["cod_cliente", "lprio"], "silver"),
        check("silver.events", inputs.table(spark, sf_dir, "events"), "silver_has_data", "user_id", ["user_id"], "silver"),
        check("silver.orders", inputs.table(spark, sf_dir, "orders"), "silver_has_data", "o_orderkey",
              ["o_orderkey", "prioridad", "Estatus"], "silver"),
        check("gold.index", gold_like(spark, sf_dir), "gold_has_data", "cod_cliente", ["cod_cliente", "prioridad", "Estatus"]),
    ])
    return results.select(*RESULT_COLUMNS)


RULE = "adf_reconciliation_count"
COUNTS = "(SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM lineitem) AS l)"


def compared_sql(expected: str, found: str, tolerance: float) -> str:
    difference = f"abs({found} - {expected})"
    allowed = f"CAST(floor({expected} * {tolerance}::DOUBLE) AS BIGINT)"
    message = (f"'expected=' || {expected} || '; found=' || {found} || '; difference=' || {difference} "
               f"|| '; allowed=' || {allowed}")
    return result_sql("orders", RULE, f"(CASE WHEN {difference} <= {allowed} THEN 0 ELSE {difference} END)", message, COUNTS)


@query(" UNION ALL ".join([
    result_sql("orders", RULE, "0", "'no comparison table given; skipped'", "(SELECT 1)", "WARNING"),
    result_sql("elsewhere", RULE, "0", "'comparison table not available; skipped'", "(SELECT 1)", "WARNING"),
    result_sql("orders", RULE, "1", "'table to reconcile not available'", "(SELECT 1)"),
    compared_sql("l", "o", 0.0),
    compared_sql("l", "o", 0.8),
    compared_sql("o", "o", 0.0),
]))
def count_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = inputs.table(spark, sf_dir, "orders"), inputs.table(spark, sf_dir, "lineitem")
    cases = [
        {"target": orders},
        {"target": orders, "source_name": "elsewhere"},
        {"target": None, "source_name": "lines", "source": lines},
        {"target": orders, "source_name": "lines", "source": lines},
        {"target": orders, "source_name": "lines", "source": lines, "tolerance": 0.8},
        {"target": orders, "source_name": "orders", "source": orders},
    ]
    parts = [reconcile.reconcile(spark, CONTEXT, target_name="orders", **case).select(*RESULT_COLUMNS) for case in cases]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("""SELECT 'filled' AS caso, true AS abierta, count(*) > 0 AS leida FROM orders UNION ALL SELECT 'empty', false, true
UNION ALL SELECT 'mended', true, true UNION ALL SELECT 'NULL in a key', false, true UNION ALL SELECT 'twice a key', false, true
UNION ALL SELECT 'not comparable', true, true UNION ALL SELECT 'other count', false, true""")
def gate_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the gate opens, case by case; every attempt is judged by its own results under one execution id."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("cod_cliente"), F.col("o_custkey").alias("prioridad"), F.lit("N").alias("Estatus")
    )
    tag = scratch_path(spark, "gate").rsplit("-", 1)[1]
    nulls = orders.withColumn("prioridad", F.when(F.col("cod_cliente") % 1000 != 1, F.col("prioridad")))
    cases = [
        ("filled", orders, None), ("empty", orders.filter("false"), None), ("mended", orders, None), ("NULL in a key", nulls, None),
        ("twice a key", orders.unionByName(orders), None), ("not comparable", orders, f"none_{tag}"), ("other count", orders, f"lines_{tag}"),
    ]
    inputs.table(spark, sf_dir, "lineitem").createOrReplaceTempView(f"lines_{tag}")
    verdicts = []
    for name, gold, compared in cases:
        gold.createOrReplaceTempView(f"gold_{tag}")
        run = runs.Run("it's one id", "dev", "stock", {"index": f"gold_{tag}"}, f"audit_{tag}", f"log_{tag}", comparison_table=compared)
        try:
            runs.check(spark, run)
            verdicts.append((name, True))
        except runs.GateClosed:
            verdicts.append((name, False))
    logged = spark.table(f"log_{tag}").select("execution_id").distinct().count() == 1
    spark.sql(f"DROP TABLE log_{tag}")
    for view in (f"gold_{tag}", f"lines_{tag}"):
        spark.catalog.dropTempView(view)
    return spark.createDataFrame([(name, verdict, logged) for name, verdict in verdicts], "caso string, abierta boolean, leida boolean")


# --- audit --------------------------------------------------------------------------

AUDIT = {
    "ambiente": "' dev '",
    "process": "event_type",
    "run_id": "CAST(event_id AS VARCHAR(20))",
    "status": "CASE event_type WHEN 'error' THEN ' failed' WHEN 'signup' THEN 'Started' WHEN 'purchase' THEN 'SUCCEEDED ' ELSE 'warning' END",
    "name": "'stock'",
    "message": "CONCAT('  ', event_type, ' of user ', CAST(user_id AS VARCHAR(20)))",
    "task": "CASE WHEN event_type = 'view' THEN '   ' ELSE event_type END",
    "source_system": "CAST(NULL AS VARCHAR(20))",
    "execution_id": "CASE WHEN user_id < 10 THEN '' ELSE CAST(user_id AS VARCHAR(20)) END",
    "details_json": "props",
}
REQUIRED_TEXT = ["ambiente", "process", "run_id", "name", "message"]


@query(f"""SELECT {', '.join(
    f"upper(trim({text})) AS status" if name == 'status'
    else f"trim({text}) AS {name}" if name in REQUIRED_TEXT
    else f"nullif(trim({text}), '') AS {name}" for name, text in AUDIT.items())}, true AS stamped FROM events""")
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the events to a log in two halves and read the log back."""
    path = scratch_path(spark, "audit")
    table = f"audit_{path.rsplit('-', 1)[1]}"
    events = inputs.table(spark, sf_dir, "events")
    for part in (events.filter("value < 10"), events.filter("value IS NULL OR value >= 10")):
        raw = part.select(*[F.expr(text).alias(name) for name, text in AUDIT.items()])
        sinks.append_rows(records.normalise_audit(raw), table, path)
    log = spark.read.parquet(path)
    spark.sql(f"DROP TABLE {table}")
    return log.withColumn(
        "stamped", (F.length("event_id") == 36) & F.col("timestamp").isNotNull()
    ).drop("event_id", "timestamp")
