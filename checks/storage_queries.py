"""Writes to every layer, read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allotment.operators.control import normalise_control
from allotment.runtime import materialise, scratch_path
from allotment.sources import files, sinks

from . import inputs
from .quality_queries import gold_like
from .registry import query

RANKED = """ranked AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cod_cliente,
         row_number() OVER (ORDER BY c_acctbal DESC, CAST(c_custkey AS VARCHAR)) AS prioridad FROM customer)"""


def fresh_name(label: str) -> str:
    return f"{label}_{uuid4().hex}"


def forget(spark: SparkSession, *tables: str) -> None:
    """Drop the catalogue entries; the tables are external, so their files stay."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def files_of(spark: SparkSession, table: str) -> DataFrame:
    """What a table shows now, without its catalogue entry."""
    return spark.read.schema(spark.table(table).schema).parquet(sinks.table_location(spark, table))


def folders(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return len(folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder))


@query("""SELECT p_partkey, p_name, p_size, (SELECT count(*) FROM part) AS escritas FROM part""")
def bronze_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice to the same path (overwrite), with the observed count."""
    path = scratch_path(spark, "bronze")
    part = inputs.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    sinks.write_bronze(part.limit(0), path)
    rows = sinks.write_bronze(part, path)
    return spark.read.parquet(path).withColumn("escritas", F.lit(rows).cast("bigint"))


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, (SELECT count(*) FROM orders) AS escritas FROM orders""")
def silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second refresh replaces data and schema."""
    table, path = fresh_name("silver"), scratch_path(spark, "silver")
    orders = inputs.table(spark, sf_dir, "orders")
    sinks.refresh_table(orders.select("o_orderkey", "o_totalprice"), table, path)
    rows = sinks.refresh_table(orders.select("o_orderkey", "o_custkey", "o_orderstatus"), table, path)
    result = files_of(spark, table)
    forget(spark, table)
    return result.withColumn("escritas", F.lit(rows).cast("bigint"))


@query("""SELECT 'after failure' AS paso, o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus, 1 AS carpetas FROM orders
UNION ALL SELECT 'after wider', o_orderkey, o_totalprice, o_orderstatus, 1 FROM orders""")
def silver_refresh_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh that fails half way leaves rows, schema and files as they were; a wider one replaces them.

    ``carpetas`` counts the folders below the table's path: the files of replaced and failed
    refreshes are gone.
    """
    table, path = fresh_name("silver"), scratch_path(spark, "silver")
    orders = inputs.table(spark, sf_dir, "orders")
    narrow = orders.select("o_orderkey", "o_totalprice")
    sinks.refresh_table(narrow.limit(7), table, path)
    sinks.refresh_table(narrow, table, path)
    last = orders.agg(F.max("o_orderkey")).first()[0]
    broken = F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("unreadable order"))).otherwise(F.lit("x"))
    try:
        sinks.refresh_table(orders.select("o_orderkey", "o_totalprice", "o_orderstatus", broken.alias("extra")), table, path)
    except PySparkException:
        pass
    kept = materialise(spark.table(table), "kept")
    before = folders(spark, path)
    sinks.refresh_table(orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), table, path)
    wider, now = files_of(spark, table), folders(spark, path)
    forget(spark, table)
    named = lambda df, step, n: df.select(
        F.lit(step).alias("paso"), "o_orderkey", "o_totalprice",
        (F.col("o_orderstatus") if "o_orderstatus" in df.columns else F.lit(None).cast("string")).alias("o_orderstatus"), F.lit(n).alias("carpetas"),
    )
    return named(kept, "after failure", before).unionByName(named(wider, "after wider", now))


@query("""SELECT run AS execution_id, c_custkey AS cod, CASE WHEN run = 'run-2' THEN c_acctbal * 2 ELSE c_acctbal END AS valor
FROM customer, (VALUES ('run-1'), ('run-2'), ('run-3')) AS t(run) WHERE run <> 'run-2' OR c_custkey % 3 <> 0""")
def history_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, the second one written twice with other rows: its first rows are gone, the others untouched."""
    snapshot, history = fresh_name("snapshot"), fresh_name("history")
    paths = scratch_path(spark, "snapshot"), scratch_path(spark, "history")
    customers = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cod"), F.col("c_acctbal").alias("valor"))
    retried = customers.where("cod % 3 <> 0").withColumn("valor", F.col("valor") * 2)
    for run, rows in (("run-1", customers), ("run-2", customers), ("run-3", customers), ("run-2", retried)):
        sinks.write_gold(rows.withColumn("execution_id", F.lit(run)), snapshot, history, snapshot_path=paths[0], history_path=paths[1])
    forget(spark, snapshot, history)
    return spark.read.parquet(paths[1]).select("execution_id", "cod", "valor")


@query(f"""WITH {RANKED}
SELECT 'snapshot' AS origen, 'run-2' AS execution_id, * FROM ranked
UNION ALL SELECT 'history', 'run-1', * FROM ranked UNION ALL SELECT 'history', 'run-2', * FROM ranked""")
def snapshot_and_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the snapshot holds the second, the history both."""
    snapshot, history = fresh_name("snapshot"), fresh_name("history")
    paths = scratch_path(spark, "snapshot"), scratch_path(spark, "history")
    for run in ("run-1", "run-2"):
        sinks.write_gold(
            gold_like(spark, sf_dir, run), snapshot, history, snapshot_path=paths[0], history_path=paths[1]
        )
    shown = files_of(spark, snapshot)
    forget(spark, snapshot, history)
    named = lambda df, origin: df.select(F.lit(origin).alias("origen"), "execution_id", "cod_cliente", "prioridad")
    return named(shown, "snapshot").unionByName(named(spark.read.parquet(paths[1]), "history"))


@query("""SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier
UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""")
def log_append_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second append with a new column and without an old one."""
    table, path = fresh_name("log"), scratch_path(spark, "log")
    supplier = inputs.table(spark, sf_dir, "supplier")
    sinks.append_rows(supplier.select("s_suppkey", "s_name"), table, path)
    sinks.append_rows(supplier.select("s_acctbal", "s_suppkey"), table, path)
    result = spark.read.schema(spark.table(table).schema).parquet(path)
    forget(spark, table)
    return result


@query(f"""WITH {RANKED},
n AS (SELECT count(*) AS n FROM customer)
SELECT cod_cliente, prioridad, 'N' AS "Estatus", 2 AS veces_append, 1 AS veces_reemplazo,
  n AS rows_read, n AS rows_written, 'success' AS status FROM ranked, n""")
def publication_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append twice, then replace; what each target holds and the last metric record."""
    appended, replaced = scratch_path(spark, "published"), scratch_path(spark, "published")
    index = gold_like(spark, sf_dir)
    for _ in range(2):
        metric = sinks.publish(index, appended, "append", write=sinks.publish_to_path)
        sinks.publish(index, replaced, "truncate_insert", write=sinks.publish_to_path)
    keys = ["cod_cliente", "prioridad", "Estatus"]
    count = lambda path, name: spark.read.parquet(path).groupBy(*keys).agg(F.count("*").cast("int").alias(name))
    both = count(appended, "veces_append").join(count(replaced, "veces_reemplazo"), keys)
    return both.select(
        *keys, "veces_append", "veces_reemplazo",
        F.lit(metric["rows_read"]).cast("bigint").alias("rows_read"),
        F.lit(metric["rows_written"]).cast("bigint").alias("rows_written"),
        F.lit(metric["status"]).alias("status"),
    )


@query("""SELECT c_nationkey AS pais, 'csv' AS tipo, count(*) AS rows_read, true AS mismo_tamano
FROM customer GROUP BY ALL""")
def csv_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV files by nation, landed elsewhere, then listed and counted there."""
    source, target = scratch_path(spark, "portal"), scratch_path(spark, "landed")
    customers = inputs.table(spark, sf_dir, "customer").withColumn("pais", F.col("c_nationkey"))
    customers.write.partitionBy("pais").option("header", "true").csv(source)
    country = F.regexp_extract("archivo_origen", r"pais=(\d+)", 1).try_cast("int")
    landed = materialise(files.land(spark, source, target), "landing")  # copies once
    copied = (
        landed.filter(F.col("archivo_origen").endswith(".csv"))
        .groupBy(country.alias("pais")).agg(F.sum("bytes_read").alias("copied"))
    )
    found = (
        files.inventory(spark, target)
        .withColumn("pais", country)
        .groupBy("pais", "tipo")
        .agg(F.sum("rows_read").alias("rows_read"), F.sum("bytes_read").alias("found"))
        .filter("tipo = 'csv'")
    )
    return found.join(copied, "pais").select("pais", "tipo", "rows_read", (F.col("found") == F.col("copied")).alias("mismo_tamano"))


@query("""SELECT c_nationkey AS pais, CAST(count(*) AS BIGINT) AS rows_read, 0 AS fallidos, NULL::VARCHAR AS error FROM customer GROUP BY ALL
UNION ALL SELECT -1, NULL, 1, NULL UNION ALL SELECT -2, 0, 0, NULL
UNION ALL SELECT -3, NULL, 1, 'control row lacks nombre_archivo_destino'""")
def file_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV files, landed one by one as a control frame lists them below a ``file:///`` root.

    One listed file is missing, one is empty, and one row lacks its target's name.
    """
    source, target = scratch_path(spark, "portal"), scratch_path(spark, "landed")
    if source.startswith("/"):
        source = f"file://{source}"
    customers = inputs.table(spark, sf_dir, "customer").withColumn("pais", F.col("c_nationkey"))
    customers.write.partitionBy("pais").option("header", "true").csv(source)
    parts = F.split(F.col("archivo_origen"), "/")
    listed = files.listing(spark, source).filter(F.col("archivo_origen").endswith(".csv")).select(
        F.element_at(parts, -2).alias("RutaArchivoFuente"),
        F.element_at(parts, -1).alias("NombreArchivoFuente"),
        F.element_at(parts, -2).alias("RutaArchivoDestino"),
        F.regexp_replace(F.element_at(parts, -1), r"[.]csv$", "").alias("NombreArchivoDestino"),
    )
    empty = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/pais=-2/empty.csv")
    empty.getFileSystem(spark._jsc.hadoopConfiguration()).create(empty).close()
    odd = spark.createDataFrame(
        [("pais=-1", "none.csv", "pais=-1", "none"), ("pais=-2", "empty.csv", "pais=-2", "empty"), ("pais=-3", "none.csv", "pais=-3", " ")],
        listed.schema,
    )
    rows = listed.unionByName(odd).withColumn("ExtencionArchivoDestino", F.lit(".csv"))
    metrics = files.land_controlled(spark, normalise_control(rows), source, target)
    country = F.regexp_extract("archivo_origen", r"pais=(-?\d+)", 1).cast("int")
    return metrics.groupBy(country.alias("pais")).agg(
        F.sum("rows_read").alias("rows_read"), F.count_if(F.col("status") == "failed").cast("int").alias("fallidos"),
        F.max(F.when(F.col("error_message").startswith("control row"), F.col("error_message"))).alias("error"),
    )
