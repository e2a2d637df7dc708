"""The given tables in the shape the library expects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from allotment.plans import silver


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A scan of a given table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def first_of_month(stamp: str) -> Column:
    return F.trunc(F.col(stamp).cast("date"), "month")


def profitability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line; returned lines are negative sales."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1).cast("decimal(2,0)")
    value = (
        sign
        * F.col("l_extendedprice").cast("decimal(12,2)")
        * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)"))
    )
    cost = F.col("p_retailprice").cast("decimal(12,2)") * F.col("l_quantity").cast("decimal(6,0)")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("o_custkey").cast("string").alias("cod_cliente"),
            first_of_month("o_orderdate").alias("fecha"),
            value.cast("decimal(18,4)").alias("valor_neto"),
            (value - cost).cast("decimal(18,4)").alias("cc_utilidad_bruta"),
        )
    )


def cost_to_serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(first_of_month("o_orderdate").alias("fecha"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains for a quarter, five centres of which one is not served, noisy coordinates."""
    key = F.col("c_custkey")
    degrees = lambda base, span: (F.lit(base) + (key % span) / F.lit(100.0)).cast("decimal(9,4)").cast("string")
    chain = (
        F.when(key % 4 == 0, F.concat(F.lit("CH"), F.col("c_nationkey").cast("string")))
        .when(key % 4 == 1, "   ")
        .when(key % 4 == 2, "")
    )
    centre = (
        F.when(key % 5 == 0, "3900").when(key % 5 == 1, "3903").when(key % 5 == 2, "3905")
        .when(key % 5 == 3, "3904").otherwise("4100")
    )
    latitude = F.when(key % 17 == 0, "n/a").otherwise(F.concat(F.lit(" "), degrees(7, 300), F.lit("N ")))
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("cod_cliente"),
        chain.alias("cod_cadena"),
        segment.alias("cod_canal1"),
        segment.alias("cod_estructura"),
        segment.alias("cod_sub_canal"),
        segment.alias("cod_tipologia"),
        name.alias("nombre_cliente"),
        segment.alias("grupo_economico"),
        segment.alias("desc_cadena"),
        segment.alias("desc_canal"),
        segment.alias("canal_atencion"),
        F.concat(F.lit("-"), degrees(78, 450), F.lit(" W")).alias("longitud"),
        latitude.alias("latitud"),
        centre.alias("id_centro"),
        F.when(key % 10 == 0, (key % 7 + 1).cast("int")).alias("lprio"),
    )


def customers_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under two chains and groups, with two names and priorities, twice the same, without a code."""
    once = customers(spark, sf_dir)
    key = F.col("cod_cliente").cast("long")
    return (
        once.unionByName(once.filter(key % 6 == 0).withColumns({"cod_cadena": F.lit("CHX"), "grupo_economico": F.lit("G2")}))
        .unionByName(once.filter(key % 10 == 0).withColumns({"nombre_cliente": F.lit("other"), "lprio": F.lit(9)}))
        .unionByName(once.filter(key % 15 == 0))
        .unionByName(once.filter(key % 50 == 0).withColumn("cod_cliente", F.lit(None).cast("string")))
    )


def customers_hot_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the customers in one chain."""
    hot = F.col("cod_cliente").cast("long") % 3 == 0
    return customers(spark, sf_dir).withColumn("cod_cadena", F.when(hot, "HOT").otherwise(F.col("cod_cadena")))


def priority_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver table of priority groups, from its raw text; an order for every third customer."""
    key = F.col("c_custkey")
    raw = table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" "), key.cast("string")).alias("Cliente"),
        F.col("c_name").alias("Nombre"),
        F.lit("N/A").alias("CADENA"),
        F.col("c_mktsegment").alias("GRUPO"),
        F.when(key % 3 == 0, (F.col("c_nationkey") % 9 + 1).cast("string")).otherwise("nan").alias("Priorización"),
    )
    return silver.priority_groups(raw, "run-1")


def model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six input roles."""
    return {
        "profitability": profitability(spark, sf_dir),
        "cost_to_serve": cost_to_serve(spark, sf_dir),
        "materials": table(spark, sf_dir, "part"),
        "customers": customers(spark, sf_dir),
        "priority_groups": priority_groups(spark, sf_dir),
        "previous_index": table(spark, sf_dir, "supplier"),
    }
