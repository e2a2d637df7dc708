"""Measures, distances, scores and the priority index."""

from __future__ import annotations

import datetime as dt
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allotment.operators import distance, measures, ranking
from allotment.plans import index
from allotment.plans import months as months_plan
from allotment.runtime import materialise, scratch_path
from allotment.sources import sinks

from . import inputs
from .registry import query

#: The SQL rounds its scores, as its mathematical functions differ in the last bits.
ROUNDED = index.IndexOptions(digits=9)

# --- SQL shared by the oracles ----------------------------------------------

VALUE = """CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS DECIMAL(2,0))
    * CAST(l_extendedprice AS DECIMAL(12,2))
    * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)))"""

PROFIT = f"""profit AS (
  SELECT CAST(o_custkey AS VARCHAR) AS cod_cliente,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha,
         CAST({VALUE} AS DECIMAL(18,4)) AS valor_neto,
         CAST({VALUE} - CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(6,0))
              AS DECIMAL(18,4)) AS cc_utilidad_bruta
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
cost AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha FROM orders)"""

DIM = """dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cod_cliente,
         CASE WHEN c_custkey % 4 = 0 THEN CONCAT('CH', CAST(c_nationkey AS VARCHAR))
              WHEN c_custkey % 4 = 1 THEN '   ' WHEN c_custkey % 4 = 2 THEN '' END AS cod_cadena,
         CASE c_custkey % 5 WHEN 0 THEN '3900' WHEN 1 THEN '3903' WHEN 2 THEN '3905'
              WHEN 3 THEN '3904' ELSE '4100' END AS id_centro,
         CASE WHEN c_custkey % 17 = 0 THEN 'n/a'
              ELSE CONCAT(' ', CAST(CAST(7 + (c_custkey % 300) / 100.0 AS DECIMAL(9,4)) AS VARCHAR), 'N ') END AS latitud,
         CONCAT('-', CAST(CAST(78 + (c_custkey % 450) / 100.0 AS DECIMAL(9,4)) AS VARCHAR), ' W') AS longitud,
         CASE WHEN c_custkey % 10 = 0 THEN CAST(c_custkey % 7 + 1 AS INTEGER) END AS lprio,
         c_mktsegment AS grupo_economico, c_name AS nombre_cliente,
         CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey % 9 + 1 AS INTEGER) END AS orden_grupo
  FROM customer),
centre AS (SELECT * FROM (VALUES
  ('3900', 9.0747526::DOUBLE, -79.4278550::DOUBLE), ('3903', 8.4394907::DOUBLE, -82.4650681::DOUBLE),
  ('3905', 8.1231047::DOUBLE, -80.6981549::DOUBLE), ('3904', 9.4686099::DOUBLE, -82.5180536::DOUBLE))
  AS t(id_centro, lat_c, lon_c)),
located AS (
  SELECT d.cod_cliente, d.id_centro, lat, lon,
         CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN
           2 * 6371 * asin(sqrt(power(sin((radians(lat_c) - radians(lat)) / 2), 2)
             + cos(radians(lat)) * cos(radians(lat_c)) * power(sin((radians(lon_c) - radians(lon)) / 2), 2)))
         END AS distancia
  FROM (SELECT *, TRY_CAST(regexp_replace(trim(latitud), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS lat,
               TRY_CAST(regexp_replace(trim(longitud), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS lon FROM dim) d
  JOIN centre c ON c.id_centro = d.id_centro)"""

MONTHLY = f"""{PROFIT},
win AS (
  SELECT p.* FROM profit p
  WHERE fecha BETWEEN (SELECT max(fecha) FROM cost) - INTERVAL 11 MONTH AND (SELECT max(fecha) FROM cost)),
monthly AS (
  SELECT cod_cliente, fecha, sum(cc_utilidad_bruta) AS m, sum(valor_neto) AS v FROM win GROUP BY ALL)"""


def ratio(margin: str, sales: str) -> str:
    return f"""CASE WHEN {sales} <> 0 AND NOT ({margin} < 0 AND {sales} < 0)
      THEN CAST({margin} AS DOUBLE) / CAST({sales} AS DOUBLE) END"""


LINKED = f"""{MONTHLY},
{DIM},
linked AS (
  SELECT monthly.*, cod_cadena,
         CASE WHEN trim(cod_cadena) <> '' THEN cod_cadena ELSE monthly.cod_cliente END AS llave
  FROM monthly LEFT JOIN (
    SELECT DISTINCT cod_cliente, cod_cadena, grupo_economico FROM dim
    WHERE id_centro IN (SELECT id_centro FROM centre)) l USING (cod_cliente))"""


def measures_of(key: str, name: str, keep: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT s.*, {ratio('s.m', 's.v')} AS pct, distancia FROM (
    SELECT k, sum(m) AS m, sum(v) AS v, avg({ratio('m', 'v')}) AS prom
    FROM (SELECT {key} AS k, fecha, sum(m) AS m, sum(v) AS v FROM linked GROUP BY ALL) GROUP BY k) s
  LEFT JOIN (SELECT {key} AS k, max(distancia) AS distancia
             FROM (SELECT DISTINCT cod_cliente, llave FROM linked) LEFT JOIN located USING (cod_cliente)
             GROUP BY ALL) d ON d.k = s.k
  WHERE {keep})"""


def score_of(source: str, name: str, w1: float, w2: float, w3: float) -> str:
    return f"""{name} AS (
  SELECT *, coalesce(score_0, min(score_0) OVER ()) AS score FROM (
    SELECT *, round({w1}::DOUBLE * pct + {w2}::DOUBLE * prom + {w3}::DOUBLE * norm, 9) AS score_0 FROM (
      SELECT *, 1 - (distancia - min(distancia) OVER ())
                 / greatest(max(distancia) OVER () - min(distancia) OVER (), 1e-9) AS norm
      FROM {source})))"""


SCORES = f"""{LINKED},
{measures_of('llave', 'chains', 's.m IS NOT NULL')},
{measures_of('cod_cliente', 'clients')},
{score_of('chains', 'chains_scored', 0.33, 0.55, 0.17)},
{score_of('clients', 'clients_scored', 0.33, 0.5, 0.17)},
chains_ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC NULLS LAST, k) AS r FROM chains_scored),
clients_ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC NULLS LAST, k) AS r FROM clients_scored)"""


def index_sql(priority: str) -> str:
    return f"""{SCORES},
idx AS (
  SELECT t.cod_cliente, chains_ranked.pct,
         row_number() OVER (ORDER BY {priority} ASC NULLS LAST, chains_ranked.r, clients_ranked.r, t.cod_cliente) AS prioridad
  FROM chains_ranked
  JOIN (SELECT DISTINCT cod_cliente, cod_cadena, llave FROM linked) t ON t.llave = chains_ranked.k
  LEFT JOIN clients_ranked ON clients_ranked.k = t.cod_cliente
  LEFT JOIN dim ON dim.cod_cliente = t.cod_cliente)"""


def r6(name: str, source: str | None = None) -> Column:
    return F.round(F.col(source or name).cast("double"), 6).alias(name)


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.window_months(inputs.model(spark, sf_dir))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.chain_links(index.served_customers(inputs.customers(spark, sf_dir)))


def levels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(customers with listings, chains), both written once."""
    _, listings = index.listings_of(inputs.customers(spark, sf_dir))
    linked = materialise(index.linked_months(months(spark, sf_dir), listings), "linked")
    return linked.filter("primera"), materialise(index.chain_measures(linked), "chains")


# --- window and sums ---------------------------------------------------------

@query(f"""WITH {PROFIT}
SELECT cod_cliente, fecha, CAST(valor_neto AS DOUBLE) AS valor_neto, CAST(cc_utilidad_bruta AS DOUBLE) AS cc_utilidad_bruta
FROM profit
WHERE fecha BETWEEN (SELECT max(fecha) FROM cost) - INTERVAL 11 MONTH AND (SELECT max(fecha) FROM cost)""")
def cutoff_window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = measures.resolve_cutoff(inputs.cost_to_serve(spark, sf_dir), None)
    rows = measures.in_window(inputs.profitability(spark, sf_dir), cutoff, 12)
    return rows.select(
        "cod_cliente", "fecha",
        F.col("valor_neto").cast("double").alias("valor_neto"),
        F.col("cc_utilidad_bruta").cast("double").alias("cc_utilidad_bruta"),
    )


@query(f"""WITH {MONTHLY}
SELECT cod_cliente, fecha, CAST(m AS DOUBLE) AS margen_bruto, CAST(v AS DOUBLE) AS venta_neta FROM monthly""")
def monthly_sums_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months(spark, sf_dir).select(
        "cod_cliente", "fecha",
        F.col("margen_bruto").cast("double").alias("margen_bruto"),
        F.col("venta_neta").cast("double").alias("venta_neta"),
    )


@query(f"""WITH {MONTHLY},
moved AS (
  SELECT cod_cliente, fecha, sum(cc_utilidad_bruta) AS m, sum(valor_neto) AS v FROM profit
  WHERE fecha BETWEEN (SELECT max(fecha) FROM cost) - INTERVAL 12 MONTH AND (SELECT max(fecha) FROM cost) - INTERVAL 1 MONTH GROUP BY ALL)
SELECT 'late rows' AS paso, cod_cliente, fecha, CAST(m AS DOUBLE) AS margen_bruto, CAST(v AS DOUBLE) AS venta_neta, 2 AS meses_leidos FROM monthly
UNION ALL SELECT 'moved window', cod_cliente, fecha, CAST(m AS DOUBLE), CAST(v AS DOUBLE), 0 FROM moved""")
def monthly_sums_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept sums: built without some rows of two months, then with these, then for a window one month earlier.

    ``meses_leidos`` counts the months that were read to bring the sums up to date.
    """
    cutoff = measures.resolve_cutoff(inputs.cost_to_serve(spark, sf_dir), None)
    earlier = (cutoff.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    fact = materialise(inputs.profitability(spark, sf_dir), "fact")
    late = F.col("fecha").isin(cutoff, earlier) & (F.col("cod_cliente").cast("long") % 3 == 0)
    path, names = scratch_path(spark, "fact_by_month"), [f"{kind}_{uuid4().hex}" for kind in ("sums", "record")]
    bring = lambda: months_plan.refresh_months(
        spark, path, *names, sums_path=scratch_path(spark, "sums"), record_path=scratch_path(spark, "record")
    )
    months_plan.append_fact(fact.filter(~late), path)
    bring()
    months_plan.append_fact(fact.filter(late), path)
    read, again = len(bring()), len(bring())
    sums = spark.read.parquet(sinks.table_location(spark, names[0]))
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    shown = lambda step, day, count: measures.monthly_by_customer(months_plan.kept_fact(sums, day, 12)).select(
        F.lit(step).alias("paso"), "cod_cliente", "fecha", F.col("margen_bruto").cast("double").alias("margen_bruto"),
        F.col("venta_neta").cast("double").alias("venta_neta"), F.lit(count).alias("meses_leidos"),
    )
    return shown("late rows", cutoff, read).unionByName(shown("moved window", earlier, again))


# Doubles whose sums are exact in any order: multiples of 2^-27, and whole multiples of 1024 beyond 1e14.
DOUBLE = """CASE WHEN o_custkey % 2 = 0 THEN 1.2e14 + 1024 * CAST(l_quantity AS DOUBLE)
    ELSE CAST(l_quantity AS DOUBLE) / 134217728 END"""


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS cod_cliente, CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha,
  sum(-({DOUBLE})) AS margen_bruto, sum({DOUBLE}) AS venta_neta
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def monthly_sums_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts that are doubles, tiny and huge, keep every digit."""
    lines = inputs.table(spark, sf_dir, "lineitem").join(
        inputs.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    fact = lines.select(
        F.col("o_custkey").cast("string").alias("cod_cliente"), inputs.first_of_month("o_orderdate").alias("fecha"),
        F.expr(DOUBLE).cast("double").alias("valor_neto"),
    ).withColumn("cc_utilidad_bruta", -F.col("valor_neto"))
    return measures.monthly_by_customer(fact)


@query(f"""WITH {LINKED}
SELECT llave AS cod_cliente_homologado, fecha,
       CAST(sum(m) AS DOUBLE) AS margen_bruto, CAST(sum(v) AS DOUBLE) AS venta_neta
FROM linked GROUP BY ALL""")
def monthly_sums_by_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = measures.link_months(months(spark, sf_dir), links(spark, sf_dir))
    sums = {"margen_bruto": "margen_bruto", "venta_neta": "venta_neta"}
    return measures.sums_by(linked, [index.CHAIN_KEY, "fecha"], sums).select(
        index.CHAIN_KEY, "fecha",
        F.col("margen_bruto").cast("double").alias("margen_bruto"),
        F.col("venta_neta").cast("double").alias("venta_neta"),
    )


@query(f"""WITH {MONTHLY}
SELECT cod_cliente, round(avg({ratio('m', 'v')}), 6) AS margen_porcentual_prom FROM monthly GROUP BY ALL""")
def mean_monthly_margin_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = measures.accumulate_dates(months(spark, sf_dir), "cod_cliente")
    return mean.select("cod_cliente", r6("margen_porcentual_prom"))


def accumulated(key: str, name: str) -> str:
    return f"""WITH {LINKED}
SELECT k AS {name}, CAST(sum(m) AS DOUBLE) AS margen_bruto_sum, CAST(sum(v) AS DOUBLE) AS venta_neta_sum,
       round(avg({ratio('m', 'v')}), 6) AS margen_porcentual_prom,
       round({ratio('sum(m)', 'sum(v)')}, 6) AS margen_porcentual
FROM (SELECT {key} AS k, fecha, sum(m) AS m, sum(v) AS v FROM linked GROUP BY ALL) GROUP BY ALL"""


def accumulated_by(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    linked = measures.link_months(months(spark, sf_dir), links(spark, sf_dir))
    return measures.accumulate(linked, key).select(
        key,
        F.col("margen_bruto_sum").cast("double").alias("margen_bruto_sum"),
        F.col("venta_neta_sum").cast("double").alias("venta_neta_sum"),
        r6("margen_porcentual_prom"), r6("margen_porcentual"),
    )


@query(accumulated("llave", "cod_cliente_homologado"))
def accumulated_measures_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulated_by(spark, sf_dir, index.CHAIN_KEY)


@query(accumulated("cod_cliente", "cod_cliente"))
def accumulated_measures_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulated_by(spark, sf_dir, "cod_cliente")


# --- keys, coordinates, distances -----------------------------------------------

@query(f"""WITH {DIM}
SELECT DISTINCT cod_cliente, cod_cadena,
       CASE WHEN trim(cod_cadena) <> '' THEN cod_cadena ELSE cod_cliente END AS cod_cliente_homologado FROM dim""")
def customer_homologation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = inputs.customers(spark, sf_dir).select("cod_cliente", "cod_cadena").distinct()
    return measures.homologate(pairs)


@query(f"""WITH {DIM}
SELECT cod_cliente, TRY_CAST(regexp_replace(trim(latitud), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS latitud,
       TRY_CAST(regexp_replace(trim(longitud), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS longitud FROM dim""")
def coordinates_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.parse_coordinates(inputs.customers(spark, sf_dir)).select("cod_cliente", "latitud", "longitud")


@query(f"""WITH {DIM} SELECT cod_cliente, id_centro, round(distancia, 6) AS distancia FROM located""")
def distance_to_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = index.served_customers(inputs.customers(spark, sf_dir))
    located = distance.distance_to_centre(served, distance.centres(spark))
    return located.select("cod_cliente", "id_centro", r6("distancia"))


@query(f"""WITH {DIM}
SELECT CASE WHEN trim(cod_cadena) <> '' THEN cod_cadena ELSE cod_cliente END AS cod_cliente_homologado,
       round(max(distancia), 6) AS distancia FROM dim JOIN located USING (cod_cliente) GROUP BY ALL""")
def max_distance_by_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = index.served_customers(inputs.customers(spark, sf_dir))
    located = measures.homologate(distance.distance_to_centre(served, distance.centres(spark)))
    return distance.max_distance_by(located, index.CHAIN_KEY).select(index.CHAIN_KEY, r6("distancia"))


# --- normalisation, scores, ranks -------------------------------------------------

@query(f"""WITH {LINKED},
{measures_of('llave', 'chains', 's.m IS NOT NULL')}
SELECT k AS cod_cliente_homologado,
  round((CAST(m AS DOUBLE) - min(CAST(m AS DOUBLE)) OVER ())
        / greatest(max(CAST(m AS DOUBLE)) OVER () - min(CAST(m AS DOUBLE)) OVER (), 1e-9), 6) AS margen_norm,
  round(1 - (distancia - min(distancia) OVER ())
        / greatest(max(distancia) OVER () - min(distancia) OVER (), 1e-9), 6) AS distancia_norm,
  round((prom - min(prom) OVER ())
        / greatest(max(prom) OVER () - min(prom) OVER (), 1e-9), 6) AS margen_bruto_prom_norm
FROM chains""")
def minmax_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, chains = levels(spark, sf_dir)
    return ranking.min_max_normalise(chains, mean_margin="margen_porcentual_prom").select(
        index.CHAIN_KEY, r6("margen_norm"), r6("distancia_norm"), r6("margen_bruto_prom_norm")
    )


@query(f"""WITH {SCORES} SELECT k AS cod_cliente_homologado, round(score, 6) AS score, r AS indice FROM chains_ranked""")
def score_rank_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, chains = levels(spark, sf_dir)
    with_score = index.scored(chains, index.IndexOptions().chain_weights, digits=9)
    ranked = ranking.rank_by_score(with_score.select(index.CHAIN_KEY, "score"), "score", index.CHAIN_KEY, "indice")
    return ranked.select(index.CHAIN_KEY, r6("score"), "indice")


@query(f"""WITH {SCORES} SELECT k AS cod_cliente, round(score, 6) AS score, r AS indice FROM clients_ranked""")
def score_rank_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue, _ = levels(spark, sf_dir)
    with_score = index.scored(catalogue, index.IndexOptions().customer_weights, digits=9)
    one_each = with_score.select("cod_cliente", "score").distinct()
    ranked = ranking.rank_by_score(one_each, "score", "cod_cliente", "indice")
    return ranked.select("cod_cliente", r6("score"), "indice")


@query("""SELECT cod, row_number() OVER (ORDER BY s DESC, cod) AS puesto
FROM (SELECT CAST(c_custkey AS VARCHAR) AS cod, (c_custkey % 5) * 4e-10::DOUBLE AS s FROM customer)""")
def score_rank_unrounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores 4e-10 apart are different scores."""
    rows = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("cod"), ((F.col("c_custkey") % 5) * F.lit(4e-10)).alias("margen_porcentual"),
        F.lit(0.0).alias("margen_porcentual_prom"), F.lit(0.0).alias("distancia_norm"),
    )
    scored = ranking.weighted_score(rows, (1.0, 0.0, 0.0), index.SCORED)
    return ranking.rank_by_score(scored.select("cod", "score"), "score", "cod", "puesto").select("cod", "puesto")


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS puesto FROM orders""")
def global_rank_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.rank_by_score(orders, "o_totalprice", "o_orderkey", "puesto").select("o_orderkey", "puesto")


# --- index --------------------------------------------------------------------------

@query(f"""WITH {index_sql('dim.lprio')}
SELECT cod_cliente, prioridad, round(pct, 6) AS margen_porcentual FROM idx""")
def priority_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = index.priority_index(inputs.model(spark, sf_dir), ROUNDED)
    return ranked.select("cod_cliente", "prioridad", r6("margen_porcentual"))


@query(f"""WITH {index_sql('coalesce(dim.lprio, dim.orden_grupo)')}
SELECT cod_cliente, prioridad, round(pct, 6) AS margen_porcentual FROM idx""")
def priority_index_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = index.IndexOptions(use_group_order=True, digits=9)
    ranked = index.priority_index(inputs.model(spark, sf_dir), options)
    return ranked.select("cod_cliente", "prioridad", r6("margen_porcentual"))


TWICE = DIM.replace("dim AS (", "once AS (", 1).replace("centre AS (", """dim AS (
  SELECT * FROM once
  UNION ALL SELECT * REPLACE ('CHX' AS cod_cadena, 'G2' AS grupo_economico) FROM once WHERE CAST(cod_cliente AS BIGINT) % 6 = 0
  UNION ALL SELECT * REPLACE ('other' AS nombre_cliente, 9 AS lprio) FROM once WHERE CAST(cod_cliente AS BIGINT) % 10 = 0
  UNION ALL SELECT * FROM once WHERE CAST(cod_cliente AS BIGINT) % 15 = 0
  UNION ALL SELECT * REPLACE (NULL AS cod_cliente) FROM once WHERE CAST(cod_cliente AS BIGINT) % 50 = 0),
centre AS (""", 1)
HOT = DIM.replace("CASE WHEN c_custkey % 4 = 0", "CASE WHEN c_custkey % 3 = 0 THEN 'HOT' WHEN c_custkey % 4 = 0", 1)
FIRST_LISTING = ("SELECT DISTINCT cod_cliente, cod_cadena, grupo_economico FROM dim\n    WHERE id_centro IN (SELECT id_centro FROM centre)",
                 """SELECT DISTINCT cod_cliente, cod_cadena, grupo_economico FROM dim
    WHERE id_centro IN (SELECT id_centro FROM centre)
    QUALIFY row_number() OVER (PARTITION BY cod_cliente ORDER BY cod_cadena NULLS LAST, grupo_economico NULLS LAST) = 1""")


def fanned_out_sql(attributes: str) -> str:
    """Literal joins: every listing with every attribute row and every known previous priority."""
    return f"""WITH {SCORES.replace(DIM, TWICE)},
attribute AS ({attributes}),
prio AS (SELECT DISTINCT cod_cliente, lprio FROM dim WHERE lprio IS NOT NULL)
SELECT t.cod_cliente, round(chains_ranked.pct, 6) AS margen_porcentual,
  row_number() OVER (ORDER BY prio.lprio ASC NULLS LAST, chains_ranked.r, clients_ranked.r, t.cod_cliente) AS prioridad
FROM chains_ranked
JOIN (SELECT DISTINCT cod_cliente, cod_cadena, llave FROM linked) t ON t.llave = chains_ranked.k
LEFT JOIN clients_ranked ON clients_ranked.k = t.cod_cliente
LEFT JOIN attribute ON attribute.cod_cliente = t.cod_cliente
LEFT JOIN prio ON prio.cod_cliente = t.cod_cliente"""


def index_of(spark: SparkSession, sf_dir: str, customers: DataFrame, **options) -> DataFrame:
    ranked = index.priority_index(inputs.model(spark, sf_dir) | {"customers": customers}, index.IndexOptions(digits=9, **options))
    return ranked.select("cod_cliente", "prioridad", r6("margen_porcentual"))


@query(fanned_out_sql("""SELECT DISTINCT cod_cliente, id_centro, latitud, longitud, grupo_economico, nombre_cliente
  FROM dim WHERE id_centro IN (SELECT id_centro FROM centre)"""))
def priority_index_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_of(spark, sf_dir, inputs.customers_repeated(spark, sf_dir))


@query(fanned_out_sql("SELECT DISTINCT cod_cliente FROM dim").replace(*FIRST_LISTING))
def priority_index_first_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_of(spark, sf_dir, inputs.customers_repeated(spark, sf_dir), on_duplicate="first")


@query(f"""WITH {index_sql('dim.lprio').replace(DIM, HOT)}
SELECT cod_cliente, prioridad, round(pct, 6) AS margen_porcentual FROM idx""")
def priority_index_hot_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chain with a third of the customers, joined as a hot key."""
    return index_of(spark, sf_dir, inputs.customers_hot_chain(spark, sf_dir), hot_minimum=5)


@query(f"""WITH {LINKED},
{measures_of('llave', 'chains', 's.m IS NOT NULL')}
SELECT k AS cod_cliente_homologado,
  round(1 - (CAST(v AS DOUBLE) - min(CAST(v AS DOUBLE)) OVER ())
        / greatest(max(CAST(v AS DOUBLE)) OVER () - min(CAST(v AS DOUBLE)) OVER (), 1e-9), 6) AS estabilidad_norm
FROM chains""")
def minmax_with_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The optional measure that is better when it is small."""
    _, chains = levels(spark, sf_dir)
    rated = chains.withColumn("cv_margen_bruto", F.col("venta_neta_sum"))
    return ranking.min_max_normalise(rated).select(index.CHAIN_KEY, r6("estabilidad_norm"))


@query(f"""WITH {index_sql('dim.lprio')}
SELECT cod_cliente, prioridad, 'N' AS "Estatus" FROM idx""")
def publication_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    from allotment.sources.sinks import publication_rows

    ranked = index.stamp(index.priority_index(inputs.model(spark, sf_dir), ROUNDED), "run-1")
    return publication_rows(ranked).drop("create_timestamp")


@query(f"""WITH {PROFIT}
SELECT 'profitability' AS tabla, count(*) AS filas FROM profit
UNION ALL SELECT 'cost_to_serve', count(*) FROM cost
UNION ALL SELECT 'materials', count(*) FROM part
UNION ALL SELECT 'customers', count(*) FROM customer
UNION ALL SELECT 'priority_groups', count(*) FROM customer
UNION ALL SELECT 'previous_index', count(*) FROM supplier""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.row_counts(inputs.model(spark, sf_dir))
