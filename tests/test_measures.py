from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from allotment.operators import distance, measures
from allotment.plans import index

from .plans import formatted

MONTHLY = "cod_cliente string, fecha date, margen_bruto decimal(28,4), venta_neta decimal(28,4)"


def test_window_reaches_the_scan_on_both_bounds(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.createDataFrame([("a", dt.date(2024, 1, 1))], "cod_cliente string, fecha date").write.parquet(path)
    plan = formatted(measures.in_window(spark.read.parquet(path), dt.date(2024, 6, 1), 12))
    assert "GreaterThanOrEqual(fecha,2023-07-01)" in plan and "LessThanOrEqual(fecha,2024-06-01)" in plan


def test_window_prunes_date_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(f"c{m}", dt.date(2023, m, 1)) for m in range(1, 13)]
    spark.createDataFrame(rows, "cod_cliente string, fecha date").write.partitionBy("fecha").parquet(path)
    kept = measures.in_window(spark.read.parquet(path), dt.date(2023, 12, 1), 3)
    assert kept.count() == 3
    assert "PartitionFilters: [isnotnull(fecha" in formatted(kept)


@pytest.mark.parametrize("kind", ["date", "string", "timestamp"])
def test_window_edges(spark, kind):
    days = ["2023-06-30", "2023-07-01", "2024-06-01", "2024-06-02", None] + (["x", ""] if kind == "string" else [])
    df = spark.createDataFrame([(d,) for d in days], "fecha string")
    df = df.withColumn("fecha", F.col("fecha").cast(kind))
    kept = measures.in_window(df, dt.date(2024, 6, 1), 12).select(F.col("fecha").cast("date").cast("string"))
    assert sorted(r[0] for r in kept.collect()) == ["2023-07-01", "2024-06-01"]


def test_cutoff(spark):
    cost = spark.createDataFrame([("2024-01-01",), ("2024-05-01",), (None,)], "fecha string")
    assert measures.resolve_cutoff(cost, None) == dt.date(2024, 5, 1)
    assert measures.resolve_cutoff(cost, "2023-02-03") == dt.date(2023, 2, 3)
    assert measures.resolve_cutoff(cost.limit(0), None) is None
    assert measures.in_window(cost, None, 12).count() == 0


def test_months_without_a_ratio_do_not_count(spark):
    rows = [("a", 1, 5, 10), ("a", 2, 5, 0), ("a", 3, -5, -10), ("a", 4, None, 10), ("b", 1, 1, 0)]
    df = spark.createDataFrame(
        [(k, dt.date(2024, m, 1), None if x is None else float(x), float(y)) for k, m, x, y in rows],
        "cod_cliente string, fecha date, margen_bruto double, venta_neta double",
    )
    found = {r[0]: r[1] for r in measures.mean_monthly_ratio(df, "cod_cliente").collect()}
    assert found == {"a": 0.5, "b": None}


def test_link_months_equals_the_fanned_out_join(spark):
    monthly = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1, 2), ("b", dt.date(2024, 1, 1), 3, 4), ("z", dt.date(2024, 1, 1), 5, 6)],
                                    "cod_cliente string, fecha date, margen_bruto int, venta_neta int")
    for name in ("margen_bruto", "venta_neta"):
        monthly = monthly.withColumn(name, F.col(name).cast("decimal(18,4)"))
    dim = spark.createDataFrame(
        [("a", "c1", "g"), ("a", "c1", "h"), ("a", "c1", "h"), ("a", "c2", None), ("b", "", "g")],
        "cod_cliente string, cod_cadena string, grupo_economico string",
    )
    keys = [index.CHAIN_KEY, "fecha"]
    sums = {"margen_bruto": "margen_bruto", "venta_neta": "venta_neta"}
    plain = measures.homologate(monthly.join(dim.distinct(), "cod_cliente", "left"))
    expected = sorted(map(tuple, measures.sums_by(plain, keys, sums).collect()))
    linked = measures.link_months(monthly, measures.chain_links(dim))
    assert sorted(map(tuple, measures.sums_by(linked, keys, sums).collect())) == expected
    assert linked.count() == 4  # and not 5


def test_first_listing_is_the_smallest(spark):
    dim = spark.createDataFrame(
        [("a", "c2", "g"), ("a", "c1", "h"), ("b", None, "g"), ("b", "c3", None)],
        "cod_cliente string, cod_cadena string, grupo_economico string",
    )
    found = sorted(map(tuple, measures.chain_links(dim, "first").collect()))
    assert found == [("a", "c1", 1), ("b", "c3", 1)]


def test_centre_codes_may_be_numbers(spark):
    customers = spark.createDataFrame([(3900, "9", "-79"), (4100, "9", "-79"), (None, "9", "-79")], "id_centro int, latitud string, longitud string")
    served = distance.of_centres(customers, [3900])
    assert served.count() == 1
    assert distance.distance_to_centre(served, distance.centres(spark)).first().distancia > 0
    every = distance.distance_to_centre(customers, distance.centres(spark))
    assert sorted(r.distancia is None for r in every.collect()) == [False, True, True]


def test_text_centres_that_are_no_numbers(spark):
    customers = spark.createDataFrame([("3900",), ("A1",), (None,)], "id_centro string")
    assert distance.of_centres(customers, ["3900", "3903"]).count() == 1
