from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from allotment.operators import ranking

from .plans import physical


def plain_ranks(df, *order):
    return df.withColumn("r", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


@pytest.mark.parametrize("rows", [1, 7, 20000])
def test_global_row_number_equals_row_number(spark, rows):
    # A third of the rows share the lowest score.
    df = spark.range(0, rows, 1, 16).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") * 7919 % 101).cast("double")).alias("score")
    )
    order = [F.col("score").desc(), F.col("id").asc()]
    ranked = ranking.global_row_number(df, order, "r")
    assert ranked.exceptAll(plain_ranks(df, *order)).isEmpty()
    assert ranked.count() == rows


def test_ties_are_spread_over_partitions(spark, monkeypatch):
    placed = []
    write = ranking.materialise
    monkeypatch.setattr(ranking, "materialise", lambda df, label: placed.append(write(df, label)) or placed[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 40000, 1, 8).withColumn("score", F.lit(1.0))
        ranked = ranking.rank_by_score(df, "score", "id", "r")
        assert ranked.filter(F.col("r") != F.col("id") + 1).isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = placed[0].groupBy(F.shiftright("_slot", 33)).count()
    assert sizes.agg(F.max("count")).first()[0] < 40000 / 4


def test_data_is_never_sorted_in_one_partition(spark):
    df = spark.range(100).withColumn("score", F.rand(3))
    plan = physical(ranking.rank_by_score(df, "score", "id", "r"))
    window = plan[plan.index("Window"):]
    # Only the frame of partition sizes passes the unpartitioned window.
    assert "SinglePartition" in window and "count(1)" in window and "score" not in window


def test_empty_frame(spark):
    df = spark.range(0).withColumn("score", F.lit(1.0))
    assert ranking.rank_by_score(df, "score", "id", "r").count() == 0


def test_null_scores_come_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", None), ("d", 2.0)], "id string, score double")
    found = {r.id: r.r for r in ranking.rank_by_score(df, "score", "id", "r").collect()}
    assert found == {"d": 1, "b": 2, "a": 3, "c": 4}


def test_normalise_present_measures_only(spark):
    df = spark.createDataFrame([(1, 10.0, 0.5), (3, 30.0, None), (2, None, 0.5)], "margen_bruto_sum int, distancia double, cv_margen_bruto double")
    found = ranking.min_max_normalise(df).select("margen_norm", "distancia_norm", "estabilidad_norm").collect()
    assert [tuple(r) for r in found] == [(0.0, 1.0, 1.0), (1.0, 0.0, None), (0.5, None, 1.0)]
    assert "margen_bruto_prom_norm" not in ranking.min_max_normalise(df).columns


def test_normalise_edge_frames(spark):
    nulls = spark.createDataFrame([(None,), (None,)], "distancia double")
    assert [r.distancia_norm for r in ranking.min_max_normalise(nulls).collect()] == [None, None]
    constant = spark.createDataFrame([(5.0,), (5.0,)], "distancia double")
    assert [r.distancia_norm for r in ranking.min_max_normalise(constant).collect()] == [1.0, 1.0]
    other = spark.range(2)
    assert ranking.min_max_normalise(other) is other
    assert ranking.min_max_normalise(constant.limit(0)).count() == 0


def test_normalised_values_lie_in_0_1(spark):
    df = spark.range(1000).select(*[(F.rand(i) * 100 - 50).alias(name) for i, name in enumerate(
        ["margen_bruto_sum", "cv_margen_bruto", "distancia", "margen_bruto_prom"])])
    df = ranking.min_max_normalise(df)
    for output, _ in ranking.NORMALISED.values():
        low, high = df.agg(F.min(output), F.max(output)).first()
        assert (low, high) == (0.0, 1.0)


def test_known_bounds_give_the_same(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,)], "distancia double")
    found = ranking.min_max_normalise(df, bounds={"distance": (1.0, 4.0)}).collect()
    assert found == ranking.min_max_normalise(df).collect()
    unknown = ranking.min_max_normalise(df, bounds={"distance": (None, None)})
    assert [r.distancia_norm for r in unknown.collect()] == [None, None, None]


def test_score_fills_with_the_lowest(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (0.0, 0.0, 1.0), (5.0, None, 1.0)], "a double, b double, c double")
    found = [r.score for r in ranking.weighted_score(df, (0.33, 0.55, 0.17), ("a", "b", "c")).collect()]
    assert found == [1.05, 0.17, 0.17]
    none = df.withColumn("c", F.lit(None).cast("double"))
    assert [r.score for r in ranking.weighted_score(none, (1, 1, 1), ("a", "b", "c")).collect()] == [None] * 3
