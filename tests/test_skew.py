from __future__ import annotations

from pyspark.sql import functions as F

from allotment.operators import skew

from .plans import physical


def frames(spark):
    # One key owns a third of the rows; some keys match nothing; NULL matches NULL.
    rows = spark.range(900).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"),
    )
    groups = spark.createDataFrame([("hot", 1), (None, 2), ("none", 3)] + [(f"k{i}", i) for i in range(0, 40, 2)], "k string, v int")
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"))
    return rows, groups, sizes


def test_hot_join_equals_plain_join(spark):
    rows, groups, sizes = frames(spark)
    hot = skew.hot_keys(sizes, "n", 900, 300, minimum=100)
    assert [r.k for r in hot.collect()] == ["hot"]
    plain = skew.join_to_groups(rows, groups, ["k"], None)
    found = skew.join_to_groups(rows, groups, ["k"], hot)
    assert found.columns == plain.columns
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    assert found.filter("k IS NULL").count() == rows.filter("k IS NULL").count() > 0


def test_hot_rows_are_not_shuffled(spark):
    rows, groups, sizes = frames(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = skew.hot_keys(sizes, "n", 900, 300, minimum=100)
        plan = physical(skew.join_to_groups(rows, groups, ["k"], hot))
        upper, lower = plan.split("SortMergeJoin", 1)
        assert "BroadcastHashJoin" in upper and "Exchange hashpartitioning(row" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_hot_keys(spark):
    _, _, sizes = frames(spark)
    assert skew.hot_keys(sizes, "n", 900, 300) is None
    assert skew.hot_keys(sizes, "n", None, None) is None


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 0), ("e", 10), ("f", 11)], "k string, n bigint")
    expected = sorted((k, i) for k, n in [("a", 1), ("b", 3), ("c", 1), ("d", 1), ("e", 10), ("f", 11)] for i in range(1, n + 1))
    for chunk in (4096, 10, 4, 1):
        found = skew.repeat_rows(df, "n", 11, "i", chunk=chunk)
        assert sorted((r.k, r.i) for r in found.collect()) == expected
    assert sorted((r.k, r.i) for r in skew.repeat_rows(df.filter("n = 1"), "n", 1, "i").collect()) == [("a", 1)]
