from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """The frames are tiny; more partitions only cost time."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
