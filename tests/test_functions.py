from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from urllib.parse import parse_qsl, urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allotment import contracts as c
from allotment.functions import (
    carries_secret, fold_accents, great_circle_km, guarded_ratio, homologated_key, is_https,
    null_token_to_null, parse_coordinate, to_contract_type,
)


def apply(spark, values, kind, expression):
    """expression(column) of each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), T.StructType([
        T.StructField("i", T.IntegerType()), T.StructField("x", kind),
    ]))
    return [row[0] for row in df.orderBy("i").select(expression(F.col("x"))).collect()]


TEXT = T.StringType()


def test_accents(spark):
    assert apply(spark, ["Priorización Ñandú", "ÁÉÍÓÚáéíóú", "üç", None], TEXT, fold_accents) == [
        "Priorizacion Nandu", "AEIOUaeiou", "üç", None,
    ]


def test_null_tokens_exact(spark):
    values = ["", "  ", "null", " NULL ", "None", "nan", "N/A", "n/a", "NaN", "NONE", " value ", "\tnull", None]
    assert apply(spark, values, TEXT, null_token_to_null) == [
        None, None, None, None, None, None, None, "n/a", "NaN", "NONE", "value", "\tnull", None,
    ]


def test_null_tokens_any_case(spark):
    values = [" NULL ", "n/a", "NaN", "NONE", "\tnull\n", "  \t ", " value ", " x ", None]
    found = apply(spark, values, TEXT, lambda x: null_token_to_null(x, any_case=True))
    assert found == [None, None, None, None, None, None, "value", "x", None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_to_int(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = ["12", "12.7", "-12.7", " 5 ", "+3", "x", "1e3", "2147483647.9", "2147483648", "-2147483648", "", "1.", ".9", "9" * 40, None]
        found = apply(spark, values, TEXT, lambda x: to_contract_type(x, TEXT, "int"))
        assert found == [12, 12, -12, 5, 3, None, None, 2147483647, None, -2147483648, None, 1, 0, None, None]
        doubles = [1.9, -1.9, 3e9, float("nan"), float("inf"), None]
        assert apply(spark, doubles, T.DoubleType(), lambda x: to_contract_type(x, T.DoubleType(), "int")) == [1, -1, None, None, None, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_text_to_date_and_decimal(spark):
    dates = ["2024-01-31", "2024-1-5", "20240131", "2024-02-30", "2024-01-31 10:00:00", "x", None]
    assert apply(spark, dates, TEXT, lambda x: to_contract_type(x, TEXT, "date")) == [
        dt.date(2024, 1, 31), dt.date(2024, 1, 5), None, None, dt.date(2024, 1, 31), None, None,
    ]
    amounts = ["1.23455", "-1.23455", "1,5", "123456789012.5", "1234567890123", None]
    assert apply(spark, amounts, TEXT, lambda x: to_contract_type(x, TEXT, "decimal(16,4)")) == [
        Decimal("1.2346"), Decimal("-1.2346"), None, Decimal("123456789012.5000"), None, None,
    ]


def test_text_to_timestamp(spark):
    values = ["2024-01-31 13:15:00", "2024-01-31", "13:15:00", "131500", "x", None]
    day = dt.datetime(2024, 1, 31)
    found = apply(spark, values, TEXT, lambda x: to_contract_type(x, TEXT, "timestamp"))
    assert found == [day.replace(hour=13, minute=15), day, None, None, None, None]
    anchor = F.lit("2020-02-03")
    found = apply(spark, values, TEXT, lambda x: to_contract_type(x, TEXT, "timestamp", anchor))
    assert found[2] == dt.datetime(2020, 2, 3, 13, 15) and found[0] == day.replace(hour=13, minute=15) and found[3] is None


def test_coordinates(spark):
    values = [" 9.07N ", "-79.4 W", "n/a", "9.07.47", "1-2", "", "8,5", None]
    assert apply(spark, values, TEXT, parse_coordinate) == [9.07, -79.4, None, None, None, None, 85.0, None]


def test_distance(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 180.0), (9.0, -79.0, 9.0, -79.0), (0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, None)],
        "a double, b double, c double, d double",
    )
    found = [r[0] for r in df.select(great_circle_km(*[F.col(x) for x in "abcd"])).collect()]
    assert found == [pytest.approx(math.pi * 6371), 0.0, pytest.approx(math.pi * 6371 / 180), None, None]


def test_no_distance_is_nan_for_near_antipodes(spark):
    df = spark.range(20000).select(
        (F.rand(1) * 180 - 90).alias("lat"), (F.rand(2) * 360 - 180).alias("lon")
    )
    km = great_circle_km(F.col("lat"), F.col("lon"), -F.col("lat"), F.col("lon") + 180)
    assert df.filter(F.isnan(km) | km.isNull()).count() == 0


def test_guarded_ratio(spark):
    pairs = [(5, 10), (5, 0), (-5, -10), (-5, 10), (5, -10), (None, 10), (5, None), (None, -10), (0, -10)]
    df = spark.createDataFrame(pairs, "m int, s int")
    assert [r[0] for r in df.select(guarded_ratio(F.col("m"), F.col("s"))).collect()] == [
        0.5, None, None, -0.5, -0.5, None, None, None, 0.0,
    ]


def test_homologated_key(spark):
    df = spark.createDataFrame([("CH", "1"), ("", "2"), ("  ", "3"), (None, "4"), (" CH ", "5")], "chain string, id string")
    assert [r[0] for r in df.select(homologated_key(F.col("chain"), F.col("id"))).collect()] == ["CH", "2", "3", "4", " CH "]


URLS = [
    "https://x.test/f.xlsx?sig=abc", "https://x.test/f?SIG=", "https://x.test/f?sig", "https://x.test/f?a=1&Token=2",
    "https://x.test/f?%73ig=1", "https://x.test/f?a=sig", "https://x.test/sig=1", "https://x.test/f#?sig=1",
    "https://x.test/f?signature=1", "https://x.test/f?a=b?sig=1", "HTTPS://x.test/?sharedAccessSignature=1",
    "http://x.test/?client_secret=1&b", "https://x.test/?access_token=%", "https://x.test/?100%=1&%zz", "", "ftp://x",
    "https://x.test/?&&sig=1",
]


def test_secret_urls_against_the_url_parser(spark):
    def expected(url):
        return any(k.lower() in c.SECRET_QUERY_KEYS for k, _ in parse_qsl(urlparse(url).query, keep_blank_values=True))

    assert apply(spark, URLS, TEXT, carries_secret) == [expected(url) for url in URLS]
    assert apply(spark, URLS, TEXT, is_https) == [urlparse(url).scheme == "https" for url in URLS]
    assert apply(spark, [None], TEXT, carries_secret) == [False]
